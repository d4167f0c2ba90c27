"""BPE, packing, token files and token counts against the tokenizers library on whole texts."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from revrec.llm import bpe, packing, texts, token_counts, token_files
from revrec.sources.shared import new_path

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def word():
    return Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def byte():
    return Tokenizer.from_file(BYTE)


def ids_of(tokenizer, text):
    return tokenizer.encode(text, add_special_tokens=False).ids


TEXTS = st.text(st.sampled_from("ab eéÉß\n\t\r\x1c\x85\xa0 <|>'s1½日😀_!.\x01"), max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=6))
def test_pieces_give_the_ids_of_whole_texts(word, byte, many):
    import pyarrow as pa

    for path, tokenizer in ((WORD, word), (BYTE, byte)):
        offsets, ids = texts.library_encoder(path).ids(texts.whole(pa.array(many, pa.string())))
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [ids_of(tokenizer, t) for t in many]


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=6))
def test_pair_index_encodes_and_decodes_as_the_library(word, many):
    import pyarrow as pa

    codec = bpe.codec(WORD)
    offsets, ids = codec.encoder.ids(texts.whole(pa.array(many, pa.string())))
    for t, a, b in zip(many, offsets, offsets[1:]):
        assert ids[a:b].tolist() == ids_of(word, t)
        assert codec.decode(ids[a:b].tolist()) == word.decode(ids_of(word, t), skip_special_tokens=False)


def test_marks_that_only_begin_like_a_special_string(spark, word):
    texts_ = ["a <| b", "<|im_start|>x", "<|user|>", "x<|endoftext|><|y é<|", "<|<|endoftext|>|>", "<|EndOfText|> 日<|本"]
    rows = list(enumerate(texts_))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {k: (ids_of(word, t), word.decode(ids_of(word, t), skip_special_tokens=False)) for k, t in rows}
    assert {r["doc_id"]: (r["ids"], r["decoded"]) for r in bpe.round_trip(docs, WORD).collect()} == want


def test_an_earlier_rank_that_appears_is_applied_first():
    # (ab, c) makes abc late, and (abc, d) is an earlier merge: it must come before the second (ab, c).
    symbols = bpe.byte_symbols()
    vocab = {c: i for i, c in enumerate(symbols)}
    merges = [("b", "c"), ("a", "bc"), ("abc", "d"), ("a", "b"), ("ab", "c")]
    for a, b in merges:
        vocab.setdefault(a + b, len(vocab))
    index = bpe.PairIndex({"model": {"vocab": vocab, "merges": merges}})
    assert index.early
    sizes, ids = index.encode([b"abcd", b"aabb", b"", b"abcabcd"])
    names = {i: t for t, i in vocab.items()}
    assert [names[i] for i in ids.tolist()] == ["abcd", "a", "ab", "b", "abc", "abcd"]
    assert sizes.tolist() == [1, 3, 0, 2]


def expected_digests(rows, word):
    out = []
    for key, text in rows:
        ids = ids_of(word, text)
        decoded = word.decode(ids, skip_special_tokens=False)
        out.append((key, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    return Counter(out)


def test_op3_is_the_library(spark, small_rows, word):
    assert Counter(map(tuple, bpe.op3_bpe(spark, SF).collect())) == expected_digests(small_rows, word)


def test_bpe_edges(odd, none, odd_rows, word):
    want = Counter((k, tuple(ids_of(word, t)), word.decode(ids_of(word, t), skip_special_tokens=False)) for k, t in odd_rows)
    for way in (lambda df: bpe.decode(bpe.encode(df, WORD), WORD), lambda df: bpe.round_trip(df, WORD)):
        assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in way(odd).collect()) == want
        assert way(none).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 24), max_size=60))
def test_best_fit_takes_the_tightest_sequence(lengths):
    lengths = sorted(lengths, reverse=True)
    sequences, offsets = packing.best_fit(lengths, 24)
    free: list[int] = []
    for n, s, o in zip(lengths, sequences, offsets):
        fits = [r for r in free if r >= n]
        if fits:
            assert free[s] == min(fits)
        else:
            assert s == len(free)
            free.append(24)
        assert o == 24 - free[s]
        free[s] -= n


def test_best_fit_refuses_what_does_not_fit():
    for wrong in (25, -1, None):
        with pytest.raises(ValueError):
            packing.best_fit([wrong], 24)


def check_packed(rows, source, word):
    ids = [np.array(ids_of(word, t) + [1], "<u4") for _, t in source]
    want = Counter()
    for (key, _), own in zip(source, ids):
        for k, at in enumerate(range(0, len(own), 4096)):
            cut = own[at:at + 4096]
            want[(key, k, at, len(cut), zlib.crc32(cut.tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    return len(by), sum(map(len, ids))


def test_op2_packs_every_piece(spark, small_rows, word):
    count, total = check_packed(packing.op2_packing(spark, SF).collect(), small_rows, word)
    assert count <= -(-total // 4096) + 1


def test_packing_edges(odd, none, odd_rows, word):
    check_packed(packing.pack_documents(odd, WORD).collect(), odd_rows, word)
    assert packing.pack_documents(none, WORD).count() == 0


def test_sequences_hold_their_pieces(spark, small, small_rows, word):
    from revrec.sources.shared import materialise

    made = materialise(packing.pieces(small, WORD, 1, with_ids=True), "pieces")
    packed = packing.pack(made.select("doc_id", "piece", "length"))
    full = packing.sequences(packed.join(made.drop("length"), ["doc_id", "piece"])).collect()
    assert all(len(r["ids"]) <= 4096 for r in full)
    assert Counter(i for r in full for i in r["ids"]) == Counter(i for _, t in small_rows for i in ids_of(word, t) + [1])


def test_pack_keeps_a_hot_key_in_several_groups(spark):
    from revrec.sources.shared import materialise

    rows = materialise(spark.range(3000).selectExpr("if(id % 3 = 0, 7, id) AS doc_id", "1 + id % 4096 AS length"), "rows")
    packed = packing.pack(rows, group_rows=200).collect()
    assert len(packed) == 3000
    assert len({r["sequence_id"] >> 32 for r in packed if r["doc_id"] == 7}) > 5


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 9), max_size=700), max_size=4), st.floats(0, 1))
def test_token_file_round_trip(many, percentile):
    sizes = [len(x) for x in many]
    ids = np.array([i for x in many for i in x], np.uint32)
    keys = [None if k == 1 else k for k in range(len(many))]
    held = token_files.TokenFile(token_files.dump(keys, np.cumsum(sizes, dtype=np.int64), ids, percentile))
    assert held.keys == keys and held.ids().tolist() == ids.tolist()
    for a, b in ((0, 1), (len(ids) // 3, len(ids) // 2), (len(ids) - 1, len(ids))):
        if 0 <= a < b <= len(ids):
            assert held.ids(a, b).tolist() == ids[a:b].tolist()


def test_token_file_is_smaller_and_refuses_other_bytes():
    ids = np.random.default_rng(0).geometric(0.01, 100_000).astype(np.uint32)
    data = token_files.dump([1], np.array([len(ids)]), ids)
    assert len(data) < 0.4 * ids.nbytes
    with pytest.raises(ValueError):
        token_files.TokenFile(b"x" * 64)


def expected_file(rows, byte):
    key = lambda r: (r[0] is not None, r[0] or 0)
    out, at = [], 0
    for k, t in sorted(rows, key=key):
        own = np.array(ids_of(byte, t) + [0], "<u4")
        out.append((k, at, len(own), zlib.crc32(own.tobytes())))
        at += len(own)
    return out


def test_op9_reads_what_it_wrote(spark, small_rows, byte):
    got = token_files.op9_token_files(spark, SF).orderBy("start").collect()
    assert [tuple(r) for r in got] == expected_file(small_rows, byte)


def test_token_file_edges(spark, odd, none, odd_rows, byte):
    files = token_files.write(odd, BYTE, 0, new_path(spark, "edges"), file_ids=50)
    assert files.count() > 3
    got = sorted((r["start"], r["doc_id"], bytes(r["tokens"])) for r in token_files.read(files).collect())
    assert [g[1] for g in got] == sorted((k for k, _ in odd_rows), key=lambda k: (k is not None, k or 0))
    want = Counter(np.array(ids_of(byte, t) + [0], "<u4").tobytes() for _, t in odd_rows)
    assert Counter(g[2] for g in got) == want
    at = 0
    for start, _, raw in got:
        assert start == at
        at += len(raw) // 4
    assert token_files.read(token_files.write(none, BYTE, 0, new_path(spark, "none"))).count() == 0


def brute_sections(text, bounds, byte, rule):
    counts = Counter()
    for a, b in byte.encode(text, add_special_tokens=False).offsets:
        last = max(b - 1, a)
        own = [k for k in range(len(bounds) - 1) if bounds[k] <= last and bounds[k + 1] > a]
        shared = [min(bounds[k + 1], b) - max(bounds[k], a) for k in own]
        counts[own[{"start": 0, "end": -1, "most": int(np.argmax(shared))}[rule]]] += 1
    return counts


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_sections_follow_the_rule(spark, byte, rule):
    # Bounds inside words, so that tokens cross them.
    text = "Hello wonderful world\n\n\n日本語 😀 internationalisation of    things\n"
    cuts = [0, 3, 4, 9, 22, 24, 28, 40, 47, len(text)]
    sections = [(f"s{i}", a, b) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    df = spark.createDataFrame([(1, text, sections)], "doc_id long, text string, parts array<struct<name:string,start:int,end:int>>")
    got = {r["section"]: r["n_tokens"] for r in token_counts.section_counts(df, BYTE, "parts", rule).collect()}
    want = brute_sections(text, cuts, byte, rule)
    assert got == {k: want[k] for k in range(len(sections))}


def test_tokens_in_gaps_count_for_none(spark, byte):
    df = spark.createDataFrame([(1, "one two three", [("a", 3, 7)])], "doc_id long, text string, parts array<struct<name:string,start:int,end:int>>")
    got = {r["section"]: r["n_tokens"] for r in token_counts.section_counts(df, BYTE, "parts").collect()}
    assert got == {-1: 2, 0: 1}


def test_op7_counts_every_token_once(spark, small_rows, byte):
    got = defaultdict(dict)
    for r in token_counts.op7_token_counts(spark, SF).collect():
        got[r["doc_id"]][r["section"]] = r["n_tokens"]
    for key, text in small_rows:
        assert sum(got[key].values()) == len(ids_of(byte, text))
        bounds = token_counts.line_bounds(text).tolist()
        if len(bounds) < 30:
            want = brute_sections(text, bounds, byte, "most")
            assert got[key] == {k: want[k] for k in range(len(bounds) - 1)}


def test_token_count_edges(odd, none, odd_rows, byte):
    rows = token_counts.section_counts(odd, BYTE).collect()
    assert sum(r["n_tokens"] for r in rows) == sum(len(ids_of(byte, t)) for _, t in odd_rows)
    assert len(rows) == sum(t.count("\n") + 1 for _, t in odd_rows)
    assert token_counts.section_counts(none, BYTE).count() == 0
    with pytest.raises(ValueError):
        token_counts.section_counts(odd, BYTE, rule="any")

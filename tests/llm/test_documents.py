"""Quality rules, licence scan, SimHash, language model and classifier against plain versions."""

import math
import os
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revrec.llm import language_model, licences, quality_model, quality_rules, simhash, texts
from revrec.sources.shared import drop_part

SF = "/root/testdata/sf0.001"
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- quality rules

def plain_figures(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {p for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def figures_of(rows):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return Counter((r["doc_id"], *(r["__r_rules"][n] for n in names), r["__r_rules"]["base_failed"]) for r in rows)


def plain_all(rows):
    out = Counter()
    for key, text in rows:
        f = plain_figures(text)
        out[(key, *f, f[0] < 50 or 100 * f[4] > 50 * f[0])] += 1
    return out


def test_rules_edges(odd, none, odd_rows):
    judged = quality_rules.judge(odd)
    assert judged.columns == [*odd.columns, "__r_rules"]
    assert figures_of(judged.collect()) == plain_all(odd_rows)
    assert quality_rules.judge(none).count() == 0
    assert quality_rules.clean(odd).columns == odd.columns
    assert quality_rules.clean(none).count() == 0


def host(spark, n_docs, common, own="alpha beta gamma delta"):
    """Documents of one host, of 60 words each; the first `common` of them hold one line twice, in two spellings."""
    rows = []
    for i in range(n_docs):
        body = " ".join(f"{own.split()[k % 4]}{i}x{k}" for k in range(60))
        rows.append((i, f"Common  Line here\n{body}\n common line HERE " if i < common else body, "h"))
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_lines_above_the_limit_go_and_others_stay(spark):
    docs = host(spark, 50, 20)
    rules = {r["doc_id"]: r["__r_rules"] for r in quality_rules.judge(docs).collect()}
    assert all(rules[i]["n_removed"] == (6 if i < 20 else 0) and rules[i]["kept"] for i in range(50))
    cleaned = {r["doc_id"]: r["text"] for r in quality_rules.clean(docs).collect()}
    assert len(cleaned) == 50 and not any("ommon" in t for t in cleaned.values())
    # Ten documents are not more than the limit; eleven are, on a host of any size.
    assert all(r["__r_rules"]["n_removed"] == 0 for r in quality_rules.judge(host(spark, 50, 10)).collect())
    for n in (100, 1000):
        removed = {r["doc_id"]: r["__r_rules"]["n_removed"] for r in quality_rules.judge(host(spark, n, 11)).collect()}
        assert removed == {i: 6 if i < 11 else 0 for i in range(n)}


def test_copies_count_as_one_document(spark):
    docs = host(spark, 20, 0)
    copies = docs.filter("doc_id = 0").crossJoin(spark.range(500)).select((F.col("id") + 1000).alias("doc_id"), "text", "source")
    assert all(r["__r_rules"]["kept"] for r in quality_rules.judge(docs.unionByName(copies)).collect())


def test_depleted_documents_are_rejected(spark):
    shared = " ".join(f"s{k}" for k in range(60))
    rows = [(i, f"{shared}\n" + " ".join(f"d{i}w{k}" for k in range(30 if i < 30 else 90)), "h") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"] for r in quality_rules.clean(docs).collect()}
    assert kept == set(range(30, 60))


def test_a_host_of_one_template_goes(spark):
    """300 pages of 80 template and 60 own words; near copies, of which recurring lines are 0.8, stay."""
    shared = "\n".join(" ".join(f"s{n}w{k}" for k in range(20)) for n in range(4))
    page = lambda i, own: f"{shared}\n" + " ".join(f"d{i}w{k}" for k in range(own))
    for own, kept in ((60, 0), (21, 0), (20, 300)):
        docs = spark.createDataFrame([(i, page(i, own), "h") for i in range(300)], "doc_id long, text string, source string")
        assert quality_rules.clean(docs).count() == kept


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "", "c d"]), max_size=8), st.sets(st.integers(0, 7)))
def test_removed_lines_leave_the_others(spark, lines, gone):
    text = "\n".join(lines)
    parts = text.split("\n")
    places = sorted(p for p in gone if p < len(parts))
    want = "\n".join(x for k, x in enumerate(parts) if k not in places)
    column = F.array(*map(F.lit, places)).cast("array<int>")
    got = spark.range(1).select(quality_rules.without_lines(F.lit(text), column)).first()[0]
    assert got == want


def test_rules_run_without_python(spark):
    plan = quality_rules.op1_quality_rules(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


# ---------------------------------------------------------------- licences

def plain_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.translate(ASCII_LOWER))


def plain_places(text):
    words = plain_words(text)
    return sorted(
        (i, label) for phrase, label in licences.PHRASES.items() for p in [phrase.split()]
        for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p
    )


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=9), min_size=1, max_size=4), st.lists(st.sampled_from("abcd"), max_size=40))
def test_automaton_gives_the_longest_match(templates, words):
    sequences = [[w.encode() for w in t] for t in templates]
    automaton = licences.Automaton(sequences)
    grams = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    state = matched = 0
    for at, word in enumerate(w.encode() for w in words):
        while state and word not in automaton.next[state]:
            state = automaton.link[state]
            matched = automaton.length[state]
        if word in automaton.next[state]:
            state, matched = automaton.next[state][word], matched + 1
        seen = tuple(w.encode() for w in words[:at + 1])
        want = max((n for n in range(1, len(seen) + 1) if seen[-n:] in grams), default=0)
        assert matched == want
        if matched:
            ends = {(k, j) for k, s in enumerate(sequences) for j in range(matched, len(s) + 1) if tuple(s[j - matched:j]) == seen[-matched:]}
            assert set(automaton.ends[state]) == ends


def test_op4_base_is_plain(spark, small_rows):
    got = {r["doc_id"]: r for r in licences.op4_licences(spark, SF).collect()}
    for key, text in small_rows:
        places, r = plain_places(text), got[key]
        starts = [s for s, _ in places]
        assert (r["n_words"], r["n_base"]) == (len(plain_words(text)), len(places))
        assert (r["first_word"], r["last_word"]) == ((min(starts), max(starts)) if starts else (None, None))
        base = {label for _, label in places}
        assert r["base_labels"] == ",".join(sorted(base))
        assert base <= set(filter(None, r["labels"].split(","))) and 0 <= r["score"] <= 1


def test_licence_edges(spark, odd, none, odd_rows):
    rows = licences.scan(odd).collect()
    assert Counter((r["doc_id"], r["n_words"]) for r in rows) == Counter((k, len(plain_words(t))) for k, t in odd_rows)
    assert licences.scan(none).count() == 0


def plain_matches(template, words, least):
    """All matches (file start, template start, length) that go on neither to the left nor to the right."""
    out = set()
    for i in range(len(words)):
        for j in range(len(template)):
            n = 0
            while i + n < len(words) and j + n < len(template) and words[i + n] == template[j + n]:
                n += 1
            if n >= least and (i == 0 or j == 0 or words[i - 1] != template[j - 1]):
                out.add((i, j, n))
    return sorted(out)


def plain_best(segments, least, gap):
    """Best (value, words) over all choices of chains, by trying every one."""
    def go(k, last, value, covered):
        best = (value, covered)
        for i in range(k, len(segments)):
            f, t, n = segments[i]
            if last is None or last[0] + last[2] <= f:
                best = max(best, go(i + 1, segments[i], value + n - least, covered + n))
            if last is not None:
                g, u, m = last
                if g < f and u < t and g + m < f + n and u + m < t + n and f - g - m <= gap and t - u - m <= gap:
                    gain = n - max(0, g + m - f, u + m - t)
                    best = max(best, go(i + 1, segments[i], value + gain, covered + gain))
        return best
    return go(0, None, 0, 0)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), min_size=2, max_size=9), min_size=1, max_size=4), st.lists(st.sampled_from("abcd"), max_size=14))
def test_licence_chains_are_the_best_of_all(templates, words):
    least, gap = 2, 2
    own = licences.Scanner([], [" ".join(t) for t in templates], min_segment=least, max_gap=gap)
    found = own.scan(" ".join(words).encode())
    for k, template in enumerate(templates):
        spans = [s for s in found.spans if s[0] == k]
        assert (sum(s[1] - least for s in spans), sum(s[1] for s in spans)) == plain_best(plain_matches(template, words, least), least, gap)
        assert all(a[3] <= b[2] for a, b in zip(spans, spans[1:])) and all(0 < s[1] <= s[3] - s[2] for s in spans)
    # Winners share no word; every other span shares one with a winner that covers as much or more.
    won = [s for s, w in zip(found.spans, found.wins) if w]
    meets = lambda a, b: a[2] < b[3] and b[2] < a[3]
    assert not any(meets(a, b) for i, a in enumerate(won) for b in won[:i])
    assert all(w or any(meets(s, o) and o[1] >= s[1] for o in won) for s, w in zip(found.spans, found.wins))


def test_licences_that_quote_each_other(spark):
    by = dict(licences.TEMPLATES)
    rows = [
        (1, "This work is licensed under a Creative Commons Attribution ShareAlike 4.0"),
        (2, by["isc"] + " own words" * 30 + " " + by["isc"]), (3, by["lgpl"]), (4, by["agpl"]),
    ]
    found = {r["doc_id"]: r for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    spans = {(s["label"], s["wins"]) for s in found[1]["spans"]}
    assert ("cc-by", False) in spans and ("cc-by-sa", True) in spans
    assert [s["share"] for s in found[2]["spans"] if s["label"] == "isc"] == [1.0, 1.0]
    for key, label in ((3, "lgpl"), (4, "agpl")):
        assert {s["label"] for s in found[key]["spans"] if s["wins"] and s["share"] >= licences.MIN_COVER} == {label}


def test_licence_texts_are_found_with_changes(spark):
    by = dict(licences.TEMPLATES)
    changed = by["bsd"].replace("source and binary", "SOURCE, and (binary)").replace("the following disclaimer", "this long other disclaimer", 1)
    rows = [
        (1, "Copyright someone. " + changed + " The end."), (2, by["isc"][: len(by["isc"]) // 4]),
        (3, "plain text about permission to use any purpose"), (4, "x " * 50_000 + by["mpl"]), (5, "see the MIT\nLicense, or CC-BY"),
        (6, " ".join([by["unlicense"]] * 40)),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in licences.scan(docs).collect()}
    labels = {k: {s["label"] for s in r["spans"] if s["share"] >= licences.MIN_COVER} for k, r in found.items()}
    assert labels[1] == {"bsd"} and not labels[2] and not labels[3] and labels[4] == {"mpl"} and labels[6] == {"unlicense"}
    assert [(p["start"], p["label"]) for p in found[5]["places"]] == [(2, "mit"), (5, "cc-by")]
    span = next(s for s in found[4]["spans"] if s["label"] == "mpl")
    assert (span["share"], span["start"]) == (1.0, 50_000)


# ---------------------------------------------------------------- SimHash

def plain_fingerprint(text):
    words = text.translate(ASCII_LOWER)
    words = [w for w in re.split("[\x20\x09-\x0d]+", words) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def plain_classes(values, radius=4):
    """Place of the first member of each value's class."""
    label = list(range(len(values)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= radius:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


def expected_simhash(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    values = [plain_fingerprint(t) for _, t in rows]
    first = plain_classes(values)
    return Counter((k, f"{v:016x}", rows[f][0]) for (k, _), v, f in zip(rows, values, first))


def test_op8_is_plain(spark, small_rows):
    assert Counter(map(tuple, simhash.op8_simhash(spark, SF).collect())) == expected_simhash(small_rows)


def test_simhash_edges(odd, none, odd_rows):
    rows = simhash.near_duplicates(odd).collect()
    assert Counter((r["doc_id"], f"{r['fp'] % 2**64:016x}", r["component_id"]) for r in rows) == expected_simhash(odd_rows)
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted({r["component_id"] or -1 for r in rows})
    assert simhash.keep_one(none).count() == 0


def near_values(seed, n):
    """Chains and stars of near values besides unrelated ones."""
    rng = np.random.default_rng(seed)
    values = [int(x) for x in rng.integers(0, 2**63, n)]
    for _ in range(2 * n):
        x = values[int(rng.integers(len(values)))]
        for b in rng.integers(0, 64, int(rng.integers(1, 7))):
            x ^= 1 << int(b)
        values.append(x)
    return sorted(set(values))


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_bit_sliced_comparison_finds_the_classes(seed, radius):
    values = near_values(seed, 60)
    got = simhash.linked(np.array(values, np.uint64), np.zeros(len(values), int), radius)
    assert got.tolist() == plain_classes(values, radius)


def test_groups_do_not_meet():
    values = np.array([5, 7, 5, 7, 5], np.uint64)
    assert simhash.linked(values, np.array([0, 0, 1, 2, 2]), 4).tolist() == [0, 0, 2, 3, 3]
    assert simhash.linked(values[:0], np.array([], int), 4).tolist() == []


@pytest.mark.parametrize("count", [10, 5_000_000, 10**9, 10**12])
def test_no_choice_of_blocks_loses_a_link(count):
    masks = simhash.block_masks(count, 4)
    rng = np.random.default_rng(0)
    for _ in range(300):
        apart = sum(1 << int(b) for b in set(rng.integers(0, 64, 4).tolist()))
        assert any(not apart & m for m in masks)


def test_links_hold_for_buckets_in_parts(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 16)
    monkeypatch.setattr(simhash, "_ROWS", 50)
    values = near_values(9, 80)
    signed = [v - 2**64 if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = {r["node"]: r["root"] for r in simhash.connected(simhash.links(df, len(values))).collect()}
    want = plain_classes(values)
    groups: dict = {}
    for v, w in zip(signed, want):
        groups.setdefault(w, set()).add(roots.get(v, v))
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).selectExpr("id AS a", "id + 1 AS b").unionByName(spark.sql("SELECT 1000L AS a, 1000L AS b"))
    roots = simhash.connected(edges).collect()
    assert len(roots) == 301 and len({r["root"] for r in roots}) == 1


# ---------------------------------------------------------------- language model

def plain_model(rows, order=3):
    words = lambda t: re.findall("[^\x20\x09-\x0d]+", t.translate(ASCII_LOWER)) + [""]
    begins = (" ",) * (order - 1)
    windows = lambda own: list(zip(*[[*begins, *own][k:] for k in range(order)]))
    train = [words(t) for k, t in rows if zlib.crc32(("" if k is None else str(k)).encode()) % 5 != 1]
    counts = Counter(w for t in train for w in t)
    # Counts of grams by order: as they stand in the highest, by distinct words before in the others.
    grams = {order: Counter(g for t in train for g in windows(t))}
    for k in range(order, 1, -1):
        grams[k - 1] = Counter(g[1:] for g in grams[k])
    cuts = {k: language_model.discounts(*[Counter(g.values())[j] for j in (1, 2, 3, 4)]) for k, g in grams.items()}
    after: dict = {}
    for g in grams.values():
        for gram, c in g.items():
            after.setdefault(gram[:-1], []).append(c)
    n, v = sum(counts.values()), len(counts)
    cut = lambda c, by: by[min(c, 3) - 1] if c else 0
    sums = {h: (sum(own), sum(cut(c, cuts[len(h) + 1]) for c in own)) for h, own in after.items()}

    def p(history, w):
        k = len(history) + 1
        total, held = sums.get(history, (0, 0))
        if not history and not total:
            return 1.0
        shorter = p(history[1:], w) if history else 1 / (v + 1)
        if not total:
            return shorter
        c = grams[k][(*history, w)]
        return (c - cut(c, cuts[k]) + held * shorter) / total

    def scored(text):
        own = words(text)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        return len(own), sum(w in counts for w in own), base, sum(math.log10(p(g[:-1], g[-1])) for g in windows(own))

    return n, counts, p, scored


def same_scores(rows, expected):
    assert len(rows) == len(expected)
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[3])
    for a, b in zip(sorted(rows, key=order), sorted(expected, key=order)):
        assert a[:3] == b[:3]
        assert a[3:] == pytest.approx(b[3:], rel=1e-9)


def test_op10_is_plain(spark, small_rows):
    n, _, _, scored = plain_model(small_rows)
    rows = language_model.op10_language_model(spark, SF).collect()
    assert {r["train_tokens"] for r in rows} == {n}
    same_scores([(r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in rows], [(k, *scored(t)) for k, t in small_rows])
    assert {r["doc_id"] for r in rows if r["held_out"]} == {k for k, _ in small_rows if zlib.crc32(str(k).encode()) % 5 == 1}


def test_model_beats_the_base_on_held_out_texts(spark):
    held = [r for r in language_model.op10_language_model(spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.9 * sum(r["base_score"] for r in held)


@pytest.mark.parametrize("order", [2, 3, 5])
def test_model_edges(spark, odd, none, odd_rows, monkeypatch, order):
    monkeypatch.setattr(language_model, "BUCKET_TOKENS", 20_000)  # many buckets, frequent words in several
    trained = [(k, t) for k, t in odd_rows if zlib.crc32(("" if k is None else str(k)).encode()) % 5 != 1]
    model = language_model.train(odd.filter(~language_model.held_out(F.col("doc_id"))), order)
    n, _, _, scored = plain_model(odd_rows, order)
    assert model.tokens == n and trained
    rows = language_model.score(odd, model).collect()
    same_scores([tuple(r) for r in rows], [(k, *scored(t)) for k, t in odd_rows])
    assert language_model.score(none, model).count() == 0


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_parts_of_a_batch_are_whole(kind):
    """Every part gives its own words, wherever it begins; all but the first once lost theirs."""
    rows = [f"Text {i} OF Words{i % 7}" for i in range(40)]
    for held in (rows, [None, *rows], [*rows, "", None]):
        batch = pa.record_batch([pa.array(held, kind)], ["text"])
        for first in range(len(held)):
            part = batch.slice(first, 9).column("text")
            want = [t or "" for t in held[first:first + 9]]
            assert texts.whole(part).to_pylist() == want
            ends, index, hashes = language_model.tokens(texts.whole(part))
            words = [language_model._hash(w.encode()) for t in want for w in [*t.lower().split(), ""]]
            assert hashes[index].tolist() == words and ends.tolist() == np.cumsum([len(t.split()) + 1 for t in want]).tolist()


def test_scores_of_many_slices_in_a_batch(spark):
    """Texts of 14 MB in one batch, several slices of it: the same scores as in any other order."""
    rows = [(i, " ".join(f"W{(i * 7919 + k * k) % 5003}" for k in range(200_000))) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    model = language_model.train(docs, 2)
    assert model.tokens == 12 * 200_001 and model.words.size == len({w.lower() for _, t in rows for w in t.split()}) + 1
    scores = [sorted(map(tuple, language_model.score(d, model).collect())) for d in (docs, docs.repartition(9))]
    assert all(r[1:3] == (200_001, 200_001) for r in scores[0])
    assert [r[3:] for r in scores[0]] == [pytest.approx(r[3:], rel=1e-9) for r in scores[1]]


def test_nothing_learnt(odd, none):
    rows = language_model.score(odd, language_model.train(none)).collect()
    assert all(r["score"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 for r in rows)


def test_probabilities_sum_to_one(small_rows):
    _, counts, p, _ = plain_model(small_rows[:30])
    some = [" ", *list(counts)[:3], "neverseen"]
    for h in [(a, b) for a in some for b in some]:
        assert sum(p(h, w) for w in counts) + p(h, "neverseen") == pytest.approx(1)


# ---------------------------------------------------------------- classifier

def truth(sf):
    return dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())


def test_classifier_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    rows = quality_model.op6_quality_model(spark, sf).collect()
    assert len(rows) == 10_000 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    quality = truth(sf)
    held = [(quality[r["doc_id"]], r["score"], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in quality]
    good, bad = [s for q, s, _ in held if q == 1], [s for q, s, _ in held if q == 0]
    assert sum(a > b for a in good for b in bad) / (len(good) * len(bad)) > 0.99
    assert sum(q == p for q, _, p in held) / len(held) > 0.95


def test_held_out_labels_do_not_matter(spark, odd):
    docs = spark.createDataFrame([(i, f"word{i} " * (i % 7 + 1) + "ok text.") for i in range(200)], "doc_id long, text string")
    labels = [(i, int(i % 7 > 2)) for i in range(200)]
    def flipped(i, q):
        return 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q
    one = spark.createDataFrame(labels, "doc_id long, quality int")
    two = spark.createDataFrame([(i, flipped(i, q)) for i, q in labels], "doc_id long, quality int")
    scores = [sorted(map(tuple, quality_model.classify(docs, x).collect())) for x in (one, two)]
    assert scores[0] == scores[1]


def test_classifier_edges(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, None), (None, 1), (5, 1), (8, 1), (7, 0)], "doc_id long, quality int")
    rows = quality_model.classify(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (2, 3, 4)}) == 1  # NULL, empty and blank texts
    unlabelled = quality_model.classify(odd, labels.limit(0)).collect()
    assert {r["score"] for r in unlabelled} == {0.5}
    assert quality_model.classify(none, labels).count() == 0
    kept = quality_model.keep_good(odd, labels)
    assert kept.columns == odd.columns and kept.count() <= odd.count()
    assert quality_model.keep_good(none, labels).count() == 0


def test_risk_stays_non_negative_for_separable_data():
    rng = np.random.default_rng(3)
    good = rng.normal(2, 1, (400, len(quality_model.FIGURES)))
    bad = rng.normal(-2, 1, (100, len(quality_model.FIGURES)))
    model = quality_model.PositiveUnlabelled(0.8).fit(good[:100], np.vstack([good[100:], bad]))
    assert (model.score(good) > 0.5).mean() > 0.98 and (model.score(bad) < 0.5).mean() > 0.9


@pytest.mark.parametrize("top", [3, 1 << 12, 1 << 63])
def test_keys_in_order(top):
    """Keys that agree in their upper bits and repeat are sorted and grouped like any others."""
    draw = np.random.default_rng(top % 97)
    for n in (0, 1, 2, 1000, 50_000):
        keys = draw.integers(0, top, n, dtype=np.uint64)
        order, held, starts = language_model._grouped(keys)
        distinct, counts = np.unique(keys, return_counts=True)
        assert keys[order].tolist() == np.sort(keys).tolist() and sorted(order.tolist()) == list(range(n))
        assert held.tolist() == distinct.tolist() and np.diff(starts, append=n).tolist() == counts.tolist()


def test_training_leaves_no_runs(spark, odd, monkeypatch):
    """Files of shuffles and merged runs are deleted during training; they once stayed until the driver collected garbage."""
    monkeypatch.setattr(language_model, "BUCKET_TOKENS", 2_000)
    monkeypatch.setattr(language_model, "TURN_BUCKETS", 1)
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {f for f in blocks.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}
    before, runs = shuffled(), []
    monkeypatch.setattr(language_model, "drop_part", lambda df, part: (runs.append((part, df.inputFiles())), drop_part(df, part)))
    model = language_model.train(odd, 3)
    for _ in range(100):
        left = shuffled() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and model.tokens and len(runs) == language_model.TURNS
    merged = [f.removeprefix("file://").removeprefix("file:") for part, files in runs for f in files if f"/{part}/" in f]
    assert merged and not any(os.path.exists(f) for f in merged)


def test_scoring_looks_each_gram_up_once(spark, odd, monkeypatch):
    """A history is the gram of the place before, so its facts come with that gram's."""
    docs = odd.filter("text IS NOT NULL").select("doc_id", "text")
    model = language_model.train(docs, 3)
    batch = docs.toArrow().combine_chunks().to_batches()[0]
    want = sorted(tuple(r) for r in language_model.score(docs.filter("doc_id IS NOT NULL"), model).collect())
    looked = Counter()

    class Frame:
        def mapInArrow(self, run, schema):
            self.run = run
            return self

    class Dealer(language_model.Dealer):
        def __call__(self, columns, *often):
            looked[len(columns)] += len(columns[0])
            return super().__call__(columns, *often)

    monkeypatch.setattr(language_model, "_hashes_of", lambda df: df)
    model.dealer = Dealer(model.words, model.dealer.texts, model.dealer.buckets, model.dealer.share)
    rows = [tuple(r.values()) for out in language_model.score(Frame(), model).run(iter([batch])) for r in out.to_pylist()]
    assert sorted(r for r in rows if r[0] is not None) == want
    words = [["<", "<", *re.findall(r"[^\x20\x09-\x0d]+", t.translate(ASCII_LOWER)), ">"] for t in batch.column("text").to_pylist()]
    pairs, triples = ({g for w in words for g in zip(*(w[k:] for k in range(n)))} for n in (2, 3))
    assert looked == {2: len(pairs), 3: len(triples)}  # the two begins are one of the pairs

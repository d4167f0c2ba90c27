"""Two tokenizers' tokens of the same texts, aligned by the bytes they cover.

1. A text is cut before spaces, where both tokenizers always end a token (held to their vocabularies), and every
   distinct piece of a block is encoded with both. The cumulative ends of either side go into a dictionary from end
   to index; the sorted intersection of their keys slices both id lists into groups, and each slice is expanded into
   the links between its overlapping tokens. Blocks are written: pieces of each document, links of each piece.
2. Links are counted per block from the pieces' counts and summed by a shuffle on the id pair; the sorted pairs, their
   counts and whether a pair is its B id's highest are written as arrays that workers map.
3. A last pass over the blocks looks every distinct link up once and adds up the documents' figures.

Rules: texts that are NULL, empty, or not given back byte by byte by either tokenizer have no tokens and no groups;
special strings in a text are plain text; repeated rows count as often as they stand there; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revrec.llm.language_model import Vocabulary, write_vocabulary
from revrec.llm.texts import byte_symbols, documents, give_back, slices, small_batches, spaced_pieces, splitter, whole, word_splitter
from revrec.sources.shared import materialise, new_path

#: Bytes of text in a block.
BLOCK_BYTES = 3 << 19
#: Distinct pieces that a worker remembers in each of two generations.
CACHE_PIECES = 50_000
#: Blocks that the JVM reads at a time; one goes to Python at a time.
ROWS = 4

_MARK, _SPACE = "▁", " "
_CUT = "\x01"
# A space after anything but white space, in the sense of either tokenizer or str.isspace().
_BEFORE = r"([^\t-\r \x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}])( )"


#: A piece's numbers of tokens of A and B and of groups, its links as 8-byte keys, and its groups as text.
Piece = tuple[int, int, int, bytes, str]
_NONE: Piece = (-1, 0, 0, b"", "")


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The common ones of two rising lists of ends, and how many of either list stand up to each of them.

    Their differences are the slices of both lists that make the groups.
    """
    of_a, of_b = (dict(zip(x.tolist(), range(1, len(x) + 1))) for x in (a, b))
    common = sorted(of_a.keys() & of_b.keys())
    return np.array(common, np.int64), *(np.array([of[e] for e in common], np.int64) for of in (of_a, of_b))


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places whose ranges overlap, from both lists of ends (the last ones equal).

    Inside a slice no ends are equal, so between two neighbouring ends of either list lies exactly one pair:
    a slice of m and n tokens is expanded into m + n - 1 links.
    """
    every = np.union1d(a, b)
    return np.searchsorted(a, every), np.searchsorted(b, every)


class Aligner:
    """Byte-level BPE file of the tokenizers library (A) against a sentencepiece model with byte fallback (B)."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(a_path)
        byte_of = {s: b for b, s in enumerate(byte_symbols())}
        self.words, self.merge = word_splitter(a_path, plain=True), tokenizer.model.tokenize
        self.a_bytes = {i: bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode()
                        for t, i in tokenizer.get_vocab(with_added_tokens=False).items()}
        self.model = sentencepiece.SentencePieceProcessor(model_file=b_path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.b_bytes = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace(_MARK, _SPACE).encode()
                        for i, n in enumerate(names)]
        self.space = self.model.piece_to_id(_MARK)
        # A cut before a space is safe where no token of B goes on over it.
        self.cuts = splitter(a_path) is spaced_pieces and not any(re.search(f"[^{_MARK}]{_MARK}", n) for n in names)
        self.a_size = np.zeros(max(self.a_bytes) + 1, np.int64)
        self.a_size[list(self.a_bytes)] = [len(x) for x in self.a_bytes.values()]
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        # Ids as text with what follows them: another of the group, the other side, the next group.
        texts = lambda n, after: np.array([f"{i}{after}" for i in range(n)], object)
        self.a_text = [texts(len(self.a_size), x) for x in ",|"]
        self.b_text = [texts(len(self.b_size), x) for x in (",", ";", "")]
        self.met: dict[str, Piece] = {}
        self.old: dict[str, Piece] = {}

    def pieces(self, texts: pa.Array) -> pa.Array:
        """Lists of pieces of space + text; each begins with a space."""
        full = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(_SPACE, pa.large_string()))
        if self.cuts:
            lists = pc.split_pattern(pc.replace_substring_regex(full, _BEFORE, r"\1" + _CUT + r"\2"), _CUT)
            odd = pc.match_substring(texts, _CUT)
            if not pc.any(odd).as_py():
                return lists
        else:
            odd = pa.array(np.ones(len(texts), bool))
        single = pa.array([[t] for t in full.to_pylist()], pa.list_(pa.large_string()))
        return pc.if_else(odd, single, lists.cast(single.type)) if self.cuts else single

    def tokens(self, pieces: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of both sides of every piece."""
        rest = [p[1:] for p in pieces]
        for piece, b in zip(pieces, self.model.encode(rest, num_threads=1) if rest else []):
            a = [t.id for w in self.words(piece) for t in self.merge(w)]
            yield a, b if len(piece) > 1 else [self.space]

    def same_bytes(self, piece: str, a: list[int], b: list[int]) -> bool:
        raw = piece.encode()
        return b"".join([self.a_bytes[i] for i in a]) == raw == b"".join([self.b_bytes[i] for i in b])

    def make(self, pieces: list[str]) -> list[Piece]:
        """All pieces side by side, as one text with cumulative ends that run through."""
        out = [_NONE] * len(pieces)
        good = [(k, a, b) for k, (p, (a, b)) in enumerate(zip(pieces, self.tokens(pieces))) if self.same_bytes(p, a, b)]
        if not good:
            return out
        a, b = (np.array([i for g in good for i in g[side]], np.int64) for side in (1, 2))
        last_a, last_b = (np.cumsum([len(g[side]) for g in good]) for side in (1, 2))
        ends_a, ends_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        common, up_a, up_b = common_ends(ends_a, ends_b)
        own, other = overlaps(ends_a, ends_b)
        keys = (a[own] << 32 | b[other]).astype("<i8").tobytes()
        piece_ends = ends_a[last_a - 1]
        groups = np.searchsorted(common, piece_ends, "right")
        links = np.searchsorted(ends_a[own], piece_ends, "right")
        # Text: the tokens of A of a group, then those of B, with what follows each.
        flat = np.empty(len(a) + len(b), object)
        size_a, size_b = np.diff(up_a, prepend=0), np.diff(up_b, prepend=0)
        text_a, text_b = self.a_text[0][a], self.b_text[0][b]
        text_a[up_a - 1], text_b[up_b - 1] = self.a_text[1][a[up_a - 1]], self.b_text[1][b[up_b - 1]]
        text_b[last_b - 1] = self.b_text[2][b[last_b - 1]]
        flat[np.arange(len(a)) + np.repeat(up_b - size_b, size_a)] = text_a
        flat[np.arange(len(b)) + np.repeat(up_a, size_b)] = text_b
        flat = flat.tolist()
        i = j = g = n = 0
        for (k, _, _), i2, j2, g2, n2 in zip(good, last_a.tolist(), last_b.tolist(), groups.tolist(), links.tolist()):
            out[k] = (i2 - i, j2 - j, g2 - g, keys[8 * n:8 * n2], "".join(flat[i + j:i2 + j2]))
            i, j, g, n = i2, j2, g2, n2
        return out

    def all(self, pieces: list[str], again: np.ndarray) -> list[Piece]:
        """Every distinct piece; those met lately, or more than once in their block (`again`), come from memory."""
        met, old = self.met, self.old
        new = [p for p in pieces if p not in met and p not in old]
        made = dict(zip(new, self.make(new)))
        found = [met.get(p) or old.get(p) or made[p] for p in pieces]
        if len(met) > CACHE_PIECES:
            self.old, self.met = met, {}
        # Long pieces are rare and large, so they are made anew.
        self.met.update((p, x) for p, x, more in zip(pieces, found, again.tolist()) if more and len(p) <= 64)
        return found


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    key = (a_path, b_path)
    if key not in _aligners:
        _aligners[key] = Aligner(*key)
    return _aligners[key]


_PER_DOCUMENT = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
_BLOCK = ", ".join(f"{c} array<bigint>" for c in _PER_DOCUMENT) + ", digests array<string>, ends binary, places binary, sizes binary, links binary"


def _block(part: pa.RecordBatch, own: Aligner) -> pa.RecordBatch:
    texts = whole(part.column("text"))
    lists = own.pieces(texts)
    flat = lists.flatten().dictionary_encode()
    ends = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists), dtype=np.int64))])
    places = np.asarray(flat.indices, dtype=np.int64)
    made = own.all(flat.dictionary.to_pylist(), np.bincount(places, minlength=len(flat.dictionary)) > 1)
    numbers = np.array([(a, b, g, len(x) >> 3) for a, b, g, x, _ in made], np.int64).reshape(-1, 4)
    bad = np.concatenate([[0], np.cumsum(numbers[places, 0] < 0)])[ends]
    good = (np.diff(bad) == 0) & (np.asarray(pc.binary_length(texts)) > 0)
    # Texts that are not aligned hold no pieces.
    places = places[np.repeat(good, np.diff(ends))]
    ends = np.concatenate([[0], np.cumsum(np.where(good, np.diff(ends), 0))])
    sums = [np.diff(np.concatenate([[0], np.cumsum(numbers[places, k])])[ends]) for k in range(4)]
    groups = np.array([x[4] for x in made], object)
    digests = [hashlib.sha256(";".join(groups[places[i:j]].tolist()).encode()).hexdigest() if j > i else "" for i, j in zip(ends[:-1], ends[1:])]
    row = [[part.column("doc_id").to_pylist()], *[[s.tolist()] for s in sums], [digests]]
    blobs = [ends.astype("<i8"), places.astype("<u4"), numbers[:, 3].astype("<u4")]
    blobs = [[x.tobytes()] for x in blobs] + [[b"".join([x[3] for x in made])]]
    kinds = [pa.list_(pa.int64())] * 5 + [pa.list_(pa.string())] + [pa.binary()] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(v, k) for v, k in zip(row + blobs, kinds)], [*_PER_DOCUMENT, "digests", "ends", "places", "sizes", "links"])


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """A written table of blocks: their documents with figures, the place of each document's pieces, the pieces' links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_path, b_path)
        gc.disable()  # many small lists and no cycles: looking for some takes a sixth of the time
        try:
            for batch in batches:
                for part in slices(batch, most=BLOCK_BYTES):
                    yield _block(part, own)
                    give_back()
        finally:
            gc.enable()
            # Vocabularies and remembered pieces go with the task: later stages run in the same worker.
            del own
            _aligners.clear()
            gc.collect()
            give_back()

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with small_batches(docs.sparkSession, BLOCK_BYTES):
        return materialise(slim.mapInArrow(run, _BLOCK), "aligned")


def groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, start, end, a, b): the groups of every document, by bytes of its text (after the added space at 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_path, b_path)
        for batch in batches:
            for part in slices(batch, most=BLOCK_BYTES):
                for doc_id, pieces in zip(part.column("doc_id").to_pylist(), own.pieces(whole(part.column("text"))).to_pylist()):
                    found = list(zip(pieces, own.tokens(pieces))) if pieces != [_SPACE] else []
                    if not found or not all(own.same_bytes(p, *ids) for p, ids in found):
                        continue
                    a, b = ([i for _, ids in found for i in ids[side]] for side in (0, 1))
                    ends, up_a, up_b = common_ends(np.cumsum(own.a_size[a]), np.cumsum(own.b_size[b]))
                    lists = [[x[i:j] for i, j in zip([0, *up], up)] for x, up in ((a, up_a.tolist()), (b, up_b.tolist()))]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([doc_id] * len(ends), pa.int64()), pa.array(np.concatenate([[0], ends[:-1]])), pa.array(ends),
                        *[pa.array(x, pa.list_(pa.int32())) for x in lists]], ["doc_id", "start", "end", "a", "b"])

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, start bigint, end bigint, a array<int>, b array<int>")


def _opened(batch: pa.RecordBatch, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    read = lambda name, kind: np.frombuffer(batch.column(name)[at].as_buffer(), kind)
    return read("places", "<u4"), read("sizes", "<u4").astype(np.int64), read("links", "<i8")


def link_counts(blocks: DataFrame) -> DataFrame:
    """(pair, a, b, n, best): how many links hold each id pair, and whether that is the most of its B id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                places, sizes, links = _opened(batch, at)
                times = np.repeat(np.bincount(places, minlength=len(sizes)), sizes)
                order = np.argsort(links)
                links, times = links[order], times[order]
                head = np.flatnonzero(np.diff(links, prepend=-1))
                pairs, n = links[head], np.add.reduceat(times, head) if len(head) else times
                yield pa.RecordBatch.from_arrays([pa.array(pairs[n > 0]), pa.array(n[n > 0])], ["pair", "n"])
            give_back()

    counts = blocks.select("places", "sizes", "links").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
    counts = counts.select("pair", F.shiftright("pair", 32).cast("int").alias("a"), b.alias("b"), "n")
    # A B id has as many partners as A's vocabulary at most.
    return counts.withColumn("best", F.col("n") == F.max("n").over(W.partitionBy("b")))


def figures(blocks: DataFrame, links: Vocabulary) -> DataFrame:
    """Per document its numbers of tokens, groups and links, those of links that are best, the sum of their counts,
    and the digest of its groups; `links` are the arrays of `link_counts`."""
    out = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                places, sizes, keys = _opened(batch, at)
                ends = np.frombuffer(batch.column("ends")[at].as_buffer(), "<i8")
                pieces = np.concatenate([[0], np.cumsum(sizes)])
                distinct, place = np.unique(keys, return_inverse=True)
                ids = links.ids(distinct)
                sums = []
                for name in ("best", "n"):
                    of_links = np.concatenate([[0], np.cumsum(links.take(name, "<i8", ids)[place])])
                    of_pieces = np.diff(of_links[pieces])
                    sums.append(np.diff(np.concatenate([[0], np.cumsum(of_pieces[places])])[ends]))
                held = [batch.column(c)[at].values for c in _PER_DOCUMENT]
                yield pa.RecordBatch.from_arrays(
                    [*held, pa.array(sums[0]), pa.array(sums[1]), batch.column("digests")[at].values],
                    [*_PER_DOCUMENT, "n_best", "count_sum", "groups_sha256"])
            give_back()

    return blocks.mapInArrow(run, out)


def write_links(blocks: DataFrame) -> Vocabulary:
    """The arrays of `link_counts`: sorted pairs, their counts, and whether they are best."""
    columns = link_counts(blocks).select(F.col("pair").alias("hash"), "n", F.col("best").cast("bigint").alias("best"))
    with small_batches(blocks.sparkSession, 1, ROWS):
        return write_vocabulary(columns, new_path(blocks.sparkSession, "links"))


def linked(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """`figures` of all documents, as a written table."""
    blocks = align(docs, a_path, b_path)
    links = write_links(blocks)
    with small_batches(docs.sparkSession, 1, ROWS):
        return materialise(figures(blocks, links), "figures")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return linked(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))

"""Benchmark passages in training documents, found through a positional inverted index.

1. Documents are cut into segments of a few MB. A segment's task sorts its words by term and writes one row per
   term with the places where it stands (differences as variable-length bytes), and one row with its documents.
   Places count through the segment with a free one between documents, so neighbours in place are neighbours in a
   document. The index is a written table; it serves any number of test sets.
2. Only the rows of the test terms are read. Per segment and window the list of its rarest term there, moved by
   the term's offset, gives the candidate starts; the lists of the other terms, rarest first, are intersected with
   them. All windows go through each step together, in portions of bounded size.
3. `phrase_matches` returns the places where windows stand whole, `proximity_matches` those where an item's
   rarest terms stand near each other. Items are searched in blocks of a stated number of words.

Rules: NULL text has no words and an item without words no window; an item shorter than a window is one window;
repeated documents are searched each for itself; items of one id count as one; a NULL item_id is the empty id;
an empty table of documents gives no rows, one of items no hits; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revrec.llm.texts import BATCH_BYTES, documents, slices, small_batches
from revrec.sources.shared import materialise

WINDOW = 10
#: Words of items that are searched at once; they go to all tasks.
BLOCK_WORDS = 1 << 20
#: Candidate starts that a segment's task holds at once.
CANDIDATES = 1 << 20
#: Proximity: so many of an item's rarest terms within so many words of the rarest one.
NEAR_TERMS, NEAR_WORDS = 5, 20

_NEXT = b"."  # stands between texts: not a character of words
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_INDEX = "segment bigint, term binary, places binary, ids array<bigint>, sizes array<int>"
_MATCH = "segment bigint, doc int, doc_id bigint, item int, start bigint, end bigint"
_PLACE = 40  # bits of a place beside its term's number


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORDS).split()


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers as bytes of seven bits, the last one of each below 128; and the place after each number."""
    size = np.maximum(1, -(-np.frexp(values.astype(np.float64))[1] // 7))
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(int(size.max(initial=0))):
        own = np.flatnonzero(size > k)
        out[ends[own] - size[own] + k] = (values[own] >> (7 * k) & 127) | np.where(size[own] > k + 1, 128, 0)
    return out, ends


def unpacked(data: np.ndarray) -> np.ndarray:
    if not len(data):
        return np.empty(0, np.int64)
    last = np.flatnonzero(data < 128)
    first = np.concatenate([[0], last[:-1] + 1])
    shift = np.arange(len(data)) - np.repeat(first, np.diff(np.append(first, len(data))))
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * shift), first)


def _segment(texts: list[bytes | None], ids: pa.Array, number: int) -> pa.RecordBatch:
    joined = (b" " + _NEXT + b" ").join((t or b"").translate(_WORDS) for t in texts)
    coded = pc.split_pattern(pa.array([joined], pa.large_binary()), b" ").flatten().dictionary_encode()
    codes, terms = np.asarray(coded.indices, dtype=np.int64), coded.dictionary.cast(pa.large_binary())
    marks = {t: i for i, t in enumerate(terms.to_pylist()) if t in (b"", _NEXT)}
    codes = codes[codes != marks.get(b"", -1)]
    between = np.flatnonzero(codes == marks.get(_NEXT, -1))
    sizes = np.diff(np.concatenate([[-1], between, [len(codes)]])) - 1
    order = np.argsort(codes, kind="stable")
    order = order[codes[order] != marks.get(_NEXT, -1)]
    own = codes[order]
    head = np.concatenate([[True], own[1:] != own[:-1]]) if len(own) else np.empty(0, bool)
    data, ends = packed(np.where(head, order, np.diff(order, prepend=0)))
    heads = np.flatnonzero(head)
    cuts = np.concatenate([ends[heads] - np.diff(ends, prepend=0)[heads], [len(data)]]).astype(np.int64)
    places = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(heads), [None, pa.py_buffer(cuts), pa.py_buffer(data)])
    n = len(heads)
    lists = lambda values, kind: pa.array([None] * n + [values], pa.list_(kind))
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(n + 1, number), pa.int64()),
        pa.concat_arrays([terms.take(pa.array(own[heads])), pa.nulls(1, pa.large_binary())]).cast(pa.binary()),
        pa.concat_arrays([places, pa.nulls(1, pa.large_binary())]).cast(pa.binary()),
        lists(ids.to_pylist(), pa.int64()), lists(sizes.tolist(), pa.int32()),
    ], ["segment", "term", "places", "ids", "sizes"])


def build_index(docs: DataFrame) -> DataFrame:
    """(segment, term, places, ids, sizes): a row per term of each segment; with a NULL term its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch):
                made = _segment(part.column("text").cast(pa.large_binary()).to_pylist(), part.column("doc_id"), number)
                number += 1
                for at in range(0, len(made), 1 << 15):
                    yield made.slice(at, 1 << 15)

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with small_batches(docs.sparkSession, BATCH_BYTES):
        return materialise(slim.mapInArrow(run, _INDEX), "positions")


def indexed_documents(index: DataFrame) -> DataFrame:
    """(segment, doc, doc_id, n_words) of all documents in the index."""
    pairs = F.posexplode(F.arrays_zip("ids", "sizes")).alias("doc", "_d")
    return index.filter("term is null").select("segment", pairs).select(
        "segment", "doc", F.col("_d.ids").alias("doc_id"), F.col("_d.sizes").cast("bigint").alias("n_words"))


class Postings:
    """The places of a segment's test terms, as one sorted array of (term's number, place)."""

    def __init__(self, rows: pa.Table, numbers: dict[bytes, int]):
        documents = rows.filter(pc.is_null(rows.column("term")))
        self.ids = documents.column("ids")[0].as_py()
        sizes = np.array(documents.column("sizes")[0].as_py(), np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64)
        lists = rows.filter(pc.is_valid(rows.column("term")))
        held = sorted((numbers[t], p) for t, p in zip(lists.column("term").to_pylist(), lists.column("places").to_pylist()))
        data = np.frombuffer(b"".join(p for _, p in held), np.uint8)
        bytes_ = np.cumsum([0] + [len(p) for _, p in held])
        values = unpacked(data)
        # Numbers before each list: the bytes below 128 before it.
        before = np.concatenate([[0], np.cumsum(data < 128)])[bytes_]
        total = np.cumsum(values)
        base = np.concatenate([[0], total])[before[:-1]]
        self.places = total - np.repeat(base, np.diff(before))
        terms = np.array([n for n, _ in held], np.int64)
        self.keys = np.repeat(terms << _PLACE, np.diff(before)) | self.places
        self.first, self.count = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
        self.first[terms], self.count[terms] = before[:-1], np.diff(before)

    def holds(self, terms: np.ndarray, places: np.ndarray) -> np.ndarray:
        wanted = (terms << _PLACE) | np.maximum(places, 0)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return (places >= 0) & (self.keys[at] == wanted)

    def nearest(self, terms: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The place of each term that is nearest to a place, the earlier one of two; far away if it has none."""
        at = np.searchsorted(self.keys, (terms << _PLACE) | places)
        best = np.full(len(places), np.int64(1) << _PLACE)
        for side in (np.minimum(at, len(self.keys) - 1), np.maximum(at - 1, 0)):
            own = self.keys[side] >> _PLACE == terms
            place = self.keys[side] & ((1 << _PLACE) - 1)
            closer = own & (np.abs(place - places) <= np.abs(best - places))
            best = np.where(closer, place, best)
        return best

    def occurrences(self, terms: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All places of the terms, in portions: which of `terms`, and the place."""
        counts = self.count[terms]
        ends = np.cumsum(counts)
        at = 0
        while at < len(terms):
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + CANDIDATES, "right")))
            some = counts[at:stop]
            which = np.repeat(np.arange(at, stop), some)
            inner = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
            yield which, self.places[self.first[terms[which]] + inner]
            at = stop

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, "right") - 1


@dataclass
class Items:
    """A block of items: their ids, and their words by number of term."""

    ids: list[str]
    words: list[np.ndarray]
    numbers: dict[bytes, int]

    @classmethod
    def of(cls, rows: list[tuple[str, str | None]]) -> Items:
        numbers: dict[bytes, int] = {}
        words = [np.array([numbers.setdefault(w, len(numbers)) for w in words_of(t.encode() if t else b"")], np.int64) for _, t in rows]
        return cls([i for i, _ in rows], words, numbers)

    def windows(self, size: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """By length: the item of each window, and its terms."""
        out: dict[int, list] = {}
        for item, own in enumerate(self.words):
            n = min(size, len(own))
            if n:
                out.setdefault(n, []).append((item, np.lib.stride_tricks.sliding_window_view(own, n)))
        return {n: (np.concatenate([np.full(len(w), i) for i, w in v]), np.concatenate([w for _, w in v])) for n, v in out.items()}


def _whole(held: Postings, owner: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(item, start) of every place where a window's terms stand one after the other."""
    there = (held.count[terms] > 0).all(axis=1)
    owner, terms = owner[there], terms[there]
    order = np.argsort(held.count[terms], axis=1, kind="stable")
    rarest = np.take_along_axis(terms, order, axis=1)
    items, starts = [], []
    for which, place in held.occurrences(rarest[:, 0]) if len(terms) else ():
        start = place - order[which, 0]
        for k in range(1, terms.shape[1]):
            own = held.holds(rarest[which, k], start + order[which, k])
            which, start = which[own], start[own]
        ok = start >= 0
        items.append(owner[which[ok]])
        starts.append(start[ok])
    return (np.concatenate(items), np.concatenate(starts)) if items else (np.empty(0, np.int64), np.empty(0, np.int64))


def _matched(index: DataFrame, items: Items, find: Callable[[Postings], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> DataFrame:
    """Rows of _MATCH from what `find` gives of a segment: (item, start, end) in places of the segment."""
    numbers = items.numbers

    def run(rows: pa.Table) -> pa.Table:
        held = Postings(rows, numbers)
        item, start, end = find(held) if len(held.keys) else [np.empty(0, np.int64)] * 3
        doc = held.document(start)
        ids = pa.array(held.ids, pa.int64())
        return pa.Table.from_arrays([
            pa.array(np.full(len(item), rows.column("segment")[0].as_py()), pa.int64()), pa.array(doc, pa.int32()), ids.take(pa.array(doc)),
            pa.array(item, pa.int32()), pa.array(start - held.starts[doc], pa.int64()), pa.array(end - held.starts[doc], pa.int64()),
        ], ["segment", "doc", "doc_id", "item", "start", "end"])

    spark = index.sparkSession
    terms = spark.createDataFrame([(bytearray(t),) for t in numbers], "term binary")
    # Rows of documents come along, so that every segment of a group knows where its texts begin.
    wanted = index.join(terms, "term", "left_semi").unionByName(index.filter("term is null"))
    found = wanted.groupBy("segment").applyInArrow(run, _MATCH)
    names = spark.createDataFrame(list(enumerate(items.ids)), "item int, item_id string")
    return found.join(names, "item").drop("item")


def _blocks(items: DataFrame, block_words: int) -> Iterator[Items]:
    """Items in blocks of about so many words; one block is on the driver at a time."""
    slim = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("string").alias("text"))
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // (8 * block_words)))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for k in range(count):
        yield Items.of([tuple(r) for r in (slim.filter(block == k) if count > 1 else slim).collect()])


def _over_blocks(index: DataFrame, items: DataFrame, block_words: int, match: Callable[[Items], DataFrame]) -> DataFrame:
    parts = [match(own) for own in _blocks(items, block_words)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def phrase_matches(index: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(segment, doc, doc_id, start, end, item_id): the stretches of words that windows of an item cover.

    `items` has item_id and text. Occurrences of one item that overlap or touch are one stretch.
    """

    def match(items: Items) -> DataFrame:
        windows = items.windows(window)

        def find(held: Postings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            out = []
            for size, (owner, terms) in windows.items():
                item, start = _whole(held, owner, terms)
                order = np.lexsort((start, item))
                item, start = item[order], start[order]
                new = np.concatenate([[True], (item[1:] != item[:-1]) | (start[1:] > start[:-1] + size)]) if len(item) else np.empty(0, bool)
                head = np.flatnonzero(new)
                last = np.append(head[1:], len(item)) - 1 if len(head) else head
                out.append((item[head], start[head], start[last] + size))
            return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 3

        return _matched(index, items, find)

    return _over_blocks(index, items, block_words, match)


def proximity_matches(index: DataFrame, items: DataFrame, terms: int = NEAR_TERMS, within: int = NEAR_WORDS,
                      block_words: int = BLOCK_WORDS) -> DataFrame:
    """(segment, doc, doc_id, start, end, item_id): where all of an item's `terms` rarest words (of those that the
    segment ranks by their number there) stand at most `within` words from the rarest one, in any order.

    One row for each such place of the rarest word, from the first to the last of the nearest places; items with
    a word among them that the segment lacks have none there.
    """

    def match(items: Items) -> DataFrame:
        distinct = [np.unique(w) for w in items.words]

        def find(held: Postings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            out = []
            by_size: dict[int, list] = {}
            for item, own in enumerate(distinct):
                if len(own):
                    rare = own[np.argsort(held.count[own], kind="stable")][:terms]
                    if held.count[rare].all():
                        by_size.setdefault(len(rare), []).append((item, rare))
            for found in by_size.values():
                owner, rare = np.array([i for i, _ in found]), np.stack([r for _, r in found])
                for which, place in held.occurrences(rare[:, 0]):
                    low, high, doc = place.copy(), place.copy(), held.document(place)
                    near = np.ones(len(place), bool)
                    for k in range(1, rare.shape[1]):
                        other = held.nearest(rare[which, k], place)
                        near &= (np.abs(other - place) <= within) & (held.document(other) == doc)
                        low, high = np.minimum(low, other), np.maximum(high, other)
                    out.append((owner[which[near]], low[near], high[near] + 1))
            return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 3

        return _matched(index, items, find)

    return _over_blocks(index, items, block_words, match)


def contaminated(index: DataFrame, matches: DataFrame) -> DataFrame:
    """(segment, doc, doc_id, n_words, n_hit, items): words inside any match, and the matching items, of all documents."""
    before = W.partitionBy("segment", "doc").orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1)
    seen = F.coalesce(F.max("end").over(before), F.lit(0))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", seen))
    hits = matches.withColumn("_fresh", fresh).groupBy("segment", "doc").agg(
        F.sum("_fresh").alias("n_hit"), F.array_sort(F.collect_set("item_id")).alias("items"))
    return indexed_documents(index).join(hits, ["segment", "doc"], "left").select(
        "segment", "doc", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(documents(spark, sf_dir))
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contaminated(index, phrase_matches(index, items)).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP12_SQL = r"""
WITH words AS (
    SELECT row_number() OVER () AS rid, doc_id,
           list_filter(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
    FROM documents
), items AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
           list_filter(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
    FROM benchmark
), sized AS (
    SELECT item, w, least(10, len(w)) AS k FROM items WHERE len(w) > 0
), starts AS (
    SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM sized
), windows AS (
    SELECT DISTINCT item, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS gram FROM starts
), places AS (
    SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k
), hits AS (
    SELECT p.rid, p.i, p.k, x.item FROM places p
    JOIN windows x ON x.k = p.k AND x.gram = array_to_string(list_slice(p.w, p.i, p.i + p.k - 1), ' ')
), covered AS (
    SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS pos FROM hits) GROUP BY rid
), found AS (
    SELECT rid, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS names FROM hits GROUP BY rid
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(f.n_items, 0) AS n_items,
       sha256(coalesce(f.names, '')) AS items_sha256, c.n_hit IS NOT NULL AS contaminated
FROM words d LEFT JOIN covered c USING (rid) LEFT JOIN found f USING (rid)
"""

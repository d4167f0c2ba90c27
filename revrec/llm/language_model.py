"""Interpolated modified Kneser-Ney model of n-grams, counted in Spark, scored from mapped arrays.

1. Words are counted per batch and summed by their 64-bit hash. The hashes are ranged, sorted and written
   as arrays; a word's id is its place in them. A text is preceded by n - 1 begins and followed by an end.
2. n-grams are counted per batch and dealt to buckets by their inner words (pairs by the first word), those
   of frequent words to several. A bucket merges its runs and writes the n-grams' 64-bit hashes, sorted,
   and counts as arrays. It passes on what it knows of grams one word shorter: how many n-grams end in one
   (its count in the lower order), and of those that begin with it their number by count (1, 2, 3 and more)
   and their sum. Such facts are dealt and merged in the same way, down to words: written once by turns of
   buckets, and a turn is deleted when it has been merged, as are the files of a shuffle when its job ends.
3. The facts on words are laid out by word id. Workers map all arrays and look up sorted batches of grams.

    p(w|h) = max(c(hw) - D(c), 0) / c(h.) + (D1 n1(h) + D2 n2(h) + D3 n3(h)) / c(h.) * p(w|h')
    p(w) = max(t(w) - E(t), 0) / T + (E1 t1 + E2 t2 + E3 t3) / T / (V + 1)

with h' the history less its first word, c the count in the highest order and in a lower one the number of
distinct words before, t(w) the number of distinct words before w; D differ by order. A history not seen
leaves p(w|h'); a word not seen in training has the last term alone. Over the V words and the unknown one
the probabilities of a history sum to 1. Grams whose 64-bit hashes agree are taken for one.

Rules: NULL text is empty and is the end alone; the fold of a NULL doc_id is that of an empty id; with
no training text every word is unknown (p = 1) and the base divides by its smoothed total; repeated
rows count and are scored as often as they stand there; extra columns are ignored; an order below 2 is an error.
"""

from __future__ import annotations

import math
import mmap
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revrec.llm import arrays
from revrec.llm.texts import documents, fold, slices, small_batches, sparing, whole
from revrec.sources.shared import drop, drop_part, materialise, new_path, swept

#: Words of a gram, its last word included.
ORDER = 3
#: Tokens for each bucket of grams, on average, and buckets for each task that merges them.
BUCKET_TOKENS, TASK_BUCKETS = 1 << 20, 4
#: Turns in which the buckets of shorter grams are merged, so that a share of their runs is on disk twice; buckets of a turn at least.
TURNS, TURN_BUCKETS = 4, 4 * TASK_BUCKETS
#: Bytes of text that are scored at once: about 600,000 places with their grams' facts.
SCORED_BYTES = 4 << 20
SMOOTH = 0.5
_END, _BEGIN = b"", b" "  # no word can be either


def _hash(word: bytes) -> int:
    import xxhash

    value = xxhash.xxh64_intdigest(word)
    return value - (1 << 64) if value >> 63 else value


def _hashes(words: pa.Array) -> np.ndarray:
    """`_hash` of each word."""
    import xxhash

    words = words.cast(pa.large_binary())
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1].tolist()
    held = memoryview(data or b"")
    return np.fromiter((xxhash.xxh64_intdigest(held[a:b]) for a, b in zip(ends, ends[1:])), np.uint64, len(words)).view(np.int64)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends of the texts in the tokens, index of every token (end included), hashes of the distinct ones."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat = lists.flatten()
    coded = flat.dictionary_encode()
    words = coded.dictionary
    hashes = np.append(_hashes(words), np.int64(_hash(_END)))
    index = np.asarray(coded.indices, dtype=np.int64)
    sizes = np.asarray(pc.list_value_length(lists), dtype=np.int64)
    # White space at the edges of a text leaves empty words.
    real = (np.asarray(pc.binary_length(words)) > 0)[index] if len(index) else np.empty(0, bool)
    owner = np.repeat(np.arange(len(sizes)), sizes)[real]
    sizes = np.bincount(owner, minlength=len(sizes))
    ends = np.cumsum(sizes)
    index = np.insert(index[real], ends, len(words))
    return ends + np.arange(1, len(ends) + 1), index, hashes


def _hashes_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def count_words(docs: DataFrame) -> DataFrame:
    """(hash, n, documents): tokens by hash; the end stands in every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                _, index, hashes = tokens(whole(part.column("text")))
                counts = np.bincount(index, minlength=len(hashes))
                yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(counts)], ["hash", "n"])

    partial = _hashes_of(docs).select("text").mapInArrow(sparing(run), "hash bigint, n bigint")
    return partial.groupBy("hash").agg(F.sum("n").alias("n"))


def _order(keys: np.ndarray) -> np.ndarray:
    """Places of unsigned keys in their order: sorted by the upper bits with the place as lower ones, which takes a
    fraction of the time; the few neighbours that differ in lower bits alone change places."""
    shift = np.uint64(len(keys).bit_length())
    packed = keys >> shift << shift | np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    order = (packed & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
    for _ in range(4):
        held = keys[order]
        wrong = np.flatnonzero(held[1:] < held[:-1])
        if not len(wrong):
            return order
        if (np.diff(wrong) == 1).any():
            break
        order[wrong], order[wrong + 1] = order[wrong + 1], order[wrong]
    return np.argsort(keys)


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the keys in their order, the distinct ones, and where each begins in that order."""
    order = _order(keys)
    held = keys[order]
    starts = np.flatnonzero(np.append(True, held[1:] != held[:-1])) if len(keys) else order
    return order, held[starts], starts


def _places(parts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each number of a part, 0 at least, with its places in order; numbers below 0 have none."""
    small = parts.astype(np.uint16) if parts.max(initial=0) < 1 << 16 and parts.min(initial=0) >= 0 else parts
    order = np.argsort(small, kind="stable")
    held = parts[order]
    starts = np.flatnonzero(np.diff(held, prepend=-2))
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(order)]):
        if held[a] >= 0:
            yield int(held[a]), order[a:b]


class Vocabulary:
    """Sorted hashes with counts, in files by range; a word's id is its place."""

    def __init__(self, files: list[tuple]):
        self.files = files
        self.low = np.array([f[1] for f in files], np.int64)
        self.base = np.concatenate([[0], np.cumsum([f[2] for f in files])]).astype(np.int64)
        self.size = int(self.base[-1])

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Id of each hash, -1 where it has none. Sorted first, so that the files are read in order."""
        order = np.argsort(hashes)
        wanted, out = hashes[order], np.full(len(hashes), -1, np.int64)
        at = np.searchsorted(self.low, wanted, "right") - 1
        for k in np.unique(at[at >= 0]).tolist():
            a, b = np.searchsorted(at, [k, k + 1])
            held = _map(self.files[k][3], "hash", "<i8", self.files[k][2])
            place = np.minimum(np.searchsorted(held, wanted[a:b]), len(held) - 1)
            out[order[a:b]] = np.where(held[place] == wanted[a:b], self.base[k] + place, -1)
        return out

    def take(self, name: str, kind: str, ids: np.ndarray, files: list[tuple] | None = None) -> np.ndarray:
        """A column's values by id, 0 where the id is -1."""
        out = np.zeros(len(ids), kind)
        at = np.searchsorted(self.base, ids, "right") - 1
        for k, own in _places(at):
            held = _map((files or self.files)[k][3], name, kind, self.files[k][2])
            out[own] = held[ids[own] - self.base[k]]
        return out


_open: dict[tuple, np.ndarray] = {}


def _map(path: str, name: str, kind: str, rows: int) -> np.ndarray:
    key = (path, name)
    if key not in _open:
        if len(_open) > 4096:
            _open.clear()
        _open[key] = arrays.mapped(path, name, kind, rows)
    return _open[key]


def _release() -> None:
    """Pages of the mapped files that this worker has looked at leave its memory; the machine's cache keeps them."""
    for held in _open.values():
        if isinstance(held, np.memmap):
            held._mmap.madvise(mmap.MADV_DONTNEED)


def _written(files: DataFrame) -> list[tuple]:
    """Rows of a table of files, in order: one row per file."""
    return sorted(tuple(r) for r in materialise(files, "files").collect())


def write_vocabulary(counts: DataFrame, folder: str) -> Vocabulary:
    names = [c for c in counts.columns if c != "hash"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, *rest = arrays.columns(batches, "hash", *names)
        if len(hashes):
            own = {"hash": hashes.astype("<i8")} | {n: v.astype("<i8") for n, v in zip(names, rest)}
            yield arrays.save(folder, TaskContext.get().partitionId(), own, int(hashes[0]))

    ranged = counts.repartitionByRange("hash").sortWithinPartitions("hash")
    return Vocabulary(_written(ranged.mapInArrow(run, arrays.FILES)))


def gram_keys(columns: Sequence[np.ndarray]) -> np.ndarray:
    """64-bit hash of each gram, given its words' ids column by column."""
    keys = np.zeros(len(columns[0]), np.uint64)
    for ids in columns:
        keys ^= ids.astype(np.uint64) + np.uint64(1)
        for factor in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93):
            keys *= np.uint64(factor)
            keys ^= keys >> np.uint64(32)
    return keys


@dataclass
class Dealer:
    """Deals grams to buckets, so that a bucket has about as many tokens on any input."""

    words: Vocabulary
    texts: int
    buckets: int
    share: float

    def often(self, ids: np.ndarray) -> np.ndarray:
        """Tokens of each word; the begin, whose id follows the last word's, stands before every text."""
        begin = ids == self.words.size
        return np.where(begin, self.texts, self.words.take("n", "<i8", np.where(begin, -1, ids)))

    def __call__(self, columns: Sequence[np.ndarray], often: Sequence[np.ndarray] | None = None) -> np.ndarray:
        """Bucket of each gram: by its inner words, so that what it tells of both its shorter grams meets
        others that do. Where these are frequent, by one more word too. `often` is that of every word, where
        the caller has it."""
        inner, other = (slice(1, -1), columns[0]) if len(columns) > 2 else (slice(0, 1), columns[1])
        counts = np.min(often[inner] if often else [self.often(c) for c in columns[inner]], axis=0)
        inner = columns[inner]
        spread = np.maximum(1, np.ceil(counts / self.share)).astype(np.uint64)
        salt = (gram_keys([other]) >> np.uint64(33)) % spread
        return ((gram_keys([*inner, salt]) >> np.uint64(33)) % np.uint64(self.buckets)).astype(np.int64)


@dataclass
class Model:
    """What workers need: lists of files and a few numbers."""

    words: Vocabulary
    dealer: Dealer
    stats: list[tuple]
    grams: dict[tuple[int, int], tuple]  # by order and bucket: widths, rows, path
    order: int
    tokens: int
    types: int
    discounts: dict[int, tuple[float, float, float]]
    ends: tuple[float, float, float]
    rest: float


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of counts 1 to 4; half where they can't be told."""
    if not (n1 and n2):
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    own = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.5)
    return tuple(min(max(d, 0.0), float(k)) for k, d in enumerate(own, 1))


def _windows(part: pa.RecordBatch, words: Vocabulary, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Ends of the texts, index of each token, ids of the distinct ones and of the begin, and for each token
    the indexes of the words before it, farthest first, and its own."""
    ends, index, hashes = tokens(whole(part.column("text")))
    ids = np.append(words.ids(hashes), words.size)
    sizes = np.diff(ends, prepend=0)
    place = np.arange(len(index)) - np.repeat(ends - sizes, sizes)
    columns = [index]
    for back in range(1, order):
        earlier = np.roll(index, back)
        earlier[place < back] = len(hashes)
        columns.append(earlier)
    return ends, index, ids, columns[::-1]


_ZSTD = pa.Codec("zstd", 1)


def _pack(values: np.ndarray) -> bytes:
    """Values of at least 0, byte by byte of the least width that holds them, compressed; behind the width and their number."""
    width = _width(values)
    planes = np.ascontiguousarray(values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)
    return bytes([width]) + len(values).to_bytes(8, "little") + _ZSTD.compress(planes.tobytes(), asbytes=True)


def _unpack(blobs: list[bytes]) -> np.ndarray:
    out = []
    for blob in blobs:
        width, size = blob[0], int.from_bytes(blob[1:9], "little")
        planes = np.frombuffer(_ZSTD.decompress(blob[9:], width * size, asbytes=True), np.uint8).reshape(width, size)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int64))
    return np.concatenate(out)


def _width(values: np.ndarray) -> int:
    most = int(values.max(initial=0))
    return next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)


#: What a bucket's arrays hold beside the hashes; the highest order has the count alone.
_FACTS = ("count", "n1", "n2", "n3", "total")
_SCHEMA = pa.schema(
    [("bucket", pa.int64()), ("columns", pa.list_(pa.binary())), ("id", pa.int64())]
    + [(n, pa.int64()) for n in (*_FACTS, "spectrum", "degree", "part", "low", "rows")] + [("path", pa.string())]
)
_KINDS = "bucket bigint, columns array<binary>, id bigint, " + ", ".join(
    f"{n} bigint" for n in (*_FACTS, "spectrum", "degree", "part", "low", "rows")) + ", path string"


def _rows(size: int, /, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in _SCHEMA], schema=_SCHEMA)


def _runs(columns: Sequence[np.ndarray], facts: Sequence[np.ndarray], dealer: Dealer,
          often: Sequence[np.ndarray] | None = None) -> pa.RecordBatch:
    """One row per bucket with its grams' words and facts, in order of their inner word, which packs it best."""
    bucket = dealer(columns, often)
    order = np.argsort(columns[(len(columns) - 1) // 2])
    parts = [(k, order[own]) for k, own in _places(bucket[order])]
    return _rows(len(parts), bucket=[k for k, _ in parts], columns=[[_pack(c[o]) for c in (*columns, *facts)] for _, o in parts])


def _summed(columns: Sequence[np.ndarray], facts: Sequence[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Hashes of the distinct grams in order, their words and the sums of their facts."""
    order, keys, starts = _grouped(gram_keys(columns))
    first = order[starts]
    return keys, [c[first] for c in columns], [np.add.reduceat(v[order], starts) if len(keys) else v for v in facts]


def _saved(folder: str, part: int, facts: dict[str, np.ndarray], others: dict[str, np.ndarray] | None = None) -> pa.RecordBatch:
    """Writes facts in the least width each; the row that lists the file tells the widths, four bits each."""
    widths = {n: _width(v) for n, v in facts.items()}
    held = {n: v.astype(f"<u{widths[n]}") for n, v in facts.items()}
    return arrays.save(folder, part, (others or {}) | held, sum(w << 4 * _FACTS.index(n) for n, w in widths.items()))


def _fact(path: str, name: str, low: int, rows: int) -> np.ndarray:
    return _map(path, name, f"<u{low >> 4 * _FACTS.index(name) & 15}", rows)


def count_grams(docs: DataFrame, dealer: Dealer, order: int, folder: str) -> DataFrame:
    """Writes the grams' arrays by order and bucket; gives facts by word id, spectra and lists of the files."""
    words = dealer.words

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                _, _, ids, columns = _windows(part, words, order)
                places, _, starts = _grouped(gram_keys([ids[c] for c in columns]))
                if len(starts):
                    first, often = places[starts], dealer.often(ids)
                    distinct = [c[first] for c in columns]
                    yield _runs([ids[c] for c in distinct], [np.diff(starts, append=len(places))], dealer, [often[c] for c in distinct])

    def merged(degree: int, bucket: int, rows: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
        columns = [_unpack(list(blobs)) for blobs in zip(*rows)]
        rows.clear()
        keys, ids, facts = _summed(columns[:degree], columns[degree:])
        del columns
        listed = _saved(f"{folder}/{degree}", bucket, dict(zip(_FACTS, facts)), {"key": keys.astype("<u8")})
        yield _rows(1, degree=[degree], part=[bucket], low=listed.column("low"), rows=[len(keys)], path=listed.column("path"))
        count = facts[0]
        yield _rows(4, degree=[degree] * 4, low=[1, 2, 3, 4], spectrum=[int((count == k).sum()) for k in (1, 2, 3, 4)])
        # A gram that was never counted itself (of begins alone) tells nothing of shorter ones.
        seen = count > 0
        ids, count = [c[seen] for c in ids], count[seen]
        none, one = np.zeros(len(count), np.int64), np.ones(len(count), np.int64)
        begins = [none, count == 1, count == 2, count >= 3, count]
        lower = [np.concatenate(c) for c in zip(ids[:-1], ids[1:])]
        about = [np.concatenate([b, e]) for b, e in zip(begins, [one, none, none, none, none])]
        if not len(count):
            return
        _, shorter, sums = _summed(lower, about)
        if degree > 2:
            yield _runs(shorter, sums, dealer)
        else:
            yield _rows(len(shorter[0]), id=shorter[0], **dict(zip(_FACTS, sums)))

    def merge(degree: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bucket, rows = None, []
            for batch in batches:
                for k, own in enumerate(batch.column("bucket").to_pylist()):
                    if own != bucket and rows:
                        yield from merged(degree, bucket, rows)
                    bucket = own
                    rows.append(batch.column("columns")[k].as_py())
            if rows:
                yield from merged(degree, bucket, rows)

        return run

    turns = max(1, min(TURNS, dealer.buckets // TURN_BUCKETS))
    # Parts below 0 stay: lists and spectra, few rows, and facts by word.
    turn = F.when(F.col("id").isNotNull(), -2).when(F.col("columns").isNull(), -1).otherwise(F.pmod("bucket", F.lit(turns))).cast("int")

    def written(degree: int, runs: DataFrame, share: int) -> DataFrame:
        tasks = max(1, dealer.buckets // (TASK_BUCKETS * share))
        out = runs.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(sparing(merge(degree)), _KINDS)
        return materialise(out.withColumn("turn", turn), "grams", ["turn"])

    with small_batches(docs.sparkSession):
        tables = [written(order, _hashes_of(docs).select("text").mapInArrow(sparing(emit), _KINDS), 1)]
        last = tables
        for degree in range(order - 1, 1, -1):
            merging, last = last, []
            for k in range(turns):
                own = F.col("turn") == k
                last.append(written(degree, reduce(DataFrame.unionByName, [t.filter(own) for t in merging]).drop("turn"), turns))
                for table in merging:
                    drop_part(table, f"turn={k}")
            tables += last
    return reduce(DataFrame.unionByName, [t.filter("turn < 0") for t in tables])


def train(docs: DataFrame, order: int = ORDER) -> Model:
    """Counts all of `docs` and writes the model's arrays to the shared folder."""
    if order < 2:
        raise ValueError("a model needs an order of 2 at least")
    with swept(docs.sparkSession):
        return _trained(docs, order)


def _trained(docs: DataFrame, order: int) -> Model:
    spark = docs.sparkSession
    counts = materialise(count_words(docs), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    end = counts.filter(F.col("hash") == _hash(_END)).first()
    words = write_vocabulary(counts, new_path(spark, "vocabulary"))
    drop(counts)
    buckets = max(1, math.ceil(total / BUCKET_TOKENS))
    dealer = Dealer(words, end["n"] if end else 0, buckets, max(1.0, total / buckets / 4))
    raw = count_grams(docs, dealer, order, new_path(spark, "grams-by-bucket"))
    files = raw.filter("turn = -1 AND path IS NOT NULL").select("degree", "part", "low", "rows", "path").collect()
    seen = raw.filter("turn = -1 AND spectrum IS NOT NULL").groupBy("degree", "low").agg(F.sum("spectrum").alias("n")).collect()
    spectrum = {(r["degree"], r["low"]): r["n"] for r in seen}
    stats = materialise(raw.filter("turn = -2").groupBy("id").agg(*[F.sum(c).alias(c) for c in _FACTS]), "statistics")
    drop(raw)
    ended = F.col("count")
    t = stats.agg(
        F.sum(ended).alias("all"), *[F.sum((ended == k).cast("long")).alias(f"t{k}") for k in (1, 2, 3, 4)],
        F.sum((ended >= 3).cast("long")).alias("more"),
    ).first()
    d = {k: discounts(*[spectrum.get((k, j), 0) for j in (1, 2, 3, 4)]) for k in range(2, order + 1)}
    e = discounts(*[t[f"t{k}"] or 0 for k in (1, 2, 3, 4)])
    rest = e[0] * (t["t1"] or 0) + e[1] * (t["t2"] or 0) + e[2] * (t["more"] or 0)
    laid = _write_stats(stats, words, new_path(spark, "by-word"))
    drop(stats)
    grams = {(f["degree"], f["part"]): (f["low"], f["rows"], f["path"]) for f in files}
    return Model(words, dealer, laid, grams, order, total, t["all"] or 0, d, e, rest)


def _write_stats(stats: DataFrame, words: Vocabulary, folder: str) -> list[tuple]:
    """Arrays by word id, in the vocabulary's ranges; the begin's row is the last file's last."""
    spread = [*words.base.tolist()]
    spread[-1] += 1
    bounds = F.array(*[F.lit(b).cast("bigint") for b in spread[1:]]) if len(spread) > 1 else F.array(F.lit(1).cast("bigint"))
    part = F.size(F.filter(bounds, lambda b: b <= F.col("id")))
    tasks = max(1, len(words.files))
    base = words.base

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, ids, *rest = arrays.columns(batches, "owner", "id", *_FACTS)
        for k in np.unique(owner).tolist():
            own = owner == k
            size = spread[k + 1] - spread[k] if len(spread) > 1 else 1
            columns = {}
            for name, values in zip(_FACTS, rest):
                columns[name] = np.zeros(size, "<i8")
                columns[name][ids[own] - base[k]] = values[own]
            yield _saved(folder, k, columns)

    placed = stats.withColumn("owner", part.cast("bigint")).repartition(tasks, "owner")
    return _written(placed.mapInArrow(run, arrays.FILES))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score): base 10 logarithms of whole texts."""
    files = {f[0]: f for f in model.stats}

    def by_id(names: Sequence[str], ids: np.ndarray) -> list[np.ndarray]:
        """Facts on each word, 0 where the id is -1; the begin stands behind the last word."""
        out, words = [np.zeros(len(ids), np.int64) for _ in names], model.words
        at = np.minimum(np.searchsorted(words.base, ids, "right") - 1, max(0, len(words.files) - 1))
        for k, own in _places(np.where(ids >= 0, at, -1)):
            if k in files:
                for values, name in zip(out, names):
                    values[own] = _fact(files[k][3], name, files[k][1], files[k][2])[ids[own] - words.base[k]]
        return out

    def facts(names: Sequence[str], keys: np.ndarray, columns: Sequence[np.ndarray], often: Sequence[np.ndarray]) -> list[np.ndarray]:
        """Facts on distinct grams of known words in order of their keys, 0 where a gram was not seen."""
        # Keys ascend, and stay so within a bucket.
        out = [np.zeros(len(keys), np.int64) for _ in names]
        for bucket, own in _places(model.dealer(columns, often)):
            listed = model.grams.get((len(columns), bucket))
            if listed is None:
                continue
            low, rows, path = listed
            held = _map(path, "key", "<u8", rows)
            wanted = keys[own]
            place = np.minimum(np.searchsorted(held, wanted), rows - 1)
            found = held[place] == wanted
            own, place = own[found], place[found]
            for values, name in zip(out, names):
                values[own] = _fact(path, name, low, rows)[place]
        return out

    def of_places(names: Sequence[str], columns: Sequence[np.ndarray], ids: np.ndarray, often: np.ndarray) -> list[np.ndarray]:
        """Facts on the gram of each place, given its words' indexes in `ids`; every distinct one is looked up once."""
        order, keys, starts = _grouped(gram_keys([ids[c] for c in columns]))
        at = np.empty(len(order), np.int64)
        at[order] = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(order)))
        distinct = [c[order[starts]] for c in columns]
        return [values[at] for values in facts(names, keys, [ids[c] for c in distinct], [often[c] for c in distinct])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=SCORED_BYTES):
                yield _scored(part)
                _release()

    def _scored(part: pa.RecordBatch) -> pa.RecordBatch:
        ends, index, ids, windows = _windows(part, model.words, model.order)
        counts = model.words.take("n", "<i8", ids[:-1])
        base = np.log10((counts + SMOOTH) / (model.tokens + SMOOTH * (model.words.size + 1)))
        p = _lower(by_id(["count"], ids[:-1])[0], model)[index]
        starts = np.concatenate([[0], ends[:-1]])
        some = len(ends) > 0
        often, begin = np.append(counts, model.dealer.texts), np.array([len(ids) - 1])
        # Places whose history is known so far back; it is longer by a word with every order.
        known, word = np.arange(len(index)), ids[index] >= 0
        history = [values[windows[-2]] for values in by_id(_FACTS[1:], ids)]
        for degree in range(2, model.order + 1):
            known = known[ids[windows[-degree][known]] >= 0]
            real = known[word[known]]
            names = _FACTS if degree < model.order else _FACTS[:1]
            count, *others = of_places(names, [w[real] for w in windows[-degree:]], ids, often)
            c = np.zeros(len(index), np.int64)
            c[real] = count
            p[known] = _interpolated(c[known], [values[known] for values in history], p[known], model.discounts[degree])
            # The next order's history is the gram of the place before; at a text's first word it is begins alone.
            first = of_places(_FACTS[1:], [begin] * degree, ids, often) if others else []
            for values, own, alone in zip(history, others, first):
                values[:] = 0
                values[real] = own
                values[1:] = values[:-1].copy()
                values[starts] = alone
        logs = np.log10(p)

        def per_text(values: np.ndarray) -> np.ndarray:
            return np.add.reduceat(values, starts) if some else values[:0]

        found = (counts[index] > 0).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(ends - starts), pa.array(per_text(found)), pa.array(per_text(base[index])), pa.array(per_text(logs))],
            ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return _hashes_of(docs).mapInArrow(sparing(run), "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double")


def _interpolated(c: np.ndarray, history: Sequence[np.ndarray], lower: np.ndarray, cuts: tuple[float, float, float]) -> np.ndarray:
    """p(w|h) from the gram's count, the history's facts and p(w|h')."""
    (n1, n2, n3, total), (d1, d2, d3) = history, cuts
    cut = np.select([c == 0, c == 1, c == 2], [0.0, d1, d2], d3)
    return np.where(total > 0, (c - cut + (d1 * n1 + d2 * n2 + d3 * n3) * lower) / np.maximum(total, 1), lower)


def _lower(ended: np.ndarray, model: Model) -> np.ndarray:
    """p(w) by the number of distinct words before it; 1 where nothing was learnt."""
    if not model.types:
        return np.ones(len(ended))
    e1, e2, e3 = model.ends
    cut = np.select([ended == 0, ended == 1, ended == 2], [0.0, e1, e2], e3)
    return (ended - cut + model.rest / (model.words.size + 1)) / model.types


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == 1


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )

"""Approximate nearest neighbours with a hash-prefix forest.

Every vector gets one long bit string per tree, from the signs of its products with random directions
(after the mean of all vectors is taken off). A tree is the sorted array of its strings. A query
descends in every tree to the longest prefix that any entry shares with it, and all trees then ascend
together, a bit at a time, until the entries below hold the wanted number of candidates. Those are
compared by exact Euclidean distance. More than k items are always among them, where there are so many.

Items lie in blocks of bounded size by the digest of their id, each with a forest of its own; blocks of
queries meet blocks of items, and k results per query leave a meeting. Where a block has fewer items
than wanted candidates all of them are compared.

Rules: vectors that are NULL or zero or hold NULL or non-finite components take no part, nor do rows
without an id; of rows with one id the least vector counts; only vectors of the same length meet; a query's
own id is never its neighbour; fewer than k others are all returned; ties go to the smaller id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revrec.operators.ordering import top_n
from revrec.sources.shared import materialise

K, TREES, BITS, SEED = 10, 48, 32, 7
#: Candidates wanted, as entries over all trees (an item may be found in several), per item of a block.
DEPTH = 0.6
ITEM_BLOCK, QUERY_BLOCK = 8192, 1024


def usable(vector: Column) -> Column:
    """Neither NULL, empty or zero nor with NULL, NaN or infinite components."""
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~wrong & F.exists(vector, lambda x: x != 0), F.lit(False))


class Forest:
    """Sorted hash strings of a block, one array per tree."""

    def __init__(self, vectors: np.ndarray, mean: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = SEED):
        self.trees, self.bits, self.mean = trees, bits, mean
        self.directions = np.random.default_rng(seed).standard_normal((vectors.shape[1], trees * bits))
        hashed = self.strings(vectors)
        self.order = [np.argsort(hashed[:, t], kind="stable") for t in range(trees)]
        self.sorted = [hashed[o, t] for t, o in enumerate(self.order)]

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        """Bit strings as numbers, first bit highest; one column per tree."""
        weights = (np.uint64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.uint64))
        out = np.empty((len(vectors), self.trees), np.uint64)
        for at in range(0, len(vectors), 2048):
            signs = (vectors[at:at + 2048] - self.mean) @ self.directions > 0
            out[at:at + 2048] = (signs.reshape(-1, self.trees, self.bits) * weights).sum(axis=2)
        return out

    def _span(self, strings: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Per query and tree, the entries that share the first `depth` bits."""
        drop = np.uint64(self.bits - depth)
        low = strings >> drop << drop
        last = low | np.uint64((1 << (self.bits - depth)) - 1)
        a = np.column_stack([np.searchsorted(s, low[:, t], "left") for t, s in enumerate(self.sorted)])
        b = np.column_stack([np.searchsorted(s, last[:, t], "right") for t, s in enumerate(self.sorted)])
        return a, b

    def candidates(self, queries: np.ndarray, wanted: float, least: int = 1) -> Iterator[np.ndarray]:
        """Item places of each query: deepest level at which all trees together hold `wanted` entries
        and one of them `least`, which are that many items."""
        strings = self.strings(queries)
        a, b = np.zeros((2, len(queries), self.trees), np.int64)
        waiting = np.arange(len(queries))
        # The longest match of any tree bounds where the ascent begins.
        for depth in range(self._longest(strings), -1, -1):
            if not len(waiting):
                break
            low, high = self._span(strings[waiting], depth)
            held = high - low
            enough = (held.sum(axis=1) >= wanted) & (held.max(axis=1) >= least) | (depth == 0)
            a[waiting[enough]], b[waiting[enough]] = low[enough], high[enough]
            waiting = waiting[~enough]
        for low, high in zip(a, b):
            seen = np.zeros(len(self.order[0]), bool)
            for t, (x, y) in enumerate(zip(low.tolist(), high.tolist())):
                seen[self.order[t][x:y]] = True
            yield np.flatnonzero(seen)

    def _longest(self, strings: np.ndarray) -> int:
        """Greatest number of leading bits that a query shares with an entry, over all trees."""
        best = 0
        for t, held in enumerate(self.sorted):
            at = np.searchsorted(held, strings[:, t])
            for near in (np.maximum(at - 1, 0), np.minimum(at, len(held) - 1)):
                apart = int((held[near] ^ strings[:, t]).min(initial=(1 << self.bits) - 1))
                best = max(best, self.bits - apart.bit_length())
        return best


def search(items: np.ndarray, item_ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, mean: np.ndarray, k: int = K,
           depth: float = DEPTH, trees: int = TREES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, item id, distance) of the k nearest candidates of each query in one block."""
    forest = Forest(items, mean, trees)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for query, own, found in zip(queries, query_ids, forest.candidates(queries, depth * len(items), k + 1)):
        found = found[item_ids[found] != own]
        apart = np.sqrt(((items[found] - query) ** 2).sum(axis=1))
        best = np.lexsort((item_ids[found], apart))[:k]
        out.append((np.full(len(best), own), item_ids[found][best], apart[best]))
    return tuple(np.concatenate(c) for c in zip(*out))


def nearest(items: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", k: int = K,
            depth: float = DEPTH, trees: int = TREES) -> DataFrame:
    """(query_id, rank, vec_id, score): k nearest of `items` to each of those rows that `queries` selects."""
    valid = (
        items.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"), queries.alias("q"))
        .filter(F.col("id").isNotNull() & usable(F.col("v")))
    )
    rows = valid.groupBy("id").agg(F.min("v").alias("v"), F.max("q").alias("q")).withColumn("d", F.size("v"))
    rows = materialise(rows, "vectors")
    sizes = {r["d"]: (r["n"], r["m"]) for r in rows.groupBy("d").agg(F.count("*").alias("n"), F.count_if("q").alias("m")).collect()}
    axes = rows.select("d", F.posexplode("v").alias("i", "x")).groupBy("d", "i").agg(F.avg("x").alias("mean")).collect()
    means = {d: np.zeros(d) for d in sizes}
    for r in axes:
        means[r["d"]][r["i"]] = r["mean"]
    number = F.pmod(F.xxhash64("id"), F.lit(1 << 30))

    def blocks(size: int, place: int) -> Column:
        counts = [(d, max(1, math.ceil(n[place] / size))) for d, n in sizes.items()]
        return F.coalesce(*[F.when(F.col("d") == d, F.lit(c)) for d, c in counts], F.lit(1)).cast("int")

    item_blocks, query_blocks = blocks(ITEM_BLOCK, 0), blocks(QUERY_BLOCK, 1)
    item_rows = rows.select(
        "d", "id", "v", F.lit(False).alias("asks"), F.pmod(number, item_blocks).cast("int").alias("x"),
        F.explode(F.sequence(F.lit(0), query_blocks - 1)).alias("y"),
    )
    query_rows = rows.filter("q").select(
        "d", "id", "v", F.lit(True).alias("asks"), F.explode(F.sequence(F.lit(0), item_blocks - 1)).alias("x"),
        F.pmod(number, query_blocks).cast("int").alias("y"),
    )
    meetings = sum(-(-n // ITEM_BLOCK) * max(1, -(-m // QUERY_BLOCK)) for n, m in sizes.values()) or 1

    def met(table: pa.Table) -> pa.RecordBatch:
        dim = table.column("d")[0].as_py()
        asks, ids = np.asarray(table.column("asks")), np.asarray(table.column("id"))
        flat = np.asarray(table.column("v").combine_chunks().flatten()).reshape(-1, dim)
        found = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        if asks.any() and not asks.all():
            found = search(flat[~asks], ids[~asks], flat[asks], ids[asks], means[dim], k, depth, trees)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key_now = [], None
        for batch in batches:
            keys = np.column_stack([np.asarray(batch.column(c)) for c in ("d", "x", "y")])
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    if held and tuple(keys[a]) != key_now:
                        yield met(pa.Table.from_batches(held))
                        held = []
                    key_now = tuple(keys[a])
                    held.append(batch.slice(a, b - a))
        if held:
            yield met(pa.Table.from_batches(held))

    grouped = item_rows.unionByName(query_rows).repartition(meetings, "d", "x", "y").sortWithinPartitions("d", "x", "y", "asks", "id")
    found = grouped.mapInArrow(run, "query_id bigint, vec_id bigint, score double")
    ranked = top_n(found, ["query_id"], ["score", "vec_id"], k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)

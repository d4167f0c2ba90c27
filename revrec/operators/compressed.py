"""Compressed index: product-quantised residuals in cells, distance tables per query, exact re-ranking.

An item is its cell and one byte for each part of its residual, the difference to the cell's centre. A query's
table holds the inner products of its parts with all codewords, so an item's score is the centre's plus one look-up
a part. The best candidates by that score meet their vectors in parts and are ranked exactly. Codes are made for
every item; only the codewords are learned, on a sample of stated size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType

from revrec.functions.vectors import dot
from revrec.operators.ordering import sample_n, top_n
from revrec.operators.retrieval import (
    ITEM_BLOCK, ITEM_PART, QUERY_BLOCK, SCORE_DIGITS, _pair_scores, best_pairs, cells_for, dealt, fit_cells, found_pairs, matrix, named_vectors,
    nearest_cells, one_length, search_layout,
)
from revrec.sources.shared import materialise

#: Parts of a vector and codewords of a part; a code is one byte.
PARTS, WORDS = 16, 256
#: Items that codewords are learned from, and rounds of learning.
SAMPLE, ROUNDS = 20_000, 12
_CELLS = 4_000_000
#: Rows of a part of each side: many codes weigh little, and each part gives every query its best candidates.
QUERY_PART, CODES_PART = 16384, 1 << 20
#: Queries of a part when candidates are ranked exactly, and tasks a core that few queries are spread over.
RERANK_PART, _SPREAD = 32768, 4


@dataclass(frozen=True)
class CompressedIndex:
    """Centres, codebooks (part x word x numbers), codes (cell, item_id, codes) and the vectors (item_id, embedding)."""

    centres: list[list[float]]
    books: list[np.ndarray]
    codes: DataFrame
    vectors: DataFrame

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum([0] + [b.shape[1] for b in self.books])


def _nearest(points: np.ndarray, words: np.ndarray) -> np.ndarray:
    out = np.empty(len(points), np.int64)
    step = max(1, _CELLS // len(words))
    for at in range(0, len(points), step):
        part = points[at:at + step]
        out[at:at + step] = np.argmin((words**2).sum(axis=1) - 2 * part @ words.T, axis=1)
    return out


def learn_words(points: np.ndarray, words: int, rounds: int = ROUNDS, seed: int = 0) -> np.ndarray:
    """Codewords of one part: Lloyd's rounds from distinct points; empty words move to the worst-coded points."""
    draw = np.random.default_rng(seed)
    distinct = np.unique(points, axis=0)
    centres = distinct[draw.permutation(len(distinct))[:words]].copy()
    for _ in range(rounds if len(distinct) > words else 0):
        own = _nearest(points, centres)
        counts = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        filled = counts > 0
        centres[filled] = sums[filled] / counts[filled, None]
        if not filled.all():
            wrong = ((points - centres[own]) ** 2).sum(axis=1)
            centres[~filled] = points[np.argsort(-wrong, kind="stable")[:np.count_nonzero(~filled)]]
    return centres


def _cuts(length: int, parts: int) -> np.ndarray:
    return np.linspace(0, length, min(parts, length) + 1).astype(int)


def fit_books(items: DataFrame, centres: Sequence[Sequence[float]], parts: int = PARTS, words: int = WORDS,
              sample: int = SAMPLE, seed: int = 0) -> list[np.ndarray]:
    """Codebooks of residuals, from `sample` items chosen by the digest of their ids."""
    rows = nearest_cells(sample_n(items.select("item_id", "embedding"), "item_id", sample, seed), centres, 1)
    held = rows.select("cell", "embedding").toArrow()
    residuals = matrix(held["embedding"], held.num_rows) - np.asarray(centres)[held["cell"].to_numpy()]
    cuts = _cuts(len(centres[0]), parts)
    return [learn_words(residuals[:, a:b], words, seed=seed + k) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]


def encode(items: DataFrame, centres: Sequence[Sequence[float]], books: Sequence[np.ndarray]) -> DataFrame:
    """(cell, item_id, codes): one byte a part, of the nearest codeword of the residual; the first of equals."""
    table, starts = np.asarray(centres), np.cumsum([0] + [b.shape[1] for b in books])

    def run(batches):
        for batch in batches:
            vectors = matrix(pa.chunked_array([batch.column("embedding")]), batch.num_rows)
            residuals = vectors - table[batch.column("cell").to_numpy(zero_copy_only=False)]
            codes = np.empty((batch.num_rows, len(books)), np.uint8)
            for k, words in enumerate(books):
                codes[:, k] = _nearest(residuals[:, starts[k]:starts[k + 1]], words)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * len(books)
            blobs = pa.BinaryArray.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(codes)])
            yield pa.RecordBatch.from_arrays([batch.column("cell"), batch.column("item_id"), blobs], ["cell", "item_id", "codes"])

    placed = nearest_cells(items, centres, 1).select("cell", "item_id", "embedding")
    schema = StructType([placed.schema["cell"], placed.schema["item_id"], StructField("codes", BinaryType())])
    return placed.mapInArrow(run, schema)


def compress(items: DataFrame, cells: int | None = None, parts: int = PARTS, words: int = WORDS, item_id: str = "item_id",
             sample: int = SAMPLE, seed: int = 0) -> CompressedIndex:
    """Index of all items with an id and a usable vector of the length that most have."""
    vectors = materialise(one_length(named_vectors(items, item_id, "item_id")), "vectors")
    count = vectors.count()
    if not count:
        raise ValueError("no items to index")
    centres = fit_cells(vectors, min(count, cells or cells_for(count)), seed)
    return compress_at(vectors, centres, fit_books(vectors, centres, parts, words, sample, seed))


def compress_at(items: DataFrame, centres: Sequence[Sequence[float]], books: Sequence[np.ndarray], item_id: str = "item_id") -> CompressedIndex:
    """Index with given centres and codebooks (part x word x numbers)."""
    books = [np.asarray(b, np.float64) for b in books]
    if any(len(b) > 256 for b in books):
        raise ValueError("a codebook has at most 256 words")
    vectors = named_vectors(items, item_id, "item_id").filter(F.size("embedding") == len(centres[0]))
    codes = materialise(encode(vectors, centres, books), "codes")
    return CompressedIndex([list(c) for c in centres], books, codes, vectors)


def _scored(index: CompressedIndex, keep: int, query_block: int, item_block: int):
    """Best `keep` items of a part for each of its queries.

    A block of items is their cells' centres and their codewords, side by side: its inner products with the
    queries are the centres' plus the tables' entries, all parts of a vector at once.
    """
    centres, books, starts = np.asarray(index.centres), index.books, index.starts

    def score(queries: pa.Table, items: pa.Table) -> pa.Table:
        items = items.sort_by("item_id").combine_chunks()
        found = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        if queries.num_rows and items.num_rows:
            left = matrix(queries["embedding"], queries.num_rows)
            codes = np.frombuffer(b"".join(c.cast(pa.binary(len(books))).buffers()[1] for c in items["codes"].chunks), np.uint8)
            codes, cells = codes[:items.num_rows * len(books)].reshape(-1, len(books)), items["centre"].to_numpy()

            def decoded(a: int, b: int) -> np.ndarray:
                vectors = centres[cells[a:b]]
                for k, words in enumerate(books):
                    vectors[:, starts[k]:starts[k + 1]] += words[codes[a:b, k]]
                return vectors

            found = best_pairs(left, items.num_rows, decoded, keep, query_block, item_block)
        return found_pairs(queries, items, *found)

    return score


def candidates(queries: DataFrame, index: CompressedIndex, keep: int, probe: int = 8, query_id: str = "query_id",
               query_block: int = QUERY_BLOCK, item_block: int = ITEM_BLOCK) -> DataFrame:
    """(query_id, item_id, score, rank): the best `keep` items of each query by their codes, in its `probe` nearest cells."""
    named, codes = _asking(queries, index, query_id), index.codes.withColumn("centre", F.col("cell"))
    if probe < len(index.centres):
        q, i = search_layout(nearest_cells(named, index.centres, probe).drop("distance"), codes, QUERY_PART, CODES_PART)
    else:
        # Who asks all cells asks one: a query goes once to a part of all items and has one score to beat there.
        whole, tasks = F.lit(0).cast("long"), _SPREAD * queries.sparkSession.sparkContext.defaultParallelism
        q, i = search_layout(named.withColumn("cell", whole), codes.withColumn("cell", whole), QUERY_PART, CODES_PART, tasks)
    schema = StructType([q.schema["query_id"], i.schema["item_id"], StructField("score", DoubleType())])
    part = ["cell", "q_part", "i_part"]
    found = q.groupBy(*part).cogroup(i.groupBy(*part)).applyInArrow(_scored(index, keep, query_block, item_block), schema)
    return top_n(found, ["query_id"], [F.col("score").desc(), F.col("item_id").asc()], keep)


def _asking(queries: DataFrame, index: CompressedIndex, query_id: str) -> DataFrame:
    return named_vectors(queries, query_id, "query_id").filter(F.size("embedding") == len(index.centres[0]))


def _rescored(pairs: pa.Table, vectors: pa.Table) -> pa.Table:
    """Exact scores of the pairs of a part, whose queries' and items' vectors are rows of one table."""
    sides = {c: vectors.filter(pc.field(c).is_valid()) for c in ("query_id", "item_id")}
    for c, side in sides.items():
        pairs = pairs.join(pa.table({c: side[c], f"{c}_row": np.arange(side.num_rows)}), c, join_type="inner", use_threads=False)
    left, right = (matrix(side["embedding"], side.num_rows) for side in sides.values())
    scores = _pair_scores(left, right, *(pairs[f"{c}_row"].to_numpy() for c in sides)) if pairs.num_rows else np.empty(0)
    return pa.table({"query_id": pairs["query_id"], "item_id": pairs["item_id"], "score": pa.array(scores, pa.float64())})


def rescored(pairs: DataFrame, queries: DataFrame, items: DataFrame, most: int) -> DataFrame:
    """(query_id, item_id, score): exact scores of pairs, at most `most` a query, of (id, embedding) tables.

    Vectors go once to each part of the other side, so that no pair carries two of them. Where that
    would be more vectors than the pairs carry, as for few queries, they are joined row by row.
    """
    asking, offered = queries.count(), items.count()
    tasks = queries.sparkSession.sparkContext.defaultParallelism
    i_parts = max(1, -(-offered // ITEM_PART))
    q_parts = max(-(-asking // RERANK_PART), min(-(-asking // 1024), -(-tasks // i_parts)), 1)
    if asking * i_parts + offered * q_parts > 2 * most * asking:
        both = pairs.join(queries.withColumnRenamed("embedding", "_q"), "query_id").join(items, "item_id")
        return both.select("query_id", "item_id", F.round(dot(F.col("_q"), F.col("embedding")), SCORE_DIGITS).alias("score"))
    number = {"cell": F.lit(0).cast("long"), "q_parts": F.lit(q_parts).cast("long"), "i_parts": F.lit(i_parts).cast("long")}
    if queries.schema["embedding"].dataType != items.schema["embedding"].dataType:
        queries, items = (df.withColumn("embedding", F.col("embedding").cast("array<double>")) for df in (queries, items))
    sides = dealt(queries.withColumns(number), items.withColumns(number))
    part, kinds = ["q_part", "i_part"], [pairs.schema["query_id"], pairs.schema["item_id"]]
    named = [F.lit(None).cast(k.dataType).alias(k.name) for k in kinds]
    vectors = sides[0].select(*part, "query_id", named[1], "embedding").unionByName(sides[1].select(*part, named[0], "item_id", "embedding"))
    placed = pairs.select(
        *(F.pmod(F.xxhash64(c), F.lit(n).cast("long")).alias(p) for c, n, p in (("query_id", q_parts, "q_part"), ("item_id", i_parts, "i_part"))),
        "query_id", "item_id",
    )
    schema = StructType([*kinds, StructField("score", DoubleType())])
    strip = lambda pairs, vectors: _rescored(pairs.select(["query_id", "item_id"]), vectors)
    return placed.groupBy(*part).cogroup(vectors.groupBy(*part)).applyInArrow(strip, schema)


def compressed_top_k(queries: DataFrame, index: CompressedIndex, k: int = 10, probe: int = 8, rerank: int = 100, query_id: str = "query_id",
                     query_block: int = QUERY_BLOCK, item_block: int = ITEM_BLOCK) -> DataFrame:
    """(query_id, item_id, score, rank): the exact best k of the `rerank` best candidates by code."""
    most = max(k, rerank)
    chosen = candidates(queries, index, most, probe, query_id, query_block, item_block).select("query_id", "item_id")
    scored = rescored(chosen, _asking(queries, index, query_id), index.vectors, most)
    return top_n(scored, ["query_id"], [F.col("score").desc(), F.col("item_id").asc()], k)


def bytes_share(index: CompressedIndex, items: int, rerank: int, number: int = 4) -> float:
    """Bytes a query reads with all cells probed, as a share of all vectors' bytes (of `number` bytes a component)."""
    vector = number * len(index.centres[0])
    return (items * len(index.books) + min(rerank, items) * vector) / (items * vector)

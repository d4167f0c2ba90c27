"""Top-k items per query by inner product: exact, exact with pruning, or within the nearest cells.

Items are written once, in order of their ids. A task holds a bounded part of the queries, reads
the items' files a stretch at a time, multiplies blocks of the two and emits at most k rows per
query. Neither side has to fit in one task or in a broadcast, neither is copied for the parts of the
other, and pairs are never rows. A search within cells shuffles (query part, item part) pairs of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from revrec.operators.ordering import top_n
from revrec.sources.shared import materialise, opened, parts_of

# Largest blocks, and the largest that are multiplied at once.
QUERY_BLOCK = 65536
ITEM_BLOCK = 65536
_AT_ONCE = (256, 1024)
# Queries travel in parts of so many rows, and a file holds so many items. Within cells each side is sent once per part
# of the other, so large parts keep the shuffle small; two of them and a block of scores are what a task holds.
QUERY_PART, ITEM_PART = 32768, 131072
# Few queries are still spread over the available tasks, down to parts of this size.
_SMALL_PART = 1024
# Scores are compared after rounding, so that both engines and all block layouts agree on ties.
SCORE_DIGITS = 6
_CHUNK_CELLS = 4_000_000
# Centres that every task holds at most, the share of pairs above which pruning is given up, and the rows it may
# send for each one that a search of all items sends.
MAX_CELLS, MOST_OPEN, MOST_SENT = 4096, 0.5, 8
# Items that a cell's centre is learned from, where there are more than a block in all.
LEARNERS = 64


def matrix(vectors: pa.ChunkedArray, rows: int) -> np.ndarray:
    """Array column as a float64 matrix."""
    flat = pa.concat_arrays([c.flatten() for c in vectors.chunks]) if rows else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1 if rows else 0)


def best_columns(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the k largest scores of each row; ties go to the lower column.

    Cells of -inf are never chosen.
    """
    # NaN sorts last and would take places among the best.
    scores = np.where(np.isfinite(scores), scores, -np.inf)
    width = scores.shape[1]
    if k < width:
        floor = np.partition(scores, width - k, axis=1)[:, width - k, None]
        rows, cols = np.nonzero((scores >= floor) & np.isfinite(scores))
    else:
        rows, cols = np.nonzero(np.isfinite(scores))
    order = np.lexsort((cols, -scores[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows[place < k], cols[place < k]


# Share of a block's cells above which its scores are worked out whole, and pairs that are scored at a time.
_DENSE, _PAIRS = 1 / 16, 1 << 13
# Columns that are prepared at a time for all rows, and bytes of a file that are read at a time.
_COLUMNS, _BUFFER = 8192, 1 << 20
# Queries whose pairs with so many columns are made rows at a time.
_ROWS = 64
_NO_PAIRS = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))


def _merged(parts: list[tuple[np.ndarray, ...]], k: int, floor: np.ndarray) -> tuple[np.ndarray, ...]:
    """The k best (row, column, score) of each row, in order; `floor` becomes the score to beat of full rows.

    Equal scores of a row stay in the order of the parts, where columns ascend.
    """
    rows, cols, scores = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(-scores, kind="stable")
    order = order[np.argsort(rows[order].astype(np.int16), kind="stable")]
    rows, cols, scores = rows[order], cols[order], scores[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    last = place == k - 1
    floor[rows[last]] = scores[last]
    return rows[place < k], cols[place < k], scores[place < k]


def _marked(marks: np.ndarray, size: int) -> np.ndarray:
    """Places of the few True among the first `size`, eight looked at in one go; `marks` has room for whole eights."""
    whole = -(-size // 8) * 8
    marks[size:whole] = False
    eights = marks[:whole].reshape(-1, 8)
    found = np.flatnonzero(eights.view(np.uint64))
    row, col = np.nonzero(eights[found])
    return found[row] * 8 + col


def _pair_scores(left: np.ndarray, right: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    scores = np.empty(len(rows))
    for at in range(0, len(rows), _PAIRS):
        some = slice(at, at + _PAIRS)
        scores[some] = np.einsum("ij,ij->i", left[rows[some]], right[cols[some]])
    return np.round(scores, SCORE_DIGITS)


def _lengths(vectors: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        lengths = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    return np.where(lengths > 0, lengths, 1.0)


class _Best:
    """The k best columns of some rows among those seen so far, columns ascending."""

    def __init__(self, left: np.ndarray, k: int):
        self.left, self.k, self.lengths = left, k, _lengths(left)
        self.unit = (left / self.lengths[:, None]).astype(np.float32)
        self.floor = np.full(len(left), -np.inf)
        self.parts, self.waiting = [_NO_PAIRS], 0
        self.open, self.asked = [], 0

    def begin(self, at: int, right: np.ndarray, longest: float) -> None:
        """Columns from `at` on are those of `right`, whose longest is `longest`."""
        self.at, self.right, self.longest, self.low = at, right, longest, None

    def see(self, a: int, unit: np.ndarray, cells: np.ndarray, marks: np.ndarray) -> None:
        """A block of columns, from `a` in `right` on; `unit` is it over `longest` in single precision."""
        near, good = (x[: len(self.left) * len(unit)].reshape(len(self.left), -1) for x in (cells, marks))
        if self.low is None:
            # No product of two unit vectors is further than this from its value in single precision.
            slack = (self.left.shape[1] + 8) * 2.0**-23
            self.low = (self.floor / (self.lengths * self.longest) - slack).astype(np.float32)[:, None]
            self.sound = np.isfinite(self.longest) and np.isfinite(self.lengths).all()
        # A column comes after those seen, so it has to be better than a full row's last; most are not, by far.
        np.matmul(self.unit, unit.T, out=near)
        np.greater_equal(near, self.low, out=good)
        found = np.count_nonzero(good)
        if self.sound and found <= _DENSE * near.size:
            if found:
                rows, cols = np.divmod(_marked(marks, near.size), near.shape[1])
                self.open.append((rows, cols + a))
                self.asked += found
                if 2 * self.asked >= self.k * len(self.left):
                    self.settle()
        else:
            self.settle()
            exact = np.round(self.left @ self.right[a : a + len(unit)].T, SCORE_DIGITS)
            rows, cols = best_columns(exact, self.k)
            self._add(rows, cols + a, exact[rows, cols])

    def settle(self) -> None:
        """Scores the open pairs; they wait for those of other blocks, so that few are not scored by themselves."""
        if self.open:
            rows, cols = (np.concatenate(x) for x in zip(*self.open))
            self.open, self.asked = [], 0
            scores = _pair_scores(self.left, self.right, rows, cols)
            better = np.isfinite(scores) & (scores > self.floor[rows])
            self._add(rows[better], cols[better], scores[better])

    def _add(self, rows: np.ndarray, cols: np.ndarray, scores: np.ndarray) -> None:
        self.parts.append((rows, cols + self.at, scores))
        self.waiting += len(rows)
        if 2 * self.waiting >= self.k * len(self.left):
            self.found()

    def found(self) -> tuple[np.ndarray, ...]:
        self.parts, self.waiting, self.low = [_merged(self.parts, self.k, self.floor)], 0, None
        return self.parts[0]


def best_pairs(left: np.ndarray, width: int, part: Callable[[int, int], np.ndarray], k: int,
               query_block: int = QUERY_BLOCK, item_block: int = ITEM_BLOCK) -> tuple[np.ndarray, ...]:
    """(row, column, score) of the k largest rounded inner products of each row with `width` columns.

    `part(a, b)` gives columns a to b as rows of a matrix. Ties go to the lower column, scores that are
    not finite are never chosen. Products are taken in single precision first; only pairs that may be
    among the best by its error bound are scored in double precision, and those scores decide.
    """
    high, wide = min(query_block, _AT_ONCE[0]), min(item_block, _AT_ONCE[1])
    rows = [_Best(left[at : at + high], k) for at in range(0, len(left), high)]
    cells, marks = np.empty(high * wide, np.float32), np.empty(high * wide + 8, bool)
    for at in range(0, width, _COLUMNS):
        right = part(at, min(width, at + _COLUMNS))
        longest = _lengths(right).max()
        with np.errstate(over="ignore", invalid="ignore"):
            unit = (right / longest).astype(np.float32)
            for own in rows:
                own.begin(at, right, longest)
                for a in range(0, len(right), wide):
                    own.see(a, unit[a : a + wide], cells, marks)
                own.settle()
    found = [(own[0] + n * high, *own[1:]) for n, own in enumerate(x.found() for x in rows)]
    return tuple(np.concatenate(x) for x in zip(_NO_PAIRS, *found))


def found_pairs(queries: pa.Table, items: pa.Table, rows: np.ndarray, cols: np.ndarray, scores: np.ndarray) -> pa.Table:
    return pa.table({
        "query_id": queries["query_id"].take(pa.array(rows)),
        "item_id": items["item_id"].take(pa.array(cols)),
        "score": pa.array(scores, pa.float64()),
    })


def _score_blocks(k: int, query_block: int, item_block: int):
    def score(queries: pa.Table, items: pa.Table) -> pa.Table:
        items = items.sort_by("item_id")
        if queries.num_rows and items.num_rows:
            right = matrix(items["embedding"], items.num_rows)
            left = matrix(queries["embedding"], queries.num_rows)
            found = best_pairs(left, len(right), lambda a, b: right[a:b], k, query_block, item_block)
        else:
            found = _NO_PAIRS
        return found_pairs(queries, items, *found)

    return score


def dealt(queries: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides by (cell, q_part, i_part), each sent once per part of the other."""
    first = F.lit(0).cast("long")
    own = lambda df, id_col: [c for c in df.columns if c not in ("cell", "q_parts", "i_parts", id_col)]
    q = queries.select(
        "cell",
        F.pmod(F.xxhash64("query_id"), "q_parts").alias("q_part"),
        F.explode(F.sequence(first, F.col("i_parts") - 1)).alias("i_part"),
        "query_id",
        *own(queries, "query_id"),
    )
    i = items.select(
        "cell",
        F.explode(F.sequence(first, F.col("q_parts") - 1)).alias("q_part"),
        F.pmod(F.xxhash64("item_id"), "i_parts").alias("i_part"),
        "item_id",
        *own(items, "item_id"),
    )
    return q, i


def _scored_top_k(q: DataFrame, i: DataFrame, k: int, query_block: int, item_block: int) -> DataFrame:
    part = ["cell", "q_part", "i_part"]
    score = _score_blocks(k, query_block, item_block)
    found = q.groupBy(*part).cogroup(i.groupBy(*part)).applyInArrow(score, _pair_schema(q, i))
    return top_n(found, ["query_id"], [F.col("score").desc(), F.col("item_id").asc()], k)


def usable(vector: Column) -> Column:
    """Not NULL or empty, and without NULL, NaN or infinite components."""
    wrong = F.exists(vector.cast("array<double>"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~wrong, F.lit(False))


def named_vectors(df: DataFrame, id_col: str, name: str) -> DataFrame:
    # New names for both columns, so that a table can be searched against itself.
    named = df.select(F.col(id_col).alias(name), F.col("embedding").alias("embedding"))
    return named.filter(F.col(name).isNotNull() & usable(F.col("embedding")))


def by_length(df: DataFrame) -> DataFrame:
    """One row: the length that most vectors have, the longer of equally many, and their number."""
    sizes = df.groupBy(F.size("embedding").cast("long").alias("length")).agg(F.count("*").alias("rows"))
    return sizes.orderBy(F.col("rows").desc(), F.col("length").desc()).limit(1)


def one_length(df: DataFrame) -> DataFrame:
    """The vectors of the length that most of them have."""
    first = by_length(df).first()
    return _of_length(df, F.lit(first["length"] if first else 0))


def _of_length(df: DataFrame, length: Column) -> DataFrame:
    return df.filter(F.size("embedding") == length)


def _parts(rows: Column, size: int | Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(rows / size)).cast("long")


def _files(items: DataFrame, rows: int) -> list[str]:
    """Files of (item_id, embedding), written once in order of the ids, about a part in each."""
    parts = max(1, -(-rows // ITEM_PART))
    dealt_out = items.select("item_id", "embedding").repartitionByRange(parts, "item_id").sortWithinPartitions("item_id")
    return parts_of(materialise(dealt_out, "items"))


def _stretches(paths: Sequence[str], columns: Sequence[str], rows: int) -> Iterator[pa.Table]:
    """Rows of files one after the other, `rows` at a time, over the files' ends."""
    held: list[pa.RecordBatch] = []
    for path in paths:
        store, place = opened(path)
        with store.open_input_file(place) as source:
            for batch in pq.ParquetFile(source, buffer_size=_BUFFER).iter_batches(rows, columns=[*columns], use_threads=False):
                held.append(batch)
                while (waiting := sum(b.num_rows for b in held)) >= rows:
                    last = held.pop()
                    cut = last.num_rows - (waiting - rows)
                    yield pa.Table.from_batches([*held, last.slice(0, cut)])
                    held = [last.slice(cut)] if cut < last.num_rows else []
    if held:
        yield pa.Table.from_batches(held)


def _rows_of(paths: Sequence[str]) -> int:
    total = 0
    for path in paths:
        store, place = opened(path)
        with store.open_input_file(place) as source:
            total += pq.ParquetFile(source).metadata.num_rows
    return total


def _ids_at(paths: Sequence[str], places: np.ndarray) -> pa.ChunkedArray:
    """The items' ids at some places of their files."""
    wanted, back = np.unique(places, return_inverse=True)
    found, at = [], 0
    for some in _stretches(paths, ["item_id"], _COLUMNS):
        low, high = np.searchsorted(wanted, [at, at + some.num_rows])
        if low < high:
            found.append(some["item_id"].take(pa.array(wanted[low:high] - at)))
        at += some.num_rows
    return pa.chunked_array([c for f in found for c in f.chunks]).take(pa.array(back))


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Batches of one partition in tables of at least `rows`, but the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def _by_part(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[int, pa.Table]]:
    """Tables of queries with the number of the items' part that they ask."""
    for table in _gathered(batches, rows):
        parts = table["i_part"].to_numpy()
        for part in np.unique(parts):
            yield int(part), table.filter(pa.array(parts == part))


def _search_files(paths: Sequence[Sequence[str]], k: int, query_block: int, item_block: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, queries in _by_part(batches, QUERY_PART):
            left = matrix(queries["embedding"], queries.num_rows)
            read = _stretches(paths[part], ["embedding"], _COLUMNS)
            vectors = lambda a, b: matrix(next(read)["embedding"], b - a)  # noqa: E731, B023
            rows, cols, scores = best_pairs(left, _rows_of(paths[part]), vectors, k, query_block, item_block)
            if len(rows):
                yield from pa.table({
                    "query_id": queries["query_id"].take(pa.array(rows)),
                    "item_id": _ids_at(paths[part], cols),
                    "score": pa.array(scores, pa.float64()),
                }).to_batches()

    return search


def _pair_schema(queries: DataFrame, items: DataFrame) -> StructType:
    return StructType([
        StructField("query_id", queries.schema["query_id"].dataType),
        StructField("item_id", items.schema["item_id"].dataType),
        StructField("score", DoubleType()),
    ])


def _asking(queries: DataFrame, q_parts: int, i_parts: int) -> DataFrame:
    """(query_id, embedding, i_part): every query once per part of the items, a partition for each pair of parts."""
    placed = queries.select(
        "query_id", "embedding", F.pmod(F.xxhash64("query_id"), F.lit(q_parts)).alias("q_part"),
        F.explode(F.sequence(F.lit(0), F.lit(i_parts - 1))).alias("i_part"),
    )
    number = (F.col("q_part") * i_parts + F.col("i_part")).cast("int")
    return placed.repartitionById(q_parts * i_parts, number).drop("q_part")


def top_k(queries: DataFrame, items: DataFrame, k: int = 10, query_id: str = "query_id", item_id: str = "item_id",
          query_block: int = QUERY_BLOCK, item_block: int = ITEM_BLOCK) -> DataFrame:
    """Exact (query_id, item_id, score, rank) over (id, embedding) tables with unique ids.

    Rows without an id or with a NULL, empty or non-finite vector take no part, nor do vectors of
    another length than most items have.
    """
    side = lambda df, id_col, name: named_vectors(df, id_col, name).withColumn("cell", F.size("embedding").cast("long"))
    q, i = side(queries, query_id, "query_id"), side(items, item_id, "item_id")
    asked = q.groupBy("cell").agg(F.count("*").alias("_q"))
    rows = by_length(i).select(F.col("length").alias("cell"), F.col("rows").alias("_i")).join(asked, "cell")
    tasks = F.lit(queries.sparkSession.sparkContext.defaultParallelism)
    q_parts = F.greatest(_parts(F.col("_q"), QUERY_PART), F.least(_parts(F.col("_q"), _SMALL_PART), tasks))
    # Many parts fill whole waves of tasks; few queries ask parts of the items apart.
    q_parts = F.when(q_parts > tasks, _parts(q_parts, tasks) * tasks).otherwise(q_parts)
    i_parts = F.least(_parts(F.col("_i"), ITEM_PART), _parts(tasks, q_parts))
    laid = materialise(rows.select("cell", "_i", q_parts.alias("q_parts"), i_parts.alias("i_parts")), "layout").first()
    schema, order = _pair_schema(q, i), [F.col("score").desc(), F.col("item_id").asc()]
    if laid is None:
        return top_n(queries.sparkSession.createDataFrame([], schema), ["query_id"], order, k)
    files = _files(i.filter(F.col("cell") == laid["cell"]), laid["_i"])
    i_parts = min(laid["i_parts"], len(files))
    paths = [[str(p) for p in some] for some in np.array_split(files, i_parts)]
    placed = _asking(q.filter(F.col("cell") == laid["cell"]), laid["q_parts"], i_parts)
    found = placed.mapInArrow(_search_files(paths, k, query_block, item_block), schema)
    return top_n(found, ["query_id"], order, k)


def _plain_vectors(df: DataFrame, id_col: str, name: str) -> DataFrame:
    """All rows; a vector with a NULL component is NULL."""
    partly = F.exists("embedding", lambda x: x.isNull())
    return df.select(F.col(id_col).alias(name), F.when(~partly, F.col("embedding")).alias("embedding"))


def _same_length(vectors: pa.ChunkedArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Places and matrix of the vectors of each length."""
    sizes = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy()
    found = ((int(n), np.flatnonzero(sizes == n)) for n in np.unique(sizes) if n >= 0)
    return {n: (places, matrix(vectors.take(pa.array(places)), len(places))) for n, places in found}


def _score_files(paths: Sequence[Sequence[str]]):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, queries in _by_part(batches, _SMALL_PART):
            for items in _stretches(paths[part], ["item_id", "embedding"], _COLUMNS):
                right = _same_length(items["embedding"])
                for at in range(0, queries.num_rows, _ROWS):
                    asking = queries.slice(at, _ROWS)
                    scores, known = np.zeros((asking.num_rows, items.num_rows)), np.zeros((asking.num_rows, items.num_rows), bool)
                    for size, (rows, left) in _same_length(asking["embedding"]).items():
                        if size in right:
                            cols, vectors = right[size]
                            with np.errstate(over="ignore", invalid="ignore"):
                                scores[np.ix_(rows, cols)] = left @ vectors.T
                            known[np.ix_(rows, cols)] = True
                    yield from pa.table({
                        "query_id": asking["query_id"].take(pa.array(np.repeat(np.arange(asking.num_rows), items.num_rows))),
                        "item_id": items["item_id"].take(pa.array(np.tile(np.arange(items.num_rows), asking.num_rows))),
                        "score": pa.array(scores.ravel(), pa.float64(), mask=~known.ravel()),
                    }).combine_chunks().to_batches()

    return score


def all_scores(queries: DataFrame, items: DataFrame, query_id: str = "query_id", item_id: str = "item_id") -> DataFrame:
    """(query_id, item_id, score): the inner product of every query with every item of (id, embedding) tables.

    It is NULL where a vector is NULL, has a NULL component or another length than the other. As many rows
    as pairs: a task makes them a block at a time, from its queries and the items' files.
    """
    q, i = _plain_vectors(queries, query_id, "query_id"), _plain_vectors(items, item_id, "item_id")
    asking, offered = queries.count(), items.count()
    tasks = queries.sparkSession.sparkContext.defaultParallelism
    files = _files(i, offered)
    q_parts = max(1, min(-(-asking // _ROWS), -(-asking // (_SMALL_PART * tasks)) * tasks))
    i_parts = min(len(files), -(-tasks // q_parts))
    paths = [[str(p) for p in some] for some in np.array_split(files, i_parts)]
    return _asking(q, q_parts, i_parts).mapInArrow(_score_files(paths), _pair_schema(q, i))


@dataclass(frozen=True)
class CellIndex:
    """Items by their nearest centre: (cell, item_id, embedding), and the radius of every cell.

    `centres` and `radii` are as many as the cells asked for, whatever the number of items.
    """

    centres: list[list[float]]
    radii: list[float]
    items: DataFrame


def fit_cells(items: DataFrame, cells: int, seed: int = 0) -> list[list[float]]:
    """Centres of a k-means partition of the item vectors: `cells` x dimension numbers; of one, the mean."""
    if cells == 1:
        axes = items.select(F.posexplode(F.col("embedding").cast("array<double>")).alias("i", "x"))
        return [[r["x"] for r in axes.groupBy("i").agg(F.avg("x").alias("x")).orderBy("i").collect()]]
    points = items.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    model = KMeans(k=cells, seed=seed, maxIter=10).fit(points)
    return [c.tolist() for c in model.clusterCenters()]


def cells_for(items: int) -> int:
    """Cells for so many items: their root, so that centres and a cell's items stay alike; bounded.

    Items of one block are multiplied at once anyway: one cell.
    """
    return 1 if items <= ITEM_BLOCK else min(MAX_CELLS, round(items**0.5))


def _learners(items: DataFrame, count: int, cells: int) -> DataFrame:
    """Items that centres are learned from: all of up to a block, and about `LEARNERS` a cell, by their ids' digest, of more."""
    wanted = max(ITEM_BLOCK, LEARNERS * cells)
    if count <= wanted:
        return items
    return items.filter(F.pmod(F.xxhash64(F.lit("learners"), "item_id"), F.lit(1 << 30)) < int(wanted / count * (1 << 30)))


def build_index(items: DataFrame, cells: int | None = None, item_id: str = "item_id", seed: int = 0) -> CellIndex:
    """Index of all items over k-means cells, by default as many as `cells_for` the items.

    Centres are learned from a bounded share of many items; each item then goes to its nearest centre.
    """
    named = one_length(named_vectors(items, item_id, "item_id"))
    count = named.count()
    if not count:
        return CellIndex([], [], materialise(named.select(F.lit(0).cast("long").alias("cell"), "item_id", "embedding"), "cells"))
    cells = min(count, cells or cells_for(count))
    centres = fit_cells(_learners(named, count, cells), cells, seed)
    return index_at(named, centres)


def index_at(items: DataFrame, centres: list[list[float]], item_id: str = "item_id") -> CellIndex:
    """Index over cells around given centres; vectors of another length than theirs stay out."""
    named = _of_length(named_vectors(items, item_id, "item_id"), F.lit(len(centres[0])))
    placed = materialise(nearest_cells(named, centres, 1).select("cell", "item_id", "embedding", "distance"), "cells")
    farthest = dict(placed.groupBy("cell").agg(F.max("distance")).collect())
    return CellIndex(centres, [farthest.get(c, -np.inf) for c in range(len(centres))], placed.drop("distance"))


def _distances(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squares = (vectors**2).sum(axis=1)[:, None] - 2 * vectors @ centres.T + (centres**2).sum(axis=1)
    return np.sqrt(np.maximum(squares, 0))


def _map_cells(df: DataFrame, centres: Sequence[Sequence[float]], choose) -> DataFrame:
    """Adds (cell, distance) rows: `choose(vectors, distance, batch, rows)` marks the wanted cells.

    `distance` is that of each vector to each centre, `rows` is the slice of the batch at hand.
    """
    table = np.asarray(centres)
    kind = ArrayType(StructType([StructField("cell", LongType()), StructField("distance", DoubleType())]))
    schema = StructType([*df.schema.fields, StructField("_cells", kind)])

    def assign(batches):
        for batch in batches:
            vectors = matrix(pa.chunked_array([batch.column("embedding")]), batch.num_rows)
            counts, cells, distances = [], [], []
            step = max(1, _CHUNK_CELLS // len(table))
            for at in range(0, batch.num_rows, step):
                part = vectors[at : at + step]
                distance = _distances(part, table)
                wanted = choose(part, distance, batch, slice(at, at + len(part)))
                row, cell = np.nonzero(wanted)
                counts.append(wanted.sum(axis=1))
                cells.append(cell)
                distances.append(distance[row, cell])
            ends = np.concatenate([[0], *[c for c in counts]]).cumsum()
            values = pa.StructArray.from_arrays(
                [pa.array(np.concatenate(cells)) if cells else pa.array([], pa.int64()),
                 pa.array(np.concatenate(distances)) if distances else pa.array([], pa.float64())],
                names=["cell", "distance"],
            )
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "_cells"])

    return df.mapInArrow(assign, schema).select(*df.columns, F.inline("_cells"))


def _among_nearest(distance: np.ndarray, probe: int) -> np.ndarray:
    near = np.ones(distance.shape, dtype=bool)
    if probe < distance.shape[1]:
        np.put_along_axis(near, np.argpartition(distance, probe, axis=1)[:, probe:], False, axis=1)
    return near


def nearest_cells(df: DataFrame, centres: Sequence[Sequence[float]], probe: int) -> DataFrame:
    """One row per vector and each of its `probe` nearest centres, with columns cell and distance."""
    return _map_cells(df, centres, lambda vectors, distance, batch, rows: _among_nearest(distance, probe))


def _reaching(index: CellIndex, probe: int) -> Callable[..., np.ndarray]:
    """Marks the cells beyond the `probe` nearest that may hold a score of at least `threshold`.

    No item of a cell scores more than q.c + |q| r for its centre c and radius r.
    """
    table, radii = np.asarray(index.centres), np.asarray(index.radii)

    def choose(vectors, distance, batch, rows):
        thresholds = batch.column("threshold").to_numpy(zero_copy_only=False)[rows]
        lengths = np.linalg.norm(vectors, axis=1)[:, None]
        best = vectors @ table.T + lengths * radii
        # Scores are rounded and radii computed, so one unit of the last digit is allowed for each.
        reach = best >= thresholds[:, None] - 10.0**-SCORE_DIGITS * (1 + lengths)
        return reach & ~_among_nearest(distance, probe)

    return choose


def _promising_cells(df: DataFrame, index: CellIndex, probe: int) -> DataFrame:
    """(..., cell, distance) rows of the cells beyond the `probe` nearest that may hold a score of at least `threshold`."""
    return _map_cells(df, index.centres, _reaching(index, probe))


def open_cells(df: DataFrame, index: CellIndex, probe: int) -> DataFrame:
    """One row: the (query, cell) and the (query, item) pairs of `_promising_cells`, counted without making its rows."""
    table, choose = np.asarray(index.centres), _reaching(index, probe)
    filled = dict(index.items.groupBy("cell").agg(F.count("*")).collect())
    sizes = np.array([filled.get(c, 0) for c in range(len(table))], dtype=np.float64)

    def count(batches):
        for batch in batches:
            vectors = matrix(pa.chunked_array([batch.column("embedding")]), batch.num_rows)
            cells, pairs, step = 0, 0.0, max(1, _CHUNK_CELLS // len(table))
            for at in range(0, batch.num_rows, step):
                part = vectors[at : at + step]
                asked = choose(part, _distances(part, table), batch, slice(at, at + len(part))).sum(axis=0)
                cells, pairs = cells + int(asked.sum()), pairs + float(asked @ sizes)
            yield pa.RecordBatch.from_pydict({"cells": pa.array([cells], pa.int64()), "pairs": pa.array([pairs], pa.float64())})

    counted = df.select("embedding", "threshold").mapInArrow(count, "cells bigint, pairs double")
    return counted.agg(F.coalesce(F.sum("cells"), F.lit(0)).alias("cells"), F.coalesce(F.sum("pairs"), F.lit(0.0)).alias("pairs"))


def search_layout(probes: DataFrame, items: DataFrame, query_part: int = QUERY_PART,
                  item_part: int = ITEM_PART, tasks: int = 1) -> tuple[DataFrame, DataFrame]:
    """(query_id, ..., cell) and (item_id, ..., cell) rows dealt to parts of the cells that both have.

    A cell's queries are spread over `tasks` parts, unless these would be small.
    """
    # A popular cell is cut into more parts. One row per cell, and the number of cells is given by
    # the index, whose centres every task holds anyway: small at any data size.
    spread = F.greatest(_parts(F.count("*"), query_part), F.least(_parts(F.count("*"), _SMALL_PART), F.lit(tasks).cast("long")))
    q_sizes = probes.groupBy("cell").agg(spread.alias("q_parts"))
    i_sizes = items.groupBy("cell").agg(_parts(F.count("*"), item_part).alias("i_parts"))
    layout = F.broadcast(q_sizes.join(i_sizes, "cell"))
    return dealt(probes.join(layout, "cell"), items.join(layout, "cell"))


def _search(probes: DataFrame, index: CellIndex, k: int, query_block: int, item_block: int) -> DataFrame:
    """Top k over (query_id, embedding, cell) rows within their cells."""
    return _scored_top_k(*search_layout(probes, index.items), k, query_block, item_block)


def approx_top_k(queries: DataFrame, index: CellIndex, k: int = 10, probe: int = 8, query_id: str = "query_id",
                 query_block: int = QUERY_BLOCK, item_block: int = ITEM_BLOCK) -> DataFrame:
    """Top k among the items of the `probe` cells nearest to each query."""
    if not index.centres:
        return top_k(queries, index.items, k, query_id)
    named = _of_length(named_vectors(queries, query_id, "query_id"), F.lit(len(index.centres[0])))
    probes = nearest_cells(named, index.centres, probe).drop("distance")
    return _search(probes, index, k, query_block, item_block)


def pruned_top_k(queries: DataFrame, index: CellIndex, k: int = 10, probe: int = 8, query_id: str = "query_id",
                 query_block: int = QUERY_BLOCK, item_block: int = ITEM_BLOCK, most_open: float = MOST_OPEN) -> DataFrame:
    """The exact top k, scoring only the cells that can matter.

    The nearest cells give each query k scores to beat; of the other cells only those whose bound
    reaches the k-th score are searched. Where more than `most_open` of all pairs stay open, or
    more rows would be sent than for a search of all items, the bound does not pay, and the items
    are searched whole; the result is the same.
    """
    if len(index.centres) < 2:
        return top_k(queries, index.items, k, query_id)
    first = materialise(approx_top_k(queries, index, k, probe, query_id, query_block, item_block), "first")
    beat = materialise(
        first.groupBy("query_id").agg(F.count("*").alias("_n"), F.min("score").alias("_least")), "beat"
    )
    named = _of_length(named_vectors(queries, query_id, "query_id"), F.lit(len(index.centres[0])))
    open_queries = named.join(beat, "query_id", "left").withColumn(
        "threshold", F.when(F.col("_n") == k, F.col("_least")).otherwise(F.lit(float("-inf")))
    ).drop("_n", "_least")
    # Open cells are counted first: where the bound does not pay, their rows are nearly all pairs with a cell.
    found, asking, offered = open_cells(open_queries, index, probe).first(), named.count(), index.items.count()
    # A search of all items sends every query and writes every item once, however many parts they have.
    sent = asking + offered
    if found["pairs"] > most_open * max(1.0, float(asking) * offered) or found["cells"] > MOST_SENT * max(1, sent):
        return top_k(queries, index.items, k, query_id)
    # Only ids are written; a query's vector joins its cells when they are searched.
    probes = materialise(_promising_cells(open_queries, index, probe).select("query_id", "cell"), "probes")
    second = _search(probes.join(named, "query_id"), index, k, query_block, item_block)
    both = first.drop("rank").unionByName(second.drop("rank"))
    return top_n(both, ["query_id"], [F.col("score").desc(), F.col("item_id").asc()], k)


def recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: the share of the exact (query_id, item_id) pairs that were found."""
    pair = ["query_id", "item_id"]
    found = exact.select(*pair).join(approximate.select(*pair, F.lit(1).alias("_hit")), pair, "left")
    return found.agg(F.avg(F.coalesce("_hit", F.lit(0))).alias("recall"))


def pair_share(queries: DataFrame, index: CellIndex, probe: int, query_id: str = "query_id") -> DataFrame:
    """One row: the share of all (query, item) pairs that a search of `probe` cells scores."""
    named = named_vectors(queries, query_id, "query_id")
    probed = nearest_cells(named, index.centres, probe).groupBy("cell").agg(F.count("*").alias("_q"))
    filled = index.items.groupBy("cell").agg(F.count("*").alias("_i"))
    everything = named.agg(F.count("*")).scalar().cast("double") * index.items.agg(F.count("*")).scalar()
    return probed.join(filled, "cell").agg((F.sum(F.col("_q") * F.col("_i")) / everything).alias("pair_share"))


def recommendation_lists(ranked: DataFrame, query_id: str = "query_id", item_id: str = "item_id",
                         out: str = "product_ids") -> DataFrame:
    """One row per query with its items in rank order; the lists are no longer than k."""
    pairs = F.array_sort(F.collect_list(F.struct("rank", item_id)))
    return ranked.groupBy(query_id).agg(F.transform(pairs, lambda p: p[item_id]).alias(out))

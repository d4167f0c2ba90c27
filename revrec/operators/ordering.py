"""Ranks, positions, top-n and shuffles that hold when one key owns a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revrec.functions.columns import stable_hash
from revrec.sources.shared import materialise

# monotonically_increasing_id() is (partition << 33) + row number within the partition.
_ROW_BITS = 33
# Above this n Spark plans no group limit before the exchange (its own default).
_GROUP_LIMIT = 1000
_SALTS = 256

Order = Sequence[str | Column]


def _columns(order: Order) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def top_n(df: DataFrame, by: Sequence[str], order: Order, n: int, rank: str = "rank") -> DataFrame:
    """First n rows per group with their 1-based rank.

    Spark cuts each group to n rows before the exchange, so a hot group sends n rows per task. For
    an n too large for that rule the groups are first cut within salted parts.
    """
    order = _columns(order)
    if n > _GROUP_LIMIT:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(_SALTS))
        part = W.partitionBy(*by, "_salt").orderBy(*order)
        df = (
            df.withColumn("_salt", salt)
            .withColumn("_part", F.row_number().over(part))
            .filter(F.col("_part") <= n)
            .drop("_salt", "_part")
        )
    group = W.partitionBy(*by).orderBy(*order)
    ranked = df.withColumn(rank, F.row_number().over(group)).filter(F.col(rank) <= n)
    return ranked.withColumn(rank, F.col(rank).cast("long"))


def _placed(df: DataFrame, order: Order, partitions: int | None) -> DataFrame:
    """Rows with their 0-based position `_index` in a total order and their ordered chunk `_chunk`.

    Range-partitioned and sorted once, then written with the place in the partition; only one row
    count per partition reaches the driver. `order` must end in a unique column.
    """
    order = _columns(order)
    # Without a number adaptive execution may merge neighbouring small ranges, which keeps the order.
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    stored = materialise(
        ranged.sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()), "ordered"
    ).withColumn("_chunk", F.shiftright("_place", _ROW_BITS).cast("int"))
    sizes = dict(stored.groupBy("_chunk").agg(F.count("*")).collect())
    starts = list(accumulate((sizes.get(i, 0) for i in range(max(sizes, default=0))), initial=0))
    start = F.get(F.lit(starts).cast("array<bigint>"), F.col("_chunk"))
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return stored.withColumn("_index", start + row).drop("_place")


def ordered_index(df: DataFrame, order: Order, out: str = "index", partitions: int | None = None) -> DataFrame:
    """0-based position of every row in a total order, without ever sorting in one task."""
    return _placed(df, order, partitions).drop("_chunk").withColumnRenamed("_index", out)


def rank_within(df: DataFrame, by: Sequence[str], order: Order, out: str = "rank",
                partitions: int | None = None) -> DataFrame:
    """1-based rank of every row in its group, with large groups spread over many tasks.

    A group is ranked within its ordered chunks; groups that span chunks are fewer than the
    chunks, so their starting positions are few enough to broadcast whatever the data size.
    """
    placed = _placed(df, [*by, *order], partitions)
    spans = (
        placed.groupBy(*by)
        .agg(F.min("_index").alias("_start"), F.min("_chunk").alias("_first"), F.max("_chunk").alias("_last"))
        .filter("_first < _last")
        .select(*[F.col(c).alias(f"_span_{c}") for c in by], "_start")
    )
    local = F.min("_index").over(W.partitionBy("_chunk", *by))
    same = [F.col(c).eqNullSafe(F.col(f"_span_{c}")) for c in by]
    return (
        placed.withColumn("_local", local)
        .join(F.broadcast(spans), same, "left")
        .withColumn(out, F.col("_index") - F.coalesce("_start", "_local") + 1)
        .select(*df.columns, out)
    )


def assign_batches(df: DataFrame, order: Order, size: int = 1024, out: str = "batch_id") -> DataFrame:
    """Consecutive batches of exactly `size` rows (the last may be shorter) along a total order."""
    return ordered_index(df, order, "_at").withColumn(out, F.floor(F.col("_at") / size)).drop("_at")


def shuffle_order(key: str, seed: int = 0) -> list[Column]:
    """Repeatable random order of a unique key."""
    return [stable_hash(F.col(key), seed=seed), F.col(key)]


def shuffle_rows(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    return df.orderBy(*shuffle_order(key, seed))


def sample_n(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n random rows, the same ones on every run."""
    return df.orderBy(*shuffle_order(key, seed)).limit(n)


def head(df: DataFrame, order: Order, n: int = 10) -> DataFrame:
    return df.orderBy(*_columns(order)).limit(n)

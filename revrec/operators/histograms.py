"""Equal-width histograms; empty bins are reported with 0."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revrec.functions.columns import nan_to_null


def bin_number(value: Column, low: Column, high: Column, bins: int) -> Column:
    """1-based bin; bins are [a, b), the last one closed; outside values give NULL."""
    scaled = F.floor(F.try_divide(F.lit(bins) * (value - low), high - low)) + 1
    # A constant column has no width: everything is in the first bin.
    inside = F.least(F.coalesce(scaled, F.lit(1)), F.lit(bins))
    return F.when((value >= low) & (value <= high), inside)


def _with_edges(counts: DataFrame, all_bins: DataFrame, low: Column, high: Column, bins: int) -> DataFrame:
    width = (high - low) / bins
    return all_bins.join(counts, "bin", "left").select(
        "bin",
        (low + width * (F.col("bin") - 1)).alias("low"),
        (low + width * F.col("bin")).alias("high"),
        F.coalesce("count", F.lit(0)).cast("long").alias("count"),
    )


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """(bin, low, high, count) over fixed edges; values outside the edges are dropped."""
    low, high = F.lit(float(low)), F.lit(float(high))
    value = nan_to_null(F.col(column).cast("double"))
    counts = (
        df.select(bin_number(value, low, high, bins).cast("long").alias("bin"))
        .filter("bin is not null")
        .groupBy("bin")
        .agg(F.count("*").alias("count"))
    )
    all_bins = df.sparkSession.range(1, bins + 1, 1, 1).withColumnRenamed("id", "bin")
    return _with_edges(counts, all_bins, low, high, bins)


def histogram_auto(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Edges from the data's own range, with log10 of the counts; a constant column has one bin."""
    values = df.select(nan_to_null(F.col(column).cast("double")).alias("value")).filter("value is not null")
    low, high = values.agg(F.min("value")).scalar(), values.agg(F.max("value")).scalar()
    counts = (
        values.select(bin_number(F.col("value"), low, high, bins).cast("long").alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("count"))
    )
    all_bins = df.sparkSession.range(1, bins + 1, 1, 1).withColumnRenamed("id", "bin")
    return (
        _with_edges(counts, all_bins, low, high, bins)
        .filter("low is not null and (high > low or bin = 1)")
        .withColumn("log10_count", F.when(F.col("count") > 0, F.log10("count")))
    )


def bin_counts(df: DataFrame, columns: Sequence[str], low: float, high: float, bins: int) -> DataFrame:
    """The same fixed bins for several columns side by side, from one pass over the table."""
    named = F.explode(
        F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    )
    number = bin_number(nan_to_null(F.col("value")), F.lit(float(low)), F.lit(float(high)), bins)
    counts = (
        df.select(named.alias("_f")).select("_f.*")
        .select("feature", number.cast("long").alias("bin"))
        .filter("bin is not null")
        .groupBy("feature", "bin")
        .agg(F.count("*").alias("count"))
    )
    features = F.explode(F.array(*[F.lit(c) for c in columns])).alias("feature")
    grid = df.sparkSession.range(1, bins + 1, 1, 1).select(features, F.col("id").alias("bin"))
    return grid.join(counts, ["feature", "bin"], "left").withColumn("count", F.coalesce("count", F.lit(0)).cast("long"))

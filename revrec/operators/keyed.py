"""One row per key: latest, distinct, dimensions, group sizes.

A key with very many rows is reduced on the map side first: by partial sums, or cut to its newest row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revrec.operators.ordering import top_n


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The whole row with the greatest (order, tiebreak) of every key.

    Ranked on plain columns: columns that nobody reads never reach the exchange, and a key with very
    many rows is cut to one before it.
    """
    newest = [F.col(c).desc() for c in (order, *tiebreak)]
    return top_n(df, keys, newest, 1, "_newest").drop("_newest").select(*keys, *[c for c in df.columns if c not in keys])


def distinct_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def extract_dimension(df: DataFrame, key: str, columns: Sequence[str], order: str,
                      tiebreak: Sequence[str] = ()) -> DataFrame:
    """Latest non-null value of each column per key; rows without a key are dropped."""
    position = F.struct(order, *tiebreak)
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), position)).alias(c) for c in columns])
    )


def group_sizes(df: DataFrame, column: str, out: str = "size") -> DataFrame:
    """Rows per value, the NULL group included, largest first."""
    return (
        df.groupBy(column)
        .agg(F.count("*").alias(out))
        .orderBy(F.col(out).desc(), F.col(column).asc_nulls_last())
    )


def row_counts(df: DataFrame, by: Sequence[str] = (), out: str = "row_count") -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias(out))


def explode_variants(docs: DataFrame, array: str, item: str) -> DataFrame:
    """One row per array element; rows with an empty or NULL array disappear."""
    return docs.withColumn(item, F.explode(array))


def having_isin(aggregated: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Filter on a value that exists only after aggregation."""
    return aggregated.filter(F.col(column).isin(list(values)))

"""Reading and writing tables, splits and releases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from revrec.functions.columns import stable_hash
from revrec.schemas import SPLIT, TEST

# Free text holds quotes, commas, newlines and outer blanks; these options keep all of them.
_CSV_READ = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}
_CSV_WRITE = {
    "header": True,
    # Files with line breaks in fields cannot be split on reading, so no file may grow large.
    "maxRecordsPerFile": 1_000_000,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | None = None) -> DataFrame:
    """Without a schema the types are inferred, at the price of one more pass over the files."""
    reader = spark.read.options(**_CSV_READ)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.options(**_CSV_WRITE).csv(path)


def write_splits(df: DataFrame, base: str) -> None:
    """One folder per split in a single pass; the split lives in the folder name only."""
    df.write.options(**_CSV_WRITE).partitionBy(SPLIT).csv(base)


def read_splits(spark: SparkSession, base: str, splits: Sequence[str], schema: StructType,
                pattern: str = SPLIT + "={split}") -> DataFrame:
    """Named splits by path pattern, e.g. `{split}.csv`, as one table with a split column."""
    parts = [
        read_csv(spark, f"{base}/{pattern.format(split=name)}", schema).withColumn(SPLIT, F.lit(name))
        for name in splits
    ]
    return union_splits(*parts)


def union_splits(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def select_splits(df: DataFrame, splits: Sequence[str]) -> DataFrame:
    return df.filter(F.col(SPLIT).isin(list(splits)))


def hash_split(df: DataFrame, buckets: Mapping[str, int], keys: Sequence[str]) -> DataFrame:
    """Assign rows to named splits in proportion to their bucket counts, by a hash of the keys."""
    total = sum(buckets.values())
    if total < 1 or min(buckets.values()) < 1:
        raise ValueError("every split needs at least one bucket")
    bucket = stable_hash(*[F.col(k) for k in keys]) % total if total > 1 else F.lit(0)
    label: Column | None = None
    upper = 0
    for name, size in buckets.items():
        upper += size
        inside = bucket < upper
        label = F.when(inside, name) if label is None else label.when(inside, name)
    return df.withColumn(SPLIT, label)


def release(df: DataFrame, withhold: Sequence[str] = (TEST,)) -> DataFrame:
    """Everything but the withheld splits."""
    return df.filter(~F.col(SPLIT).isin(list(withhold)))


def write_examples(df: DataFrame, path: str, splits: Sequence[str]) -> None:
    """Materialise the chosen splits, one folder each."""
    select_splits(df, splits).write.partitionBy(SPLIT).parquet(path)

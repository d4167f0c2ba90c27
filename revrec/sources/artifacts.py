"""Versioned results: list them, pick the newest, publish behind a gate."""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Sequence
from fnmatch import translate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def artifact_manifest(spark: SparkSession, base: str, name_glob: str = "*") -> DataFrame:
    """Files below `base` as (path, generation); contents are never read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", name_glob)
        .load(base)
        .select("path", F.unix_micros("modificationTime").alias("generation"))
    )


def latest_artifact(manifest: DataFrame, prefix: str = "", glob: str = "*", by: Sequence[str] = ()) -> DataFrame:
    """Newest matching path, overall or per group; a missing match shows as no row."""
    regex = "^" + translate(glob)
    newest = F.struct("generation", "path")
    return (
        manifest.filter(F.col("path").startswith(prefix) & F.col("path").rlike(regex))
        .groupBy(*by)
        .agg(F.max(newest).alias("_newest"))
        .filter(F.col("_newest").isNotNull())
        .select(*by, "_newest.path", "_newest.generation")
    )


def require_artifact(latest: DataFrame) -> str:
    """Path of the newest artifact of one prefix; an error when there is none."""
    row = latest.first()
    if row is None:
        raise ValueError("no artifact matches")
    return row["path"]


def latest_approved(manifest: DataFrame, verdicts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Newest artifact among those whose verdict (path, ok) is positive."""
    approved = verdicts.filter("ok").select("path").distinct()
    return latest_artifact(manifest.join(approved, "path", "left_semi"), by=by)


def publish(df: DataFrame, base: str, verdict: DataFrame, version: int | None = None) -> str | None:
    """Write a new version folder if every verdict row is ok; an existing or claimed version is an error.

    The rows go to a hidden folder first. Then the version is claimed by creating its commit record, which only
    one publisher can, the folder gets its name by one rename, and the record is filled. A write that stops on
    the way leaves nothing that `artifact_manifest`, `latest_artifact` or `committed_versions` shows.
    """
    passed = verdict.agg(F.coalesce(F.bool_and("ok"), F.lit(False)).alias("ok")).first()["ok"]
    if not passed:
        return None
    spark, version = df.sparkSession, int(time.time()) if version is None else version
    name, path = f"version={version}", f"{base}/version={version}"
    store = _Store(spark, base)
    staged = f"{base}/_staging-{uuid.uuid4().hex}"
    if store.exists(path) or store.exists(f"{base}/{_COMMITS}/{name}.json"):
        raise FileExistsError(f"{path} already exists")
    try:
        df.write.parquet(staged)
        rows, digest = _digest(spark.read.schema(df.schema).parquet(staged))
        store.claim(f"{base}/{_COMMITS}/{name}.json")
        if store.exists(path) or not store.rename(staged, path):
            raise FileExistsError(f"{path} already exists")
        store.fill(f"{base}/{_COMMITS}/{name}.json", json.dumps({"version": version, "path": path, "rows": rows, "digest": digest}))
    finally:
        store.delete(staged)
    return path


def committed_versions(spark: SparkSession, base: str) -> DataFrame:
    """(version, path, rows, digest) of the versions whose publishing ended, from their records."""
    if not _Store(spark, base).exists(f"{base}/{_COMMITS}"):
        return spark.createDataFrame([], _RECORD)
    # Text of a folder whose name is hidden to readers of `base`; a claim that was never filled is no record.
    lines = spark.read.text(f"{base}/{_COMMITS}")
    return lines.select(F.from_json("value", _RECORD).alias("r")).select("r.*").filter("path is not null")


def read_version(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """The rows of a committed version, the newest without a number; an error if there is none."""
    known = committed_versions(spark, base)
    chosen = known.filter(F.col("version") == version) if version is not None else known.orderBy(F.col("version").desc()).limit(1)
    return spark.read.parquet(require_artifact(chosen))


def verify_version(spark: SparkSession, base: str, version: int) -> bool:
    """Whether a version's rows are still those of its record."""
    record = committed_versions(spark, base).filter(F.col("version") == version).first()
    return record is not None and _digest(spark.read.parquet(record["path"])) == (record["rows"], record["digest"])


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that no version names."""
    _Store(spark, path).delete(path)


_COMMITS = "_commits"
_RECORD = "version bigint, path string, rows bigint, digest string"


def _digest(df: DataFrame) -> tuple[int, str]:
    """Number of rows and the sum of their digests, the same in any order."""
    whole = F.xxhash64(F.to_json(F.struct(*df.columns))) if df.columns else F.lit(0)
    row = df.agg(F.count("*"), F.sum(whole.cast("decimal(38,0)"))).first()
    return row[0], str(row[1] or 0)


class _Store:
    """The few steps on folders that publishing needs, on whatever file system `base` lies."""

    def __init__(self, spark: SparkSession, base: str):
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(base).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.path(path))

    def rename(self, path: str, to: str) -> bool:
        return self.fs.rename(self.path(path), self.path(to))

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)

    def claim(self, path: str) -> None:
        """Creates an empty file; an error if it is there, whoever made it."""
        place = self.path(path)
        self.fs.mkdirs(place.getParent())
        if self.fs.getUri().getScheme() == "file":
            # The local file system has no exclusive create of its own behind Hadoop's interface.
            os.close(os.open(place.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY))
        else:
            try:
                self.fs.create(place, False).close()
            except Exception as e:
                if self.exists(path):
                    raise FileExistsError(f"{path} already exists") from e
                raise

    def fill(self, path: str, text: str) -> None:
        """Only the one who claimed the file comes here; readers skip it until its one line is whole."""
        out = self.fs.create(self.path(path), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

"""The newest row of every key, kept in a bucketed table that batches of rows are merged into.

A batch is cut to its newest row per key first. Only the buckets that its keys fall into are read, and
written anew; earlier batches are not read again. Which folder holds a bucket stands in a small table
(one row per bucket) that is published as a version, so that readers see a whole state or the one before.
Of two writers that start from the same version one publishes; the other merges into what the first left.

The newest row is the greatest by (order, tiebreak, all other columns): the state is the same for any order
of the batches, for late rows and for batches that come twice. All columns must be orderable. A NULL key is
a key; a NULL order is older than all others.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revrec.operators.keyed import latest_per_key
from revrec.sources import artifacts
from revrec.sources.shared import drop, materialise

_BUCKET = "state_bucket"


@dataclass(frozen=True)
class LatestState:
    """A state under the folder `base`; all its writers must use the same keys, order and buckets."""

    base: str
    keys: tuple[str, ...]
    order: str
    tiebreak: tuple[str, ...] = ()
    buckets: int = 64

    def merge(self, batch: DataFrame, attempts: int = 10) -> int:
        """Takes a batch in and returns the version that holds it; an empty batch leaves the last one (0: none)."""
        spark = batch.sparkSession
        newest = materialise(self._newest(batch, list(self.keys)).withColumn(_BUCKET, self._bucket()), "batch")
        touched = sorted(r[0] for r in newest.select(_BUCKET).distinct().collect())
        for _ in range(attempts):
            version, held = self._held(spark)
            if not touched:
                break
            try:
                version = self._publish(newest, touched, version, held)
                break
            except FileExistsError:
                continue  # another writer published this version: merge into its state
        else:
            raise RuntimeError(f"{self.base}: other writers came first {attempts} times")
        drop(newest)
        return version

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest without a number; an error if there is none."""
        known, held = self._held(spark, version)
        if not held:
            raise ValueError(f"{self.base} holds no state")
        return spark.read.parquet(*held.values())

    def _publish(self, newest: DataFrame, touched: list[int], version: int, held: dict[int, str]) -> int:
        spark, folder = newest.sparkSession, f"{self.base}/rows/{uuid.uuid4().hex}"
        rows, old = newest, [held[b] for b in touched if b in held]
        if old:
            before = spark.read.schema(newest.drop(_BUCKET).schema).parquet(*old)
            rows = rows.unionByName(before.withColumn(_BUCKET, self._bucket()))
        # One exchange for the choice and the files: rows of a key share a bucket, a bucket is one file.
        dealt = self._newest(rows.repartition(len(touched), _BUCKET), [_BUCKET, *self.keys])
        dealt.write.partitionBy(_BUCKET).parquet(folder)
        now = held | {b: f"{folder}/{_BUCKET}={b}" for b in touched}
        listed = spark.createDataFrame(sorted(now.items()), "bucket bigint, path string")
        try:
            artifacts.publish(listed, self._versions, spark.sql("SELECT true AS ok"), version + 1)
        except FileExistsError:
            artifacts.remove(spark, folder)
            raise
        return version + 1

    @property
    def _versions(self) -> str:
        return f"{self.base}/versions"

    def _held(self, spark: SparkSession, version: int | None = None) -> tuple[int, dict[int, str]]:
        """A version's number and folder by bucket; 0 and none before the first."""
        known = artifacts.committed_versions(spark, self._versions)
        if version is None:
            version = known.agg(F.max("version")).first()[0] or 0
        if not version:
            return 0, {}
        return version, {r["bucket"]: r["path"] for r in artifacts.read_version(spark, self._versions, version).collect()}

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _newest(self, rows: DataFrame, keys: list[str]) -> DataFrame:
        first = [*self.keys, self.order, *self.tiebreak, _BUCKET]
        others = [c for c in sorted(rows.columns) if c not in first]
        return latest_per_key(rows, keys, self.order, [*self.tiebreak, *others]).select(*rows.columns)

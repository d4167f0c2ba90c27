"""Versions appear whole or not at all, and one publisher wins."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from revrec.sources import artifacts


@pytest.fixture
def ok(spark):
    return spark.createDataFrame([("a", True)], "metric string, ok boolean")


def test_versions_have_records(spark, folder, ok):
    df = spark.range(100).withColumn("t", F.concat(F.lit("x"), F.col("id")))
    assert artifacts.committed_versions(spark, folder).collect() == []
    for v in (3, 10, 7):
        assert artifacts.publish(df.filter(F.col("id") < v), folder, ok, v) == f"{folder}/version={v}"
    rows = {r["version"]: r["rows"] for r in artifacts.committed_versions(spark, folder).collect()}
    assert rows == {3: 3, 10: 10, 7: 7}
    assert artifacts.read_version(spark, folder).count() == 10 and artifacts.read_version(spark, folder, 3).count() == 3
    assert all(artifacts.verify_version(spark, folder, v) for v in rows) and not artifacts.verify_version(spark, folder, 4)
    with pytest.raises(ValueError):
        artifacts.read_version(spark, folder, 4)
    df.filter("id < 2").write.mode("overwrite").parquet(f"{folder}/version=7")
    assert not artifacts.verify_version(spark, folder, 7)
    with pytest.raises(FileExistsError):
        artifacts.publish(df, folder, ok, 10)
    assert artifacts.publish(df, folder, ok.withColumn("ok", F.lit(False)), 11) is None


def test_a_write_that_stops_midway_is_invisible(spark, folder, ok, monkeypatch):
    df = spark.range(50)
    artifacts.publish(df, folder, ok, 1)
    before = {r["path"] for r in artifacts.artifact_manifest(spark, folder, "*.parquet").collect()}

    fail = F.udf(lambda i: 1 // (i - 49), "long")
    with pytest.raises(Exception):
        artifacts.publish(df.repartition(8).withColumn("x", fail("id")), folder, ok, 2)

    # The process dies after rows were staged, and after the version was claimed.
    for step in ("claim", "rename"):
        with monkeypatch.context() as patch:
            patch.setattr(artifacts._Store, step, lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
            patch.setattr(artifacts._Store, "delete", lambda *a: None)
            with pytest.raises(KeyboardInterrupt):
                artifacts.publish(df, folder, ok, 3)
    manifest = artifacts.artifact_manifest(spark, folder, "*.parquet")
    assert {r["path"] for r in manifest.collect()} == before
    assert "version=1/" in artifacts.latest_artifact(manifest).first()["path"]
    assert [r["version"] for r in artifacts.committed_versions(spark, folder).collect()] == [1]
    assert artifacts.read_version(spark, folder).count() == 50


def test_of_two_publishers_one_wins(spark, folder, ok):
    def go(n):
        try:
            return artifacts.publish(spark.range(n), folder, ok, 5) and n
        except FileExistsError:
            return None

    with ThreadPoolExecutor(4) as pool:
        won = [n for n in pool.map(go, [10, 20, 30, 40]) if n]
    assert len(won) == 1 and artifacts.read_version(spark, folder).count() == won[0]
    assert artifacts.verify_version(spark, folder, 5)
    assert not [x for x in os.listdir(folder) if x.startswith("_staging")]

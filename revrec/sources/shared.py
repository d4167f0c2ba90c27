"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

#: Called with the name and the input of every table before it is written; tests read plans here.
observers: list[Callable[[str, DataFrame], None]] = []
_scopes: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder named by `spark.checkpoint.dir`; a local master without it takes a part of its warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "table", by: Sequence[str] = ()) -> DataFrame:
    """Write once, read back: cuts the lineage, survives lost executors, keeps column pruning.

    With `by`, a later filter on those columns reads only its own part. The table stays until its
    `scope` ends or it is dropped; outside of a scope the folder is the caller's to clean. What was
    shuffled for it goes once it is written.
    """
    for observe in observers:
        observe(name, df)
    path = new_path(df.sparkSession, name)
    with swept(df.sparkSession):
        df.write.partitionBy(*by).parquet(path)
    if _scopes:
        _scopes[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def parts_of(df: DataFrame) -> list[str]:
    """Files of a table that `materialise` wrote, in the order of its partitions."""
    return sorted(df.inputFiles())


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def drop(df: DataFrame) -> None:
    """Delete a table that `materialise` wrote and nothing reads any more."""
    folder = _plain(shared_folder(df.sparkSession))
    for path in {_plain(f).rpartition("/")[0] for f in df.inputFiles()}:
        # Up to the table's own folder, from one of a partitioned table's parts.
        own = path.removeprefix(f"{folder}/").partition("/")[0]
        if path.startswith(f"{folder}/") and own:
            _delete(df.sparkSession, f"{folder}/{own}")


def drop_part(df: DataFrame, part: str) -> None:
    """Delete one part (`column=value`) of a table that `materialise` wrote by columns; later reads leave it out."""
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if path.endswith(f"/{part}"):
            _delete(df.sparkSession, path)


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside leave no shuffle files: Spark deletes a job's when it ends, not when the driver's memory fills."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _plain(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:").rstrip("/")


@contextmanager
def scope(spark: SparkSession, *, keep: Sequence[str] = ()) -> Iterator[None]:
    """Deletes the tables written inside when it ends, but for those whose name is in `keep`.

    For work that has written its results by then: a frame returned from inside must read none of
    the deleted tables.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            name = path.rpartition("/")[2].rpartition("-")[0]
            if name not in keep:
                _delete(spark, path)
            elif _scopes:
                _scopes[-1].append(path)

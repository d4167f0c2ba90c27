"""Sorted arrays in files of the shared folder, memory-mapped by workers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext

FILES = "part bigint, low bigint, rows bigint, path string"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def save(folder: str, part: int, columns: dict[str, np.ndarray], low: int = 0) -> pa.RecordBatch:
    """Writes equally long arrays as one file each, named by this attempt; returns the row that lists them."""
    store, place = opened(folder)
    store.create_dir(place, recursive=True)
    stem = f"{part:08d}-{TaskContext.get().taskAttemptId()}"
    for name, values in columns.items():
        with store.open_output_stream(f"{place}/{stem}.{name}") as out:
            out.write(np.ascontiguousarray(values).tobytes())
    rows = len(next(iter(columns.values())))
    arrays = [pa.array([part], pa.int64()), pa.array([low], pa.int64()), pa.array([rows], pa.int64()), pa.array([f"{folder}/{stem}"])]
    return pa.RecordBatch.from_arrays(arrays, ["part", "low", "rows", "path"])


def mapped(path: str, name: str, kind: str, rows: int) -> np.ndarray:
    """A file's array: mapped where the folder is mounted, else read."""
    if not rows:
        return np.empty(0, kind)
    store, place = opened(f"{path}.{name}")
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(place, dtype=kind, mode="r", shape=(rows,))
    with store.open_input_stream(place) as source:
        return np.frombuffer(source.read(), kind)


def columns(batches: Iterator[pa.RecordBatch], *names: str) -> list[np.ndarray]:
    """All rows of a partition as arrays; for partitions of bounded size."""
    held = list(batches)
    return [np.concatenate([np.asarray(b.column(n)) for b in held]) if held else np.empty(0, np.int64) for n in names]

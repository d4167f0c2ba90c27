"""Token ids in binary files of patched frame-of-reference blocks.

A block of 256 ids stores its minimum and the differences to it, packed at the width that a percentile
of them fits; for the others (exceptions) the place in the block and the bits above the width are kept
apart. An index holds where each block's words and exceptions start, so that any range of ids is read by
decoding its blocks alone. A file also holds its documents' ids and ends.

Files are written by tasks over ranges of doc_id, under names of their own attempt. A table of the
attempts that succeeded says which files count, so a lost executor leaves no wrong file behind.

Rules: NULL doc_id stands first; NULL text is empty and holds the end id alone; repeated doc_ids are
ordered by the digest of their text; an empty table gives no file and no rows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revrec.llm.texts import documents, library_encoder, slices, small_batches, sparing, whole
from revrec.sources.shared import materialise, new_path

BLOCK, LANES = 256, 64
#: Share of a block's differences that its width must hold.
PERCENTILE = 0.9
#: Ids after which a task begins another file.
FILE_IDS = 2 << 20
#: Bytes of text that a worker holds as pieces at once.
SLICE_BYTES = 8 << 20
#: Rows of one doc_id that may stay in one range.
SAME_ID = 1000
#: Ids that a task reads back, in whole files.
READ_IDS = 4 * FILE_IDS
MAGIC = b"PFORIDS1"
_HEAD = struct.Struct("<8sQQQQ")  # magic; numbers of documents, ids, words, exceptions


def _bits(x: np.ndarray) -> np.ndarray:
    return np.frexp(x.astype(np.float64))[1]


def _pack(rows: np.ndarray, width: int) -> np.ndarray:
    """64 numbers a row into `width` words a row."""
    out = np.zeros((len(rows), width), np.uint64)
    for lane in range(LANES if width else 0):
        word, shift = divmod(lane * width, 64)
        out[:, word] |= rows[:, lane] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= rows[:, lane] >> np.uint64(64 - shift)
    return out


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(words), LANES), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for lane in range(LANES if width else 0):
        word, shift = divmod(lane * width, 64)
        out[:, lane] = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            out[:, lane] |= words[:, word + 1] << np.uint64(64 - shift)
        out[:, lane] &= mask
    return out


def dump(keys: list[int | None], ends: np.ndarray, ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """One file: documents' keys, the end of each in the ids, and the ids."""
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    padded = np.full(blocks * BLOCK, ids[-1] if n else 0, np.uint32)
    padded[:n] = ids
    rows = padded.reshape(blocks, BLOCK)
    least = rows.min(axis=1) if blocks else np.empty(0, np.uint32)
    over = (rows - least[:, None]).astype(np.uint64)
    bits = _bits(over)
    place = min(BLOCK - 1, max(0, int(np.ceil(percentile * BLOCK)) - 1))
    widths = np.partition(bits, place, axis=1)[:, place].astype(np.int64) if blocks else np.empty(0, np.int64)
    per = BLOCK // LANES
    starts = np.concatenate([[0], np.cumsum(widths * per)]).astype(np.uint64)
    words = np.zeros(int(starts[-1]), np.uint64)
    for width in np.unique(widths).tolist():
        own = np.flatnonzero(widths == width)
        low = over[own] & np.uint64((1 << width) - 1)
        packed = _pack(low.reshape(-1, LANES), width).reshape(len(own), per * width)
        words[starts[own].astype(np.int64)[:, None] + np.arange(per * width)] = packed
    block, lane = np.nonzero(bits > widths[:, None]) if blocks else (np.empty(0, int), np.empty(0, int))
    high = (over[block, lane] >> widths[block].astype(np.uint64)).astype("<u4")
    first = np.searchsorted(block, np.arange(blocks + 1)).astype("<u8")
    null = np.array([k is None for k in keys], np.uint8)
    parts = [
        np.array([0 if k is None else k for k in keys], "<i8"), np.asarray(ends, "<u8"),
        starts.astype("<u8"), first, words.astype("<u8"), least.astype("<u4"), high,
        widths.astype(np.uint8), lane.astype(np.uint8), null,
    ]
    return _HEAD.pack(MAGIC, len(keys), n, len(words), len(high)) + b"".join(p.tobytes() for p in parts)


class TokenFile:
    """Reads a file's bytes; `ids(a, b)` decodes only the blocks of that range."""

    def __init__(self, data: bytes):
        magic, docs, self.n, words, exceptions = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        blocks, at = -(-self.n // BLOCK), _HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        keys, self.ends = take("<i8", docs), take("<u8", docs).astype(np.int64)
        self.starts, self.first = take("<u8", blocks + 1).astype(np.int64), take("<u8", blocks + 1).astype(np.int64)
        self.words, self.least, self.high = take("<u8", words), take("<u4", blocks), take("<u4", exceptions)
        self.widths, self.lane, null = take("u1", blocks), take("u1", exceptions), take("u1", docs)
        self.keys = [None if gone else key for key, gone in zip(keys.tolist(), null.tolist())]

    def ids(self, a: int = 0, b: int | None = None) -> np.ndarray:
        b = self.n if b is None else b
        if b <= a:
            return np.empty(0, np.uint32)
        low, high = a // BLOCK, -(-b // BLOCK)
        per, out = BLOCK // LANES, np.zeros((high - low, BLOCK), np.uint64)
        widths = self.widths[low:high].astype(np.int64)
        for width in np.unique(widths).tolist():
            own = np.flatnonzero(widths == width)
            packed = self.words[self.starts[low + own][:, None] + np.arange(per * width)]
            out[own] = _unpack(packed.reshape(-1, width), width).reshape(-1, BLOCK) if width else 0
        left, right = self.first[low], self.first[high]
        block = np.repeat(np.arange(high - low), np.diff(self.first[low:high + 1]))
        out[block, self.lane[left:right]] |= self.high[left:right].astype(np.uint64) << widths[block].astype(np.uint64)
        out += self.least[low:high, None]
        return out.reshape(-1)[a - low * BLOCK:b - low * BLOCK].astype(np.uint32)


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


_FILES = "part int, file int, path string, docs bigint, ids bigint, bytes bigint"


def write(docs: DataFrame, path: str, end_id: int, folder: str, file_ids: int = FILE_IDS) -> DataFrame:
    """Writes the ids of all documents in ascending doc_id order under `folder`; one row per file.

    The folder must be one that all executors share and pyarrow can write (file, hdfs, s3, gs).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, context = library_encoder(path), TaskContext.get()
        store, place = _opened(folder)
        store.create_dir(place, recursive=True)
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        number = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, number
            sizes = np.concatenate([h[1] for h in held])
            data = dump([k for h in held for k in h[0]], np.cumsum(sizes), np.concatenate([h[2] for h in held]))
            name = f"{context.partitionId():06d}-{number:05d}-{context.taskAttemptId()}.pfor"
            with store.open_output_stream(f"{place}/{name}") as out:
                out.write(data)
            row = [[context.partitionId()], [number], [f"{folder}/{name}"], [len(sizes)], [int(sizes.sum())], [len(data)]]
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            held, number = [], number + 1
            arrays = [pa.array(v, t) for v, t in zip(row, kinds)]
            return pa.RecordBatch.from_arrays(arrays, ["part", "file", "path", "docs", "ids", "bytes"])

        waiting = 0
        for batch in batches:
            for part in slices(batch, most=min(SLICE_BYTES, 4 * file_ids)):
                offsets, ids = coder.ids(whole(part.column("text")))
                sizes = np.diff(offsets) + 1
                ids = np.insert(ids, offsets[1:], end_id)
                held.append((part.column("doc_id").to_pylist(), sizes, ids))
                waiting += len(ids)
                if waiting >= file_ids:
                    yield flush()
                    waiting = 0
        if held:
            yield flush()

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    # Ranges are drawn from a sample of the key. With the digest in it every text is read once more, so that is
    # there only where one id has so many rows that they must be spread.
    most = slim.groupBy("doc_id").count().agg(F.max("count")).first()[0] or 0
    ranged = slim.repartitionByRange(*order[:1 + (most > SAME_ID)]).sortWithinPartitions(*order, "text")
    with small_batches(docs.sparkSession, SLICE_BYTES):
        return materialise(ranged.mapInArrow(sparing(run), _FILES), "token-files")


def read(files: DataFrame) -> DataFrame:
    """(doc_id, start, tokens) from the files: tokens are little-endian unsigned 32-bit ids.

    Only one row per file reaches the driver, for the number of ids before each file.
    """
    spark = files.sparkSession
    rows = sorted(files.select("part", "file", "path", "ids").collect())
    before = list(accumulate((r["ids"] for r in rows), initial=0))
    placed = spark.createDataFrame([(r["path"], b) for r, b in zip(rows, before)], "path string, before bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                store, place = _opened(path)
                with store.open_input_stream(place) as source:
                    held = TokenFile(source.read())
                starts = np.concatenate([[0], held.ends[:-1]]).astype(np.int64)
                for at in range(0, len(starts), 512):
                    a, b = starts[at], held.ends[at:at + 512][-1]
                    raw = held.ids(int(a), int(b)).astype("<u4").tobytes()
                    cuts = [(int(x - a) * 4, int(y - a) * 4) for x, y in zip(starts[at:at + 512], held.ends[at:at + 512])]
                    arrays = [
                        pa.array(held.keys[at:at + 512], pa.int64()), pa.array(starts[at:at + 512] + base),
                        pa.array([raw[x:y] for x, y in cuts], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "tokens"])

    tasks = max(1, -(-before[-1] // READ_IDS))
    return placed.repartition(tasks, "path").mapInArrow(sparing(run), "doc_id bigint, start bigint, tokens binary")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids, from files that were written and read back."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    files = write(documents(spark, sf_dir), path, 0, new_path(spark, "tokens"))
    return read(files).select(
        "doc_id", "start",
        F.expr("octet_length(tokens) div 4").cast("long").alias("n_tokens"),
        F.crc32("tokens").alias("ids_crc32"),
    )

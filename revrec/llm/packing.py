"""Best-fit-decreasing packing of tokenised documents into sequences of a fixed capacity.

Pieces are spread evenly over groups of about 500 sequences; each group is packed by best-fit decreasing. A
segment tree over the remaining capacities finds the tightest open sequence in logarithmic time per
piece. A group's last sequences may stay open, one or two of hundreds, so grouping costs next to nothing.
A task packs its groups one after the other, so its memory follows a group's size and not the table's.

Rules: a NULL text is an empty one and holds the end id alone; repeated rows are packed as often as they
stand there; a NULL length or one above the capacity is an error; an empty table gives no rows; columns
named like the result's own (`sequence_id`, `offset`) are replaced.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revrec.llm.texts import documents, library_encoder, slices, small_batches, sparing, whole
from revrec.sources.shared import materialise

CAPACITY = 4096
#: Sequences' worth of tokens that are packed together, and pieces at most.
GROUP_SEQUENCES, GROUP_ROWS = 512, 1 << 17
#: Bytes of text that a worker holds as pieces at once.
SLICE_BYTES = 8 << 20
_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_BIN_BITS = 32


class OpenSequences:
    """Open sequences by remaining capacity; the tree's inner nodes say whether any stands below."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = bytearray(2 * self.size)
        self.stacks: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, remaining: int, sequence: int) -> None:
        self.stacks[remaining].append(sequence)
        node = remaining + self.size
        while node and not self.any[node]:
            self.any[node] = 1
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """(remaining, sequence) with the least remaining capacity that holds `length`."""
        any_, node = self.any, length + self.size
        while not any_[node]:
            # Up to the first right sibling that has something, passing over what lies left.
            while node & 1 or not any_[node + 1]:
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.size:
            node = 2 * node + (not any_[2 * node])
        remaining = node - self.size
        sequence = self.stacks[remaining].pop()
        if not self.stacks[remaining]:
            any_[node] = 0
            node >>= 1
            while node and not (any_[2 * node] or any_[2 * node + 1]):
                any_[node] = 0
                node >>= 1
        return remaining, sequence


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Sequence and offset of each length; lengths are taken in the order given (descending: BFD)."""
    tree, count, sequences, offsets = OpenSequences(capacity), 0, [], []
    for length in lengths:
        if length is None or not 0 <= length <= capacity:
            raise ValueError(f"length {length} is not between 0 and {capacity}")
        found = tree.take(length)
        if found is None:
            found = (capacity, count)
            count += 1
        remaining, sequence = found
        sequences.append(sequence)
        offsets.append(capacity - remaining)
        tree.put(remaining - length, sequence)
    return sequences, offsets


def pieces(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Token pieces of whole documents, each with its end id; only documents above the capacity are cut.

    With `with_ids`, also the ids of each piece.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = library_encoder(path)
        for batch in batches:
            for part in slices(batch, most=SLICE_BYTES):
                offsets, ids = coder.ids(whole(part.column("text")))
                keys, out = part.column("doc_id").to_pylist(), []
                for key, a, b in zip(keys, offsets[:-1].tolist(), offsets[1:].tolist()):
                    own = np.append(ids[a:b], end_id).astype("<u4")
                    for k, at in enumerate(range(0, len(own), capacity)):
                        cut = own[at:at + capacity]
                        row = (key, k, at, len(cut), zlib.crc32(cut.tobytes()))
                        out.append((*row, cut.astype(np.int32)) if with_ids else row)
                columns = list(zip(*out)) or [[]] * (5 + with_ids)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names[:len(arrays)])

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(sparing(run), _PIECES + (", ids array<int>" if with_ids else ""))


def pack(lengths: DataFrame, length: str = "length", capacity: int = CAPACITY, group_sequences: int = GROUP_SEQUENCES,
         group_rows: int = GROUP_ROWS) -> DataFrame:
    """Adds `sequence_id` and `offset` to a written table of pieces.

    Rows are dealt out by their place in the table, so that a lost task is repeated with the same rows
    and no key can fill a group; only the columns given travel, so pass ids by a later join.
    """
    lengths = lengths.drop("sequence_id", "offset")
    rows, tokens = lengths.agg(F.count("*"), F.coalesce(F.sum(length), F.lit(0))).first()
    groups = max(1, math.ceil(tokens / (capacity * group_sequences)), math.ceil(rows / group_rows))
    columns = [c for c in lengths.columns if c != length]
    dealt = lengths.withColumn("__p_row", F.monotonically_increasing_id())
    dealt = dealt.withColumn("__p_group", F.pmod(F.xxhash64("__p_row"), F.lit(groups)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in lengths.schema)

    def packed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        sequences, offsets = best_fit(table.column(length).to_pylist(), capacity)
        base = table.column("__p_group")[0].as_py() << _BIN_BITS
        out = table.drop_columns(["__p_row", "__p_group"])
        out = out.append_column("sequence_id", pa.array(np.array(sequences, np.int64) + base))
        yield from out.append_column("offset", pa.array(offsets, pa.int64())).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            group = np.asarray(batch.column("__p_group"))
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
            for a, b in zip(cuts, cuts[1:]):
                if held and b > a and held[-1].column("__p_group")[0].as_py() != group[a]:
                    yield from packed(held)
                    held = []
                if b > a:
                    held.append(batch.slice(a, b - a))
        if held:
            yield from packed(held)

    return (
        dealt.repartition("__p_group")
        .sortWithinPartitions("__p_group", F.col(length).desc(), *columns, "__p_row")
        .mapInArrow(sparing(run), f"{schema}, sequence_id bigint, offset bigint")
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence, from packed pieces with `ids`; a sequence holds `capacity` at most."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of documents with their sequences. Tokens are made once: the pieces' table is written."""
    with small_batches(docs.sparkSession, SLICE_BYTES):
        made = materialise(pieces(docs, path, end_id, capacity), "pieces")
    return pack(made, capacity=capacity)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))

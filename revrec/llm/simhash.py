"""SimHash near-duplicates: fingerprints, links within a bit distance, connected classes.

Candidates come from blocks of the fingerprint: with `radius + c` blocks, two fingerprints within the
radius agree on c blocks at least, so every link shares a bucket of some choice of c blocks. The number
of blocks follows the number of fingerprints; no choice loses a link. A large bucket is dealt out in
pairs of parts, so that no task holds it whole.

Inside a bucket the comparison is bit-sliced: bit planes stand vertically, one word holds 64 pairs at
the same distance in the sorted bucket, carry-save counters add up the differing bits of all pairs at
once, and a block of pairs is left as soon as all of its pairs exceed the radius. Pairs that are
connected already are not compared again, and only one link per fingerprint leaves a bucket.

Rules: a text without words (NULL, empty) has fingerprint zero and links like any other; exact copies
and repeated rows share a fingerprint and so a class; component_id ignores NULL doc_ids and is NULL only
where a class has no other; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revrec.llm.texts import documents, slices
from revrec.sources.shared import materialise

SHINGLE, RADIUS, SEED = 4, 4, 42
#: Fingerprints of a bucket that stay together; larger buckets are compared in pairs of parts of half that.
BUCKET = 4096
#: Expected fingerprints in a bucket above which more blocks are used.
CROWD = 256
#: Rows that a task compares at once.
_ROWS, _LANES = 1 << 17, 64 * 64
_ONE = np.uint64(1)


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """A bit is 1 if it is set in over half of the shingles' XXH64."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = [digest(b" ".join(words), seed)]
    else:
        hashes = [digest(b" ".join(w), seed) for w in zip(*(words[i:] for i in range(shingle)))]
    raw = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(raw), 1 << 16):
        ones += np.unpackbits(raw[at:at + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, text_hash, fp) of whole texts; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text").cast(pa.large_binary()).to_pylist()
                own = np.array([fingerprint(t or b"", shingle, seed) for t in texts], np.uint64).view(np.int64)
                columns = [part.column("doc_id"), part.column("text_hash"), pa.array(own)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "fp"])

    slim = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    )
    return slim.mapInArrow(run, "doc_id bigint, text_hash bigint, fp bigint")


# ---------------------------------------------------------------- bit-sliced comparison

def bit_planes(values: np.ndarray, spare: int) -> np.ndarray:
    """Plane b holds bit b of all values, 64 a word, and `spare` zero words more."""
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    rows = np.packbits(bits.T, axis=1, bitorder="little")
    words = -(-len(values) // 64) + spare
    out = np.zeros((64, words * 8), np.uint8)
    out[:, :rows.shape[1]] = rows
    return out.view("<u8")


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is greater than the radius, bit by bit from the highest."""
    greater = np.zeros_like(counters[0])
    equal = ~greater
    for b in reversed(range(len(counters))):
        if radius >> b & 1:
            equal = equal & counters[b]
        else:
            greater |= equal & counters[b]
            equal = equal & ~counters[b]
    return greater


def near(planes: np.ndarray, step: int, active: np.ndarray, radius: int) -> np.ndarray:
    """Lanes i of `active` (one bit each) whose values i and i + step differ in `radius` bits at most."""
    per = _LANES // 64
    blocks = np.flatnonzero(active.reshape(-1, per).any(axis=1))
    shift, bits = divmod(step, 64)
    out = np.zeros_like(active)
    at = blocks[:, None] * per + np.arange(per)
    alive = active[at]
    width = (radius + 1).bit_length()
    counters = [np.zeros_like(alive) for _ in range(width)]
    over = np.zeros_like(alive)

    def differing(b: int) -> np.ndarray:
        other = planes[b][at + shift]
        if bits:
            other = (other >> np.uint64(bits)) | (planes[b][at + shift + 1] << np.uint64(64 - bits))
        return planes[b][at] ^ other

    for b in range(0, 64, 2):
        # Two planes and the ones: a carry-save adder; its carry then ripples through the higher counters.
        x, y = differing(b), differing(b + 1)
        half = counters[0] ^ x
        carry = (counters[0] & x) | (half & y)
        counters[0] = half ^ y
        for k in range(1, width):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if b % 8 == 6:
            alive &= ~(over | _above(counters, radius))
            stays = alive.any(axis=1)
            if not stays.all():
                at, alive, over = at[stays], alive[stays], over[stays]
                counters = [c[stays] for c in counters]
            if not len(at):
                return out
    out[at] = alive
    return out


def merge_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after joining the classes of each pair; a class has its smallest label."""
    while True:
        a, b = label[i], label[j]
        if (a == b).all():
            return label
        parent = np.arange(len(label))
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while (parent[parent] != parent).any():
            parent = parent[parent]
        label = parent[label]


def linked(values: np.ndarray, group: np.ndarray, radius: int) -> np.ndarray:
    """For rows sorted by group: the place of each row's representative in its group."""
    n = len(values)
    label = np.arange(n)
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if n else np.empty(0, int)
    longest = int(np.diff(np.append(starts, n)).max(initial=0))
    words = -(-n // _LANES) * _LANES // 64
    planes = bit_planes(values, words - -(-n // 64) + longest // 64 + 2)
    for step in range(1, longest):
        pairs = (group[:-step] == group[step:]) & (label[:-step] != label[step:])
        if not pairs.any():
            continue
        active = np.zeros(words * 8, np.uint8)
        bits = np.packbits(pairs, bitorder="little")
        active[:len(bits)] = bits
        found = near(planes, step, active.view("<u8").copy(), radius)
        i = np.flatnonzero(np.unpackbits(found.view(np.uint8), bitorder="little"))
        if len(i):
            label = merge_labels(label, i, i + step)
    return label


# ---------------------------------------------------------------- candidates

def block_masks(count: int, radius: int) -> list[int]:
    """The masks of all choices of blocks that two fingerprints within the radius can share."""
    blocks, low = radius, 64
    while True:
        blocks += 1
        edges = [64 * i // blocks for i in range(blocks + 1)]
        parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
        low = (64 // blocks) * (blocks - radius)
        if count >> low <= CROWD or comb(blocks + 1, radius) > 256:
            return [sum(c) for c in combinations(parts, blocks - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(distinct: DataFrame, count: int, radius: int = RADIUS) -> DataFrame:
    """(a, b): each fingerprint and a representative of its bucket that it is connected with."""
    masks = block_masks(count, radius)
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k")) for i, m in enumerate(masks)])
    keyed = distinct.select("fp", F.explode(tables).alias("s")).select("fp", "s.t", "s.k")
    sizes = keyed.groupBy("t", "k").agg(F.count("*").alias("n")).filter(F.col("n") > BUCKET)
    parts = F.ceil(F.coalesce(F.col("n"), F.lit(1)) / (BUCKET // 2))
    parts = F.when(F.col("n").isNull(), F.lit(1)).otherwise(parts).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(F.least(j, "own").alias("x"), F.greatest(j, "own").alias("y")))
    dealt = (
        keyed.join(sizes, ["t", "k"], "left").withColumn("parts", parts).withColumn("own", own)
        .select("t", "k", "fp", F.explode(pairs).alias("p")).select("t", "k", "p.x", "p.y", "fp")
    )

    def compared(table: pa.Table, cuts: np.ndarray) -> pa.RecordBatch:
        values = np.asarray(table.column("fp")).view(np.uint64)
        label = linked(values, np.cumsum(cuts), radius)
        moved = label != np.arange(len(label))
        pairs = np.unique(np.column_stack([values[moved], values[label[moved]]]), axis=0).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= _ROWS:
                table = pa.Table.from_batches(held)
                cuts = _cuts(table)
                last = int(np.flatnonzero(cuts)[-1])  # the last group may go on in the next batch
                if last:
                    yield compared(table.slice(0, last), cuts[:last])
                held = table.slice(last).combine_chunks().to_batches()
                rows = len(table) - last
        if rows:
            table = pa.Table.from_batches(held)
            yield compared(table, _cuts(table))

    groups = ["t", "k", "x", "y"]
    return dealt.repartition(*groups).sortWithinPartitions(*groups, "fp").mapInArrow(run, "a bigint, b bigint")


def _cuts(table: pa.Table) -> np.ndarray:
    cut = np.zeros(len(table), bool)
    cut[:1] = True
    for name in ("t", "k", "x", "y"):
        column = np.asarray(table.column(name))
        cut[1:] |= column[1:] != column[:-1]
    return cut


# ---------------------------------------------------------------- classes

def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes on edges (a, b), by contraction.

    In a round every node moves to the smallest of itself and its neighbours, in an order that changes
    from round to round, and edges are drawn anew between those; classes shrink by a constant factor.
    """
    rounds: list[DataFrame] = []
    edges = materialise(edges.filter("a <> b").distinct(), "edges")
    while not edges.isEmpty():
        mix = F.lit(_signed((0x9E3779B97F4A7C15 * (len(rounds) + 1)) % (1 << 64)))

        def order(x: Column) -> Column:
            return x.bitwiseXOR(mix)

        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(order(F.col("b"))).alias("m"))
        moved = materialise(least.select(F.col("a").alias("node"), order(F.least("m", order(F.col("a")))).alias("to")), "moves")
        rounds.append(moved)
        first = moved.select(F.col("node").alias("a"), F.col("to").alias("ta"))
        second = moved.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        drawn = edges.join(first, "a").join(second, "b").select(F.col("ta").alias("a"), F.col("tb").alias("b"))
        edges = materialise(drawn.filter("a <> b").distinct(), "edges")
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = rounds[-1].select("node", F.col("to").alias("root"))
    for moved in reversed(rounds[:-1]):
        later = out.select(F.col("node").alias("to"), "root")
        out = moved.join(later, "to", "left").select("node", F.coalesce("root", "to").alias("root"))
    return out


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id), one row per row of `docs`; `root` names the class."""
    own = materialise(fingerprints(docs, shingle, seed), "fingerprints")
    distinct = materialise(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = connected(links(distinct.select("fp"), distinct.count(), radius))
    placed = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    placed = materialise(placed, "classes")
    ids = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    members = materialise(placed.select("fp", "root").join(ids, "root"), "members")
    return own.join(members, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """Rows of `docs` with one document of each class: the smallest doc_id (NULL last), then text digest."""
    found = near_duplicates(docs, **options)
    rows = found.groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("rows"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    best = rows.groupBy("root").agg(F.min_by(F.struct("doc_id", "text_hash", "rows"), order).alias("b"))
    kept = materialise(best.select(F.col("b.doc_id").alias("_kept_id"), F.col("b.text_hash").alias("_kept_hash"), F.col("b.rows").alias("_kept_rows")), "kept")
    text = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_kept_id")) & (text == F.col("_kept_hash"))
    # Rows that stand there more than once are few apart from odd inputs: only they are compared as wholes.
    single = docs.join(kept.filter("_kept_rows = 1"), same, "left_semi")
    again = docs.join(kept.filter("_kept_rows > 1"), same).withColumn("_kept", F.struct("_kept_id", "_kept_hash"))
    return single.unionByName(again.dropDuplicates(["_kept"]).select(*docs.columns))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

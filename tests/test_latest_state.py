"""A state kept up to date by batches: the newest row per key, whatever comes in whichever order."""

from itertools import permutations

import pytest
from pyspark.sql import functions as F

from revrec.operators import latest_state
from revrec.operators.latest_state import LatestState
from revrec.plans import curate
from revrec.sources import artifacts, shared

ROWS = [
    (1, 5, "a"), (1, 7, "b"), (2, 3, "c"), (2, None, "d"), (None, 1, "e"), (None, 2, "f"),
    (3, 4, "g"), (3, 4, "h"), (4, 9, None), (4, 9, "i"), (5, None, "j"),
]
WANT = {(1, 7, "b"), (2, 3, "c"), (None, 2, "f"), (3, 4, "h"), (4, 9, "i"), (5, None, "j")}


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, at long, v string")


def state(folder, name="s", buckets=4):
    return LatestState(f"{folder}/{name}", ("k",), "at", buckets=buckets)


def test_any_order_of_batches_gives_the_same_state(spark, folder):
    batches = [ROWS[0::3], ROWS[1::3], ROWS[2::3]]
    for n, order in enumerate(permutations(range(3))):
        own = state(folder, f"s{n}")
        for b in order:
            own.merge(frame(spark, batches[b]))
        assert own.merge(frame(spark, batches[order[0]])) == 4  # a batch that comes twice
        assert set(map(tuple, own.read(spark).collect())) == WANT and own.read(spark).count() == len(WANT)


def test_an_empty_batch_and_no_state(spark, folder):
    own = state(folder)
    with pytest.raises(ValueError):
        own.read(spark)
    assert own.merge(frame(spark, [])) == 0
    assert own.merge(frame(spark, ROWS)) == 1
    assert own.merge(frame(spark, [])) == 1 and own.read(spark).count() == len(WANT)


def test_only_touched_buckets_are_read_and_written(spark, folder):
    own = state(folder, buckets=16)
    own.merge(frame(spark, [(k, 1, "x") for k in range(200)]))
    before = own._held(spark)[1]
    own.merge(frame(spark, [(7, 2, "y")]))
    after = own._held(spark)[1]
    assert len(before) == 16 and sum(before[b] != after[b] for b in before) == 1
    assert own.read(spark).filter("v = 'y'").count() == 1 and own.read(spark).count() == 200
    # An earlier version stays readable as it was.
    assert own.read(spark, 1).filter("v = 'y'").count() == 0


def test_a_hot_key_and_rejected_revisions(spark, folder):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("uuid"), F.lit(1).alias("customer_id"), F.lit(2).alias("tsin_id"),
        (F.col("id") % 5).cast("int").alias("rating"), F.lit("t").alias("body"),
        F.timestamp_seconds(F.lit(1_740_000_000) + F.col("id")).alias("updated_at"), (F.col("id") % 2).cast("int").alias("moderation_state_id"),
    )
    own = curate.review_state(f"{folder}/r", buckets=8)
    for part in (2, 0, 1):
        curate.merge_revisions(own, rows.filter(F.pmod(F.xxhash64("updated_at"), F.lit(3)) == part))
    got, want = curate.current_reviews(spark, own), curate.latest_reviews(rows)
    assert got.count() == want.count() and not got.exceptAll(want).count()


def test_a_writer_that_comes_second_merges_into_the_first(spark, folder, monkeypatch):
    own, real, raced = state(folder), artifacts.publish, []

    def late(listed, base, verdict, version):
        if not raced:
            raced.append(version)
            state(folder).merge(frame(spark, [(1, 8, "first"), (9, 1, "first")]))
        return real(listed, base, verdict, version)

    monkeypatch.setattr(latest_state.artifacts, "publish", late)
    assert own.merge(frame(spark, [(1, 7, "second"), (8, 1, "second")])) == 2
    assert set(map(tuple, own.read(spark).collect())) == {(1, 8, "first"), (9, 1, "first"), (8, 1, "second")}


def test_a_merge_has_one_exchange_besides_the_batch_s_own(spark, folder):
    own, plans = state(folder), []
    own.merge(frame(spark, ROWS))
    held = own._held(spark)[1]
    newest = shared.materialise(own._newest(frame(spark, ROWS), ["k"]).withColumn("state_bucket", own._bucket()), "batch")
    old = spark.read.schema(newest.drop("state_bucket").schema).parquet(*held.values()).withColumn("state_bucket", own._bucket())
    dealt = own._newest(newest.unionByName(old).repartition(4, "state_bucket"), ["state_bucket", "k"])
    plans.append(dealt._jdf.queryExecution().executedPlan().toString())
    assert plans[0].count("Exchange") == 1

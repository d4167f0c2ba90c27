"""Fitted states: stored and applied to other rows, unknown tokens, hot tokens, odd numbers."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from revrec.operators import transformation as tr
from revrec.operators import vocabulary
from revrec.sources import shared

ANALYSERS = {
    "word": tr.Vocabulary("w", oov_buckets=4), "rare": tr.Vocabulary("v", min_count=3), "x": tr.ZScore("x"),
    "unit": tr.MinMax("x"), "same": tr.ZScore("c"), "flat": tr.MinMax("c"), "bucket": tr.Buckets("x", 5), "one": tr.Buckets("x", 1),
}
SCHEMA = "id bigint, w string, v string, x double, c int"


def rows(seed, n=400):
    draw = random.Random(seed)
    return [(i, draw.choice(["hot"] * 5 + [f"w{draw.randrange(30 + seed)}", "", None]), draw.choice([f"v{draw.randrange(90)}", None]),
             draw.choice([draw.gauss(0, 3), 1.0, None, float("nan")]), 7) for i in range(n)]


def plain(learned, others):
    def ranks(i, least):
        counts = Counter(r[i] for r in learned if r[i])
        order = sorted((t for t in counts if counts[t] >= least), key=lambda t: (counts[t], t.encode()), reverse=True)
        return {t: k for k, t in enumerate(order)}

    words, rare = ranks(1, 1), ranks(2, 3)
    x = [r[3] for r in learned if r[3] is not None and not math.isnan(r[3])]
    cuts = [sorted(x)[math.ceil(k / 5 * len(x)) - 1] for k in range(1, 5)]
    slot = lambda t: len(words) + int(hashlib.md5(t.encode()).hexdigest()[:15], 16) % 4
    out = []
    for i, w, v, value, _ in others:
        ok = value is not None and not math.isnan(value)
        out.append((i, -1 if not w else words.get(w, slot(w)), -1 if not v else rare.get(v, -1),
                    round((value - np.mean(x)) / np.std(x), 9) if ok else None, round((value - min(x)) / (max(x) - min(x)), 9) if ok else None,
                    0.0, 0.0, sum(c <= value for c in cuts) if ok else None, 0 if ok else None))
    return sorted(out)


def test_a_stored_state_serves_rows_not_analysed(spark, folder):
    learned, others = rows(1), rows(20)
    tr.fit(spark.createDataFrame(learned, SCHEMA).repartition(3), ANALYSERS).write(spark, f"{folder}/state")
    state = tr.load(spark, f"{folder}/state")
    assert state.analysers == ANALYSERS
    written = []
    shared.observers.append(lambda name, df: written.append(name))
    try:
        found = state.apply(spark.createDataFrame(others, SCHEMA), keep=["id"])
        got = sorted((r["id"], r["word"], r["rare"], *[None if r[c] is None else round(r[c], 9) for c in ("x", "unit", "same", "flat")],
                      r["bucket"], r["one"]) for r in found.collect())
    finally:
        shared.observers.pop()
    assert got == plain(learned, others) and not written  # nothing is analysed again
    assert state.cardinality("word") == len({r[1] for r in learned if r[1]}) + 4


def test_nothing_to_learn_from(spark):
    state = tr.fit(spark.createDataFrame([], SCHEMA), ANALYSERS)
    row = state.apply(spark.createDataFrame([(1, "a", "b", 1.0, 2)], SCHEMA)).first()
    assert 0 <= row["word"] < 4 and row["rare"] == -1 and row["x"] is None and row["bucket"] == 0


@pytest.mark.parametrize("head", [0, 1, 3, 1000])
def test_head_and_tail_give_the_same(spark, head):
    learned, others = spark.createDataFrame(rows(1), SCHEMA), spark.createDataFrame(rows(9), SCHEMA)
    words = shared.materialise(vocabulary.build_vocabulary(learned, "w"))
    one = vocabulary.apply_vocabulary(others, words, "w", "i", oov_buckets=3, head=head)
    known = {r["token"]: r["index"] for r in words.collect()}
    for r in one.collect():
        if r["w"] in known:
            assert r["i"] == known[r["w"]]
        else:
            assert r["i"] == -1 if not r["w"] else len(known) <= r["i"] < len(known) + 3
    assert one.count() == others.count()


def test_a_hot_token_is_not_shuffled_by_itself(spark):
    """A token in a third of all rows is in the head: the tail's exchange spreads its rows over all partitions."""
    df = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 2000)).alias("w"))
    words = shared.materialise(vocabulary.build_vocabulary(df, "w"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = vocabulary.apply_vocabulary(df, words, "w", "i", head=10)
        text = found._jdf.queryExecution().executedPlan().toString()
        sizes = [r["n"] for r in found.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        small = vocabulary.apply_vocabulary(df, words, "w", "i")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" in text
    assert len(sizes) > 4 and max(sizes) < 2 * 9000 / len(sizes)
    assert "BroadcastHashJoin" in small and "Exchange hashpartitioning" not in small

"""Invariants on random and on deliberately skewed data, against plain Python or plain windows."""

import random

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revrec.operators import negatives, ordering, retrieval, vocabulary
from revrec.operators.keyed import latest_per_key


def skewed(spark, n=5000, seed=0):
    """A third of all rows under one key, some NULL keys."""
    rng = random.Random(seed)
    keys = ["hot" if rng.random() < 1 / 3 else None if rng.random() < 0.05 else f"k{rng.randrange(400)}" for _ in range(n)]
    return spark.createDataFrame([(i, k, rng.randrange(50)) for i, k in enumerate(keys)], "id long, key string, at int").repartition(6)


@pytest.mark.parametrize("partitions", [1, 4, 16, None])
def test_rank_within_equals_row_number(spark, partitions):
    df = skewed(spark)
    ours = ordering.rank_within(df, ["key"], ["at", "id"], "rank", partitions)
    plain = df.withColumn("rank", F.row_number().over(W.partitionBy("key").orderBy("at", "id")).cast("long"))
    assert ours.count() == df.count()
    assert ours.exceptAll(plain).count() == 0


@pytest.mark.parametrize("partitions", [1, 4, 16, None])
def test_ordered_index_is_dense_and_ordered(spark, partitions):
    df = skewed(spark)
    rows = ordering.ordered_index(df, [F.col("at").desc(), F.col("id")], "i", partitions).collect()
    rows.sort(key=lambda r: r["i"])
    assert [r["i"] for r in rows] == list(range(df.count()))
    assert [(-r["at"], r["id"]) for r in rows] == sorted((-r["at"], r["id"]) for r in rows)


def test_ordered_index_of_nothing(spark):
    assert ordering.ordered_index(spark.range(0), ["id"]).count() == 0


@pytest.mark.parametrize("n", [1, 20, 1500])
def test_top_n_equals_full_ranking(spark, n):
    df = skewed(spark)
    ours = ordering.top_n(df, ["key"], [F.col("at").desc(), "id"], n)
    full = df.withColumn("rank", F.row_number().over(W.partitionBy("key").orderBy(F.col("at").desc(), "id")).cast("long"))
    assert ours.exceptAll(full.filter(F.col("rank") <= n)).count() == 0
    assert ours.count() == full.filter(F.col("rank") <= n).count()


def test_batches_have_the_exact_size(spark):
    sizes = [r["count"] for r in ordering.assign_batches(skewed(spark), ["id"], 64).groupBy("batch_id").count().collect()]
    assert sorted(sizes) == [5000 % 64] + [64] * (5000 // 64)


def test_latest_per_key_is_idempotent(spark):
    df = skewed(spark).filter("key is not null")
    once = latest_per_key(df, ["key"], "at", ["id"])
    assert once.exceptAll(latest_per_key(once, ["key"], "at", ["id"])).count() == 0
    assert once.count() == df.select("key").distinct().count()


def test_vocabulary_is_dense_with_falling_counts(spark):
    rows = sorted(vocabulary.build_vocabulary(skewed(spark), "key").collect(), key=lambda r: r["index"])
    assert [r["index"] for r in rows] == list(range(len(rows)))
    assert rows[0]["token"] == "hot"
    assert [(-r["count"]) for r in rows] == sorted(-r["count"] for r in rows)


def vectors(spark, n, seed, name, decimals=None):
    data = np.random.default_rng(seed).normal(size=(n, 8))
    if decimals is not None:  # coarse values make many equal scores
        data = np.round(data, decimals)
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], f"{name} long, embedding array<double>"), data


def brute_force(queries, items, k):
    out = set()
    for q, scores in enumerate(np.round(queries @ items.T, 6)):
        order = sorted(range(len(scores)), key=lambda i: (-scores[i], i))[:k]
        out |= {(q, i, r + 1) for r, i in enumerate(order)}
    return out


@pytest.mark.parametrize("blocks", [(4096, 16384), (7, 5), (1000, 3)])
@pytest.mark.parametrize("decimals", [None, 0])
def test_top_k_equals_brute_force(spark, blocks, decimals):
    queries, q = vectors(spark, 40, 1, "query_id", decimals)
    items, i = vectors(spark, 90, 2, "item_id", decimals)
    got = retrieval.top_k(queries, items, 12, query_block=blocks[0], item_block=blocks[1]).collect()
    assert {(r["query_id"], r["item_id"], r["rank"]) for r in got} == brute_force(q, i, 12)


def test_top_k_is_a_prefix_and_may_exceed_the_items(spark):
    queries, _ = vectors(spark, 10, 1, "query_id")
    items, _ = vectors(spark, 6, 2, "item_id")
    rows = {k: {tuple(r) for r in retrieval.top_k(queries, items, k).collect()} for k in (3, 4, 50)}
    assert rows[3] < rows[4] < rows[50] and len(rows[50]) == 60
    assert retrieval.top_k(queries, items.limit(0), 3).count() == 0


def clustered(spark, n, centres, seed, name):
    rng = np.random.default_rng(seed)
    weights = [1 / 3] + [2 / 3 / (len(centres) - 1)] * (len(centres) - 1)
    data = centres[rng.choice(len(centres), n, p=weights)] + rng.normal(scale=0.05, size=(n, centres.shape[1]))
    data /= np.linalg.norm(data, axis=1)[:, None]
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], f"{name} long, embedding array<double>")


def test_approximate_search_prunes_and_finds(spark):
    centres = np.random.default_rng(5).normal(size=(12, 16))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    queries, items = clustered(spark, 60, centres, 6, "query_id"), clustered(spark, 600, centres, 7, "item_id")
    index = retrieval.build_index(items, 12, seed=3)
    exact = retrieval.top_k(queries, items, 10)
    found = retrieval.approx_top_k(queries, index, 10, 2, query_block=8, item_block=32)
    assert retrieval.recall(found, exact).first()[0] >= 0.95
    assert retrieval.pair_share(queries, index, 2).first()[0] <= 0.5
    assert retrieval.pair_share(queries, index, 12).first()[0] == pytest.approx(1.0)
    # The bound rules most cells out here, and the result is exact all the same.
    pruned = retrieval.pruned_top_k(queries, index, 10, 1, query_block=8, item_block=32)
    assert pruned.count() == exact.count() and pruned.exceptAll(exact).count() == 0
    ready = queries.withColumn("threshold", F.lit(0.9))
    assert retrieval._promising_cells(ready, index, 1).count() < 60 * 4


@pytest.mark.parametrize("decimals", [None, 0])
@pytest.mark.parametrize("probe", [1, 3])
def test_pruned_search_is_exact_on_vectors_of_any_length(spark, decimals, probe):
    queries, q = vectors(spark, 40, 1, "query_id", decimals)
    items, i = vectors(spark, 90, 2, "item_id", decimals)
    index = retrieval.build_index(items, 7, seed=3)
    got = retrieval.pruned_top_k(queries, index, 12, probe, query_block=16, item_block=9).collect()
    assert {(r["query_id"], r["item_id"], r["rank"]) for r in got} == brute_force(q, i, 12)


def test_loss_and_negatives_against_numpy(spark):
    n, size, keep = 150, 40, 9
    rng = np.random.default_rng(3)
    q, p = rng.normal(size=(n, 8)), rng.normal(size=(n, 8))
    # A third of the rows are of one product.
    product = [0 if rng.random() < 1 / 3 else int(rng.integers(1, 30)) for _ in range(n)]
    weight = rng.integers(0, 2, n).astype(float)
    rows = [(i, product[i], q[i].tolist(), p[i].tolist(), float(weight[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, product int, q array<double>, p array<double>, w double").repartition(5)
    expected, pairs = 0.0, set()
    for i in range(n):
        batch = [j for j in range(n) if j // size == i // size and product[j] != product[i]]
        scores = {j: q[i] @ p[j] for j in batch}
        hardest = sorted(batch, key=lambda j: (-round(scores[j], 6), j))[:keep]
        pairs |= {(i, j, r + 1) for r, j in enumerate(hardest)}
        logits = np.array([q[i] @ p[i]] + [scores[j] for j in hardest])
        expected += weight[i] * (np.log(np.exp(logits).sum()) - logits[0])
    loss = negatives.retrieval_loss(df, ["id"], "id", "product", "q", "p", "w", keep, size).first()[0]
    assert loss == pytest.approx(expected)
    got = negatives.hard_negatives(df, ["id"], "id", "product", "q", "p", keep, size).collect()
    assert {(r["row_id"], r["negative_id"], r["rank"]) for r in got} == pairs


def test_batch_of_one_product_has_no_negatives(spark):
    df = spark.createDataFrame([(i, 1, [1.0], [1.0]) for i in range(5)], "id long, product int, q array<double>, p array<double>")
    assert negatives.hard_negatives(df, ["id"], "id", "product", "q", "p").count() == 0
    assert negatives.retrieval_loss(df, ["id"], "id", "product", "q", "p").first()[0] == pytest.approx(0.0)

"""Hash-prefix forest against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from revrec.llm import neighbours


def brute(rows, asks, k=10):
    """(query, rank, id, distance) by exact search over valid rows."""
    valid = {}
    for key, v in rows:
        if key is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        valid[key] = min(valid[key], v) if key in valid else v
    out = {}
    for q in filter(asks, valid):
        own = np.array(valid[q], np.float64)
        near = sorted((float(np.sqrt(((np.array(v, np.float64) - own) ** 2).sum())), i) for i, v in valid.items() if i != q and len(v) == len(own))
        out[q] = [(i, d) for d, i in near[:k]]
    return out


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_op5_recall_and_scores(spark, sf):
    table = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    want = brute(rows, lambda i: i % 100 == 0)
    vectors = {i: np.array(v, np.float64) for i, v in rows}
    got: dict = {}
    for r in neighbours.op5_neighbours(spark, f"/root/testdata/{sf}").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(want)
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 11))
        assert [(f[2], f[1]) for f in found] == sorted((f[2], f[1]) for f in found)
        for _, i, score in found:
            assert i != q and score == pytest.approx(float(np.sqrt(((vectors[i] - vectors[q]) ** 2).sum())), abs=1e-12)
        hits += len({i for i, _ in want[q]} & {f[1] for f in found})
    assert hits / (10 * len(want)) >= 0.9


ROWS = [
    (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 1.0]), (3, [0.0, 0.5]), (4, None), (5, [0.0, 0.0]), (6, [None, 1.0]),
    (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (None, [1.0, 1.0]), (9, [1.0, 2.0, 3.0]), (10, [3.0, 2.0, 1.0]), (0, [1.0, 0.0]), (11, []),
]


def test_edges_are_exact(spark):
    df = spark.createDataFrame([(k, v, 1, 0.0) for k, v in ROWS], "vec_id long, embedding array<float>, rank int, score double")
    got: dict = {}
    for r in neighbours.nearest(df, F.lit(True)).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], pytest.approx(r["score"])))
    assert got == {q: f for q, f in brute(ROWS, lambda i: True).items() if f}
    assert neighbours.nearest(df.limit(0), F.lit(True)).count() == 0
    assert neighbours.nearest(df, F.lit(False)).count() == 0


def test_one_vector_in_most_rows(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ITEM_BLOCK", 64)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 1.0] if i % 3 else rng.normal(size=2).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got: dict = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 40 == 1).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    want = brute(rows, lambda i: i % 40 == 1)
    assert {q: [i for i, _ in f] for q, f in want.items() if rows[q][1] == [1.0, 1.0]}.items() <= got.items()


def test_candidates_share_the_deepest_common_level():
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(300, 8))
    forest = neighbours.Forest(vectors, vectors.mean(axis=0), trees=4, bits=12)
    queries = rng.normal(size=(20, 8))
    strings, own = forest.strings(queries), forest.strings(vectors)
    for q, found in enumerate(forest.candidates(queries, 40)):
        for depth in range(12, -1, -1):
            same = (own >> np.uint64(12 - depth)) == (strings[q] >> np.uint64(12 - depth))
            if same.sum() >= 40:
                break
        assert found.tolist() == np.flatnonzero(same.any(axis=1)).tolist()

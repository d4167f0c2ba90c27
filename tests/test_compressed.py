"""Product-quantised index: codes, tables and re-ranking against numpy, recall, odd vectors."""

import numpy as np
import pytest

from revrec.operators import compressed, retrieval

KIND = "item_id long, embedding array<double>"


def vectors(n, d=16, seed=1, groups=12):
    draw = np.random.default_rng(seed)
    return draw.normal(size=(groups, d))[draw.integers(0, groups, n)] + 0.4 * draw.normal(size=(n, d))


def frame(spark, rows, name="item_id"):
    return spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(rows)], KIND.replace("item_id", name)).repartition(3)


def test_codes_and_scores_are_those_of_numpy(spark):
    items, queries = vectors(300), vectors(20, seed=2)
    index = compressed.compress(frame(spark, items), 3, parts=5, words=8, seed=3)
    assert [b.shape[1] for b in index.books] == [3, 3, 3, 3, 4] and all(len(b) == 8 for b in index.books)
    centres, held = np.array(index.centres), {r["item_id"]: (r["cell"], r["codes"]) for r in index.codes.collect()}
    approx = np.empty((20, 300))
    for i, v in enumerate(items):
        cell, codes = held[i]
        assert cell == np.argmin(((centres - v) ** 2).sum(1)) and len(codes) == 5
        coded, at = centres[cell].copy(), 0
        for book, code in zip(index.books, codes):
            part = v[at:at + book.shape[1]] - centres[cell][at:at + book.shape[1]]
            assert np.isclose(((book[code] - part) ** 2).sum(), ((book - part) ** 2).sum(1).min())
            coded[at:at + book.shape[1]] += book[code]
            at += book.shape[1]
        approx[:, i] = queries @ coded
    rows = compressed.candidates(frame(spark, queries, "query_id"), index, 7, probe=3, query_block=6, item_block=40).collect()
    assert len(rows) == 140
    for r in rows:
        best = np.sort(approx[r["query_id"]])[::-1]
        assert abs(r["score"] - approx[r["query_id"], r["item_id"]]) < 1e-5 and abs(r["score"] - best[r["rank"] - 1]) < 1e-5


def test_recall_at_a_tenth_of_the_bytes(spark):
    items, queries = frame(spark, vectors(4000, 32)), frame(spark, vectors(60, 32, seed=5), "query_id")
    index = compressed.compress(items, 8, parts=8, words=64)
    found = compressed.compressed_top_k(queries, index, 10, 8, 150)
    assert retrieval.recall(found, retrieval.top_k(queries, items)).first()[0] >= 0.9
    assert compressed.bytes_share(index, 4000, 150) < 0.11


def test_whole_rerank_is_exact_and_ties_go_by_id(spark):
    rows = np.round(vectors(120, 6), 0)
    index = compressed.compress(frame(spark, rows), 2, parts=3, words=4)
    found = compressed.compressed_top_k(frame(spark, rows, "query_id"), index, 5, 2, 120)
    exact = retrieval.top_k(frame(spark, rows, "query_id"), frame(spark, rows), 5)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, exact.collect()))


def test_odd_vectors(spark):
    good = [(i, [float(i % 3), 1.0]) for i in range(9)]
    bad = [(20, None), (21, []), (22, [float("nan"), 1.0]), (None, [1.0, 1.0])]
    index = compressed.compress(spark.createDataFrame(good + bad, KIND), 2, words=4)
    assert index.codes.count() == 9
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [1.0, 2.0, 3.0])], KIND.replace("item_id", "query_id"))
    assert {r["query_id"] for r in compressed.compressed_top_k(queries, index, 3).collect()} == {1}
    assert compressed.compress(spark.createDataFrame([*good, (30, [1.0, 2.0, 3.0])], KIND), 2, words=4).codes.count() == 9
    with pytest.raises(ValueError, match="no items"):
        compressed.compress(spark.createDataFrame([], KIND))


def test_a_longer_vector_does_not_empty_the_search(spark):
    """One item of three numbers among twenty of two: the others are still found, with and without an index."""
    items = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(20)] + [(99, [1.0, 2.0, 3.0])], KIND)
    queries = spark.createDataFrame([(q, [1.0, float(q)]) for q in range(5)] + [(7, [1.0, 0.0, 1.0]), (8, [1.0])], KIND.replace("item_id", "query_id"))
    index = retrieval.build_index(items, 2)
    for found in (retrieval.top_k(queries, items, 3), retrieval.pruned_top_k(queries, index, 3), retrieval.approx_top_k(queries, index, 3, 2)):
        rows = [(r["query_id"], r["item_id"]) for r in found.orderBy("query_id", "rank").collect()]
        assert rows == [(q, i) for q in range(5) for i in (19, 18, 17)]

"""Blocks that travel in parts, scores screened in single precision, and pruning that counts before it writes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from revrec.operators import compressed, retrieval
from revrec.sources import shared

KIND = "item_id long, embedding array<double>"


def frame(spark, rows, name="item_id"):
    return spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(rows)], KIND.replace("item_id", name)).repartition(3)


@pytest.fixture
def written():
    seen = []
    observe = lambda name, df: seen.append((name, df))
    shared.observers.append(observe)
    yield seen
    shared.observers.remove(observe)


@pytest.mark.parametrize("kind", ["plain", "copies", "equal", "scales", "huge"])
@pytest.mark.parametrize("blocks", [(65536, 65536), (16, 24)])
def test_best_pairs_are_those_of_all_scores(kind, blocks):
    draw = np.random.default_rng(4)
    q, i, k = draw.normal(size=(300, 6)), draw.normal(size=(2500, 6)), 7
    if kind == "copies":
        q, i = np.round(q, 1), i[draw.integers(0, 40, len(i))]
    elif kind == "equal":
        i[:] = i[0]
    elif kind == "scales":
        q, i = q * draw.choice([1e-9, 1, 1e6], (300, 1)), i * draw.choice([0, 1e-9, 1, 1e5], (2500, 1))
    elif kind == "huge":
        q[::5] *= 1e200
        i[::7] *= 1e200
        q[1] = 0
    with np.errstate(all="ignore"):
        scores = np.round(q @ i.T, retrieval.SCORE_DIGITS)
        rows, cols = retrieval.best_columns(scores, k)
        found = retrieval.best_pairs(q, len(i), lambda a, b: i[a:b], k, *blocks)
    assert (found[0] == rows).all() and (found[1] == cols).all() and np.allclose(found[2], scores[rows, cols], rtol=1e-12)


def test_small_blocks_send_each_side_no_more_often(spark, written):
    """Each side was sent once per block of the other: ten blocks of 20 items, fifty of four queries."""
    draw = np.random.default_rng(2)
    items, queries = draw.normal(size=(200, 4)), draw.normal(size=(200, 4))
    found = retrieval.top_k(frame(spark, queries, "query_id"), frame(spark, items), 3, query_block=4, item_block=20)
    layout = next(df for name, df in written if name == "layout").first()
    assert (layout["q_parts"], layout["i_parts"]) == (1, 1)
    rows, cols = retrieval.best_columns(np.round(queries @ items.T, retrieval.SCORE_DIGITS), 3)
    assert {(r["query_id"], r["item_id"]) for r in found.collect()} == set(zip(rows.tolist(), cols.tolist()))
    index = retrieval.build_index(frame(spark, items), 3)
    probes = retrieval.nearest_cells(retrieval.named_vectors(frame(spark, queries, "query_id"), "query_id", "query_id"), index.centres, 3)
    q, i = retrieval.search_layout(probes.drop("distance"), index.items)
    assert q.count() == 600 and i.count() == 200


def test_many_parts_of_a_cell_hold_all_pairs(spark):
    draw = np.random.default_rng(3)
    sides = [frame(spark, draw.normal(size=(n, 4)), name) for n, name in ((30, "query_id"), (50, "item_id"))]
    q, i = retrieval.search_layout(*[df.withColumn("cell", F.lit(0).cast("long")) for df in sides], 7, 9)
    part = ["cell", "q_part", "i_part"]
    pairs = q.select(*part, "query_id").join(i.select(*part, "item_id"), part)
    assert pairs.count() == 1500 == pairs.select("query_id", "item_id").distinct().count()


def test_open_cells_are_counted_before_they_are_written(spark, written):
    """Vectors all around: nearly every cell stays open, so the rows of open cells are never written."""
    draw = np.random.default_rng(5)
    items, queries = frame(spark, draw.normal(size=(300, 8))), frame(spark, draw.normal(size=(40, 8)), "query_id")
    index = retrieval.build_index(items, 10)
    ready = queries.withColumn("threshold", F.lit(1.5))
    sizes = index.items.groupBy("cell").agg(F.count("*").alias("n"))
    rows = retrieval._promising_cells(ready, index, 2).join(sizes, "cell").agg(F.count("*"), F.sum("n")).first()
    counted = retrieval.open_cells(ready, index, 2).first()
    assert (counted["cells"], counted["pairs"]) == (rows[0], rows[1]) and rows[0] > 0
    exact = sorted(map(tuple, retrieval.top_k(queries, items, 5).collect()))
    assert sorted(map(tuple, retrieval.pruned_top_k(queries, index, 5, 2, most_open=0.0).collect())) == exact
    assert "probes" not in [name for name, _ in written]
    assert sorted(map(tuple, retrieval.pruned_top_k(queries, index, 5, 2, most_open=1.0).collect())) == exact
    assert "probes" in [name for name, _ in written]


def test_codes_of_a_slice_are_its_own(spark):
    """The best by code of given codewords, against all coded scores; several parts of items."""
    draw = np.random.default_rng(6)
    items, queries, book = draw.normal(size=(90, 4)), draw.normal(size=(20, 4)), [[-1.0, -1.0], [-1.0, 1.0], [1.0, -1.0], [1.0, 1.0]]
    index = compressed.compress_at(frame(spark, items), [[0.0] * 4], [book] * 2)
    scores = np.round(queries @ np.where(items < 0, -1.0, 1.0).T, retrieval.SCORE_DIGITS)
    rows, cols = retrieval.best_columns(scores, 12)
    found = compressed.candidates(frame(spark, queries, "query_id"), index, 12, 1, query_block=3, item_block=11)
    assert {(r["query_id"], r["item_id"]) for r in found.collect()} == set(zip(rows.tolist(), cols.tolist()))


def test_centres_are_learned_from_a_bounded_share(spark, monkeypatch):
    """k-means over the items grew with their number times the cells'; every item is still indexed, and found."""
    monkeypatch.setattr(retrieval, "ITEM_BLOCK", 100)
    monkeypatch.setattr(retrieval, "LEARNERS", 20)
    draw, seen, fit = np.random.default_rng(7), [], retrieval.fit_cells
    monkeypatch.setattr(retrieval, "fit_cells", lambda items, cells, seed=0: seen.append(items.count()) or fit(items, cells, seed))
    items, queries = frame(spark, draw.normal(size=(1000, 3))), frame(spark, draw.normal(size=(10, 3)), "query_id")
    index = retrieval.build_index(items, 8)
    assert 110 <= seen[0] <= 210 and index.items.count() == 1000
    exact = sorted(map(tuple, retrieval.top_k(queries, items, 4).collect()))
    assert sorted(map(tuple, retrieval.pruned_top_k(queries, index, 4, 1).collect())) == exact


def test_open_pairs_of_blocks_are_scored_together(monkeypatch):
    """Small blocks once scored their few open pairs each by itself, which took most of the time; the best are the same."""
    draw, calls, scored = np.random.default_rng(5), [], retrieval._pair_scores
    left, right = draw.normal(size=(64, 16)), draw.normal(size=(6000, 16))
    right[3000:3100] = right[:100]  # ties over blocks
    monkeypatch.setattr(retrieval, "_pair_scores", lambda *a: (calls.append(1), scored(*a))[1])
    rows, cols, scores = retrieval.best_pairs(left, len(right), lambda a, b: right[a:b], 5, 64, 32)
    every = np.round(left @ right.T, retrieval.SCORE_DIGITS)
    best = np.lexsort((np.broadcast_to(np.arange(6000), every.shape), -every))[:, :5]
    assert cols.tolist() == best.ravel().tolist() and rows.tolist() == np.repeat(np.arange(64), 5).tolist()
    assert scores.tolist() == np.take_along_axis(every, best, 1).ravel().tolist()
    assert 0 < len(calls) < 6000 // 32 / 4


def test_who_asks_all_cells_asks_one(spark):
    """Each cell once searched its queries by itself: four lists a query, four copies of it, and four scores to beat from none."""
    draw = np.random.default_rng(8)
    items, queries = draw.normal(size=(120, 4)), draw.normal(size=(30, 4))
    index = compressed.compress(frame(spark, items), 4, parts=2, words=8)
    groups, layout = [], compressed.search_layout
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(compressed, "search_layout", lambda *a, **k: groups.append(layout(*a, **k)) or groups[-1])
        found = compressed.candidates(frame(spark, queries, "query_id"), index, 9, 4).collect()
    q, i = groups[0]
    assert q.count() == 30 and i.count() == 120
    held = {r["item_id"]: np.array(index.centres[r["cell"]]) + np.concatenate([b[c] for b, c in zip(index.books, r["codes"])]) for r in index.codes.collect()}
    coded = np.round(queries @ np.array([held[n] for n in range(120)]).T, retrieval.SCORE_DIGITS)
    rows, cols = retrieval.best_columns(coded, 9)
    assert {(r["query_id"], r["item_id"]) for r in found} == set(zip(rows.tolist(), cols.tolist()))


@pytest.mark.parametrize("text", [False, True])
@pytest.mark.parametrize("most", [100, 0])
def test_pairs_meet_their_vectors_in_parts(spark, monkeypatch, most, text):
    """Every pair once carried two vectors through two joins; ids that come twice still give all their rows, either way."""
    monkeypatch.setattr(compressed, "RERANK_PART", 7)
    monkeypatch.setattr(compressed, "ITEM_PART", 9)
    draw = np.random.default_rng(9)
    q, i = np.vstack([draw.normal(size=(20, 3)), np.zeros((1, 3))]), draw.normal(size=(31, 3))
    name = (lambda n: f"n{n}") if text else (lambda n: n)
    kind = "string" if text else "long"
    made = lambda rows, ids, c: spark.createDataFrame(
        [(name(n), list(map(float, v))) for n, v in zip(ids, rows)], f"{c} {kind}, embedding array<double>").repartition(3)
    q_ids, i_ids = [*range(20), 3], [*range(30), 5]
    asked = [(a, b) for a in range(20) for b in range(30) if (a + b) % 3] + [(1, 2)]
    pairs = spark.createDataFrame([(name(a), name(b)) for a, b in asked], f"query_id {kind}, item_id {kind}")
    found = compressed.rescored(pairs, made(q, q_ids, "query_id"), made(i, i_ids, "item_id"), most)
    wanted = sorted((name(a), name(b), round(float(q[x] @ i[y]), 6)) for a, b in asked for x, m in enumerate(q_ids) if m == a for y, n in enumerate(i_ids) if n == b)
    rows = sorted((r["query_id"], r["item_id"], r["score"]) for r in found.collect())
    assert [r[:2] for r in rows] == [w[:2] for w in wanted] and np.allclose([r[2] for r in rows], [w[2] for w in wanted], atol=2e-6)
    plan = found._jdf.queryExecution().toString()
    assert ("FlatMapCoGroupsInArrow" in plan) == bool(most)

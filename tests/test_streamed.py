"""Items in files that tasks read a stretch at a time: searches copy no side, and every pair can be scored."""

import time

import numpy as np
import pytest

from revrec.operators import joins, retrieval, towers
from revrec.plans import catalogue
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


@pytest.mark.parametrize("few", [False, True])
def test_no_side_is_copied_for_the_parts_of_the_other(spark, monkeypatch, written, few):
    """Items were shuffled once per part of the queries, queries once per part of the items, k rows of each pair of parts."""
    for name, rows in (("QUERY_PART", 16), ("ITEM_PART", 40), ("_SMALL_PART", 16)):
        monkeypatch.setattr(retrieval, name, rows)
    draw = np.random.default_rng(11)
    items, queries = draw.normal(size=(300, 5)).round(1), draw.normal(size=(7 if few else 200, 5)).round(1)
    items[200:] = items[:100]  # ties over files
    found = retrieval.top_k(frame(spark, queries, "query_id"), frame(spark, items), 6)
    layout = next(df for name, df in written if name == "layout").first()
    assert (layout["q_parts"], layout["i_parts"]) == ((1, 8) if few else (16, 1))
    files = [df for name, df in written if name == "items"]
    assert len(files) == 1 and files[0].count() == 300
    plan = found._jdf.queryExecution().toString()
    assert "CoGroup" not in plan and plan.split("== Optimized")[0].count("MapInArrow") <= 2
    every = np.round(queries @ items.T, retrieval.SCORE_DIGITS)
    best = np.lexsort((np.broadcast_to(np.arange(300), every.shape), -every))[:, :6]
    wanted = {(q, int(i), r + 1) for q, row in enumerate(best) for r, i in enumerate(row)}
    assert {(r["query_id"], r["item_id"], r["rank"]) for r in found.collect()} == wanted


def test_every_pair_is_scored(spark):
    """Only the three best partners of each vector were."""
    found = catalogue.QUERIES["score_pairs"](spark, "/root/testdata/sf0.001")
    held = {r["vec_id"]: np.array(r["embedding"], np.float64) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()}
    rows = {(r["query_id"], r["item_id"]): r["score"] for r in found.collect()}
    assert set(rows) == {(a, b) for a in held for b in held} and found.count() == len(rows)
    assert all(abs(s - held[a] @ held[b]) < 1e-6 for (a, b), s in list(rows.items())[::97])


def test_pairs_of_odd_vectors_have_no_score(spark, monkeypatch):
    """All pairs over several files and blocks are those of the given pairs, and pairs of odd vectors stay."""
    for name, rows in (("ITEM_PART", 6), ("_SMALL_PART", 4), ("_COLUMNS", 5), ("_ROWS", 3)):
        monkeypatch.setattr(retrieval, name, rows)
    draw = np.random.default_rng(12)
    odd = [(90, None), (91, [1.0, None]), (92, [1.0, 2.0, 3.0]), (93, []), (94, [float("inf"), 1.0]), (3, [5.0, 5.0])]
    rows = [(i, list(map(float, draw.normal(size=2)))) for i in range(15)] + odd
    queries, items = (spark.createDataFrame(rows, KIND.replace("item_id", c)).repartition(2) for c in ("query_id", "item_id"))
    plain = lambda df: sorted((r["query_id"], r["item_id"], None if r["score"] is None else str(round(r["score"], 9))) for r in df.collect())
    pairs = queries.select("query_id").distinct().crossJoin(items.select("item_id").distinct())
    found = plain(joins.score_pairs(None, queries, items))
    key = lambda t: (t[0], t[1], t[2] or "")
    assert len(found) == 21 * 21
    assert sorted(found, key=key) == sorted(plain(joins.score_pairs(pairs, queries, items)), key=key)
    none = spark.createDataFrame([], KIND)
    assert joins.score_pairs(None, queries, none).count() == 0


def test_a_written_table_leaves_no_shuffle_files(spark):
    """They stayed until the driver's memory filled, so that a job's disk was the sum of its steps'."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = manager.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before = shuffled()
    table = shared.materialise(spark.range(1000).repartition(5, "id").groupBy("id").count(), "table")
    for _ in range(20):
        left = shuffled() - before
        if not left:
            break
        time.sleep(0.2)
    assert not left and table.count() == 1000


def test_rounds_in_turns_arrive_at_the_same(spark, monkeypatch, written):
    """All rounds' vectors were sent at once, written as they came back, and shuffled once more to be merged."""
    draw = np.random.default_rng(13)
    rows = [(i, int(draw.integers(0, 40)), int(draw.integers(0, 25)), float(i % 7 > 0)) for i in range(900)]
    reviews = spark.createDataFrame(rows, "review_id long, customer_id_xf long, product_id_xf long, retrieval_sample_weight double")

    def trained():
        written.clear()
        found = towers.fit_towers(reviews, "review_id", 4, 2, 0.05, 32, 16, batches_per_round=4)
        state = {(r["kind"], r["index"]): (r["step"], np.array([r["vector"], r["mean"], r["square"]])) for r in found.state.collect()}
        return state, [tuple(r) for r in found.losses.orderBy("epoch").collect()], [name for name, _ in written]

    whole, losses, names = trained()
    assert names.count("towers") == 1 + 2 and "updates" not in names
    monkeypatch.setattr(towers, "TURN_ROWS", 3 * 32 * 4)
    turned, again, names = trained()
    assert names.count("towers") == 1 + 2 * 3  # eight rounds, three at a time
    assert whole.keys() == turned.keys() and {k for k, _ in whole} == {0, 1}
    assert all(s == turned[i][0] and np.abs(v - turned[i][1]).max() < 1e-12 for i, (s, v) in whole.items())
    assert [x[::2] for x in losses] == [x[::2] for x in again] and np.allclose([x[1] for x in losses], [x[1] for x in again], atol=1e-9)


def test_open_cells_weigh_against_what_a_whole_search_sends(spark, monkeypatch, written):
    """The rows that open cells might send grew with the parts of both sides, that is with the square; the answer is the same."""
    monkeypatch.setattr(retrieval, "QUERY_PART", 4)
    monkeypatch.setattr(retrieval, "ITEM_PART", 20)
    draw = np.random.default_rng(14)
    items, queries = frame(spark, draw.normal(size=(100, 8))), frame(spark, draw.normal(size=(120, 8)), "query_id")
    index = retrieval.build_index(items, 40)
    exact = sorted(map(tuple, retrieval.top_k(queries, items, 5).collect()))
    written.clear()
    found = retrieval.pruned_top_k(queries, index, 5, 2, most_open=1.0)
    assert sorted(map(tuple, found.collect())) == exact
    # Nearly all of 120 queries' 38 cells stay open: more than eight rows for each of 220 vectors, fewer than for their copies.
    assert "probes" not in [name for name, _ in written]

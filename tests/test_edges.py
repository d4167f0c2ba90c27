"""Hand-written rows for the semantics that are easy to get wrong."""

import hashlib
import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from revrec.functions import columns as C
from revrec.functions.vectors import concat_vectors, dot, l2_normalise
from revrec.operators import histograms, joins, keyed, metrics, negatives, ordering, retrieval, statistics, vocabulary
from revrec.plans import curate, ratings, recommend

DAY = datetime(2025, 3, 1)
REVISION = (
    "uuid string, customer_id long, tsin_id long, rating int, body string, updated_at timestamp, moderation_state_id int"
)


def values(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_older_accepted_revision_survives_a_rejected_one(spark):
    rows = [
        ("a", 1, 1, 5, "old", DAY, 0),
        ("a", 1, 1, 1, "new", DAY + timedelta(days=1), 2),
        ("b", 1, 1, 3, "only rejected", DAY, 1),
    ]
    latest = curate.latest_reviews(spark.createDataFrame(rows, REVISION))
    assert values(latest, "review_id", "review_text") == [("a", "old")]


def test_equal_timestamps_give_one_whole_row(spark):
    rows = [("a", 1, 7, 5, "x", DAY, 0), ("a", 1, 9, 2, "y", DAY, 0)]
    latest = curate.latest_reviews(spark.createDataFrame(rows, REVISION), tiebreak=["tsin_id"])
    assert values(latest, "tsin", "review_rating", "review_text") == [(9, 2, "y")]


def test_newest_null_value_is_kept(spark):
    rows = [("a", 1, 1, 5, "text", DAY, 0), ("a", 1, 1, 5, None, DAY + timedelta(days=1), 0)]
    latest = curate.latest_reviews(spark.createDataFrame(rows, REVISION))
    assert values(latest, "review_text") == [(None,)]


def test_date_range_is_inclusive(spark):
    stamps = [datetime(2024, 12, 31, 23, 59), datetime(2025, 1, 1), datetime(2025, 6, 30, 23, 59), datetime(2025, 7, 1)]
    df = spark.createDataFrame([(s,) for s in stamps], "t timestamp")
    assert df.filter(C.date_between("t", "2025-01-01", "2025-06-30")).count() == 2


def document(line, variants, names, day, brand="b"):
    return (
        {"id": line, "title": f"t{line}", "attributes": {"brand": brand}, "variants": variants},
        {"hierarchy": {"merchandising": {"forest": {"names": names}}}},
        DAY + timedelta(days=day),
    )


def test_products_from_nested_documents(spark):
    from revrec.schemas import PRODUCT_DOCS

    docs = [
        document(1, [{"id": 10}, {"id": 11}], ["Toys", "x"], 0),
        document(2, [{"id": 10}], ["Health"], 1),
        document(3, [], ["Toys"], 1),
        document(4, None, ["Toys"], 1),
        document(5, [{"id": 12}], [], 1),
        document(6, [{"id": 13}], ["Toys"], 0),
        document(7, [{"id": 13}], ["Unlisted"], 1),
        document(8, [{"id": 14}], ["Toys"], 1, brand=None),
    ]
    products = curate.latest_products(spark.createDataFrame(docs, PRODUCT_DOCS))
    assert values(products, "tsin", "product_id", "product_department", "product_brand") == [
        (10, "PLID2", "Health", "b"),
        (11, "PLID1", "Toys", "b"),
        (14, "PLID8", "Toys", None),
    ]


def reviews_of(spark, sizes):
    rows = [
        (f"{customer}-{i:03d}", customer, DAY + timedelta(hours=i // 2))
        for customer, n in sizes.items()
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "review_id string, customer_id string, review_timestamp timestamp")


def test_active_recent_and_split(spark):
    sizes = {"nine": 9, "ten": 10, "twenty": 20, "more": 21}
    kept = curate.split_recent(reviews_of(spark, sizes))
    assert values(kept.groupBy("customer_id").count(), "customer_id", "count") == [
        ("more", 20), ("ten", 10), ("twenty", 20),
    ]
    # The label comes from the place in the whole history: of 21, the first is gone.
    labels = {r["review_id"]: r["split"] for r in kept.collect()}
    assert "more-000" not in labels
    assert [labels[f"more-{i:03d}"] for i in (6, 7, 8, 9, 17, 18, 19)] == [
        "train", "validation", "test", "train", "validation", "test", "train",
    ]
    per_split = values(kept.filter("customer_id = 'more'").groupBy("split").count(), "split", "count")
    assert per_split == [("test", 2), ("train", 16), ("validation", 2)]


def test_label_splits_equals_split_recent(spark):
    reviews = reviews_of(spark, {"a": 300, "b": 13, "c": 11})
    recent = curate.split_recent(reviews)
    full = curate.label_splits(reviews)
    assert full.count() == 324
    assert recent.exceptAll(full.select(recent.columns)).count() == 0


def test_customers_without_key_are_dropped_and_digest_is_stable(spark):
    df = spark.createDataFrame([(1, "x"), (None, "y"), (1, "z")], "key long, v string")
    out = joins.attach_pseudonym(df, "key", "s")
    mapping = joins.pseudonyms(df, "key", "s")
    assert out.count() == 2 and mapping.count() == 1
    assert {r["customer_id"] for r in out.collect()} == {r["customer_id"] for r in mapping.collect()}
    assert joins.pseudonyms(df, "key", "other").first()["customer_id"] != mapping.first()["customer_id"]


def test_group_sizes_keep_the_null_group(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",), (None,)], "brand string")
    assert [tuple(r) for r in keyed.group_sizes(df, "brand").collect()] == [(None, 2), ("a", 1), ("b", 1)]


def test_dimension_takes_latest_non_null_per_column(spark):
    rows = [("p", "t1", None, 1), ("p", None, "b2", 2), ("p", "t3", None, 3), (None, "t", "b", 9)]
    df = spark.createDataFrame(rows, "k string, title string, brand string, at int")
    assert values(keyed.extract_dimension(df, "k", ["title", "brand"], "at"), "k", "title", "brand") == [("p", "t3", "b2")]


def test_weights(spark):
    df = spark.createDataFrame([(3,), (4,), (5,), (None,)], "r int")
    got = [r[0] for r in df.select(C.retrieval_weight(F.col("r"))).collect()]
    assert got == [0.0, 1.0, 1.0, None]


def test_expected_rating(spark):
    row = spark.range(1).select(
        C.expected_rating(F.lit(5.0), F.lit(1)).alias("one"), C.expected_rating(F.lit(4.9), F.lit(50)).alias("many"),
        C.expected_rating(F.lit(0.0), F.lit(0)).alias("none"),
    ).first()
    assert row["one"] == pytest.approx(10 / 3)
    assert row["many"] == pytest.approx((4.9 * 50 + 5) / 52)
    assert row["none"] == 2.5


def test_nan_ratings_do_not_count(spark):
    df = spark.createDataFrame([("p", 4.0), ("p", float("nan")), ("p", None)], "product_id string, review_rating double")
    row = ratings.rating_summary(df).first()
    assert (row["review_rating_mean"], row["review_rating_count"]) == (4.0, 1)


def test_top_rated_orders_and_nulls_last(spark):
    rows = [("a", 4.0, 1), ("b", 4.0, 9), ("c", 5.0, 1), ("d", None, 0)]
    df = spark.createDataFrame(rows, f"product_id string, {ratings.MEAN} double, {ratings.COUNT} long")
    assert [r["product_id"] for r in ratings.top_rated(df).collect()] == ["c", "a", "b", "d"]
    assert [r["product_id"] for r in ratings.top_rated(df, 3, "mean_count").collect()] == ["c", "b", "a"]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0.5, 1.5, 1.49, 5.5, 5.51, 0.49, 3.0, None, float("nan"))], "v double")
    got = {r["bin"]: r["count"] for r in histograms.histogram(df, "v", 0.5, 5.5, 5).collect()}
    assert got == {1: 2, 2: 1, 3: 1, 4: 0, 5: 1}


def test_auto_histogram_of_a_constant_has_one_bin(spark):
    df = spark.createDataFrame([(7,), (7,), (None,)], "v int")
    rows = histograms.histogram_auto(df, "v").collect()
    assert [(r["bin"], r["low"], r["count"]) for r in rows] == [(1, 7.0, 2)]
    assert histograms.histogram_auto(df.filter("v is null"), "v").count() == 0


def test_vocabulary_order_and_lookup(spark):
    tokens = ["a", "b", "b", "c", "c", "", None]
    df = spark.createDataFrame([(t,) for t in tokens], "t string")
    vocab = vocabulary.build_vocabulary(df, "t")
    assert values(vocab, "index", "token", "count") == [(0, "c", 2), (1, "b", 2), (2, "a", 1)]
    other = vocabulary.build_vocabulary(df, "t", ties_descending=False)
    assert values(other, "index", "token") == [(0, "b"), (1, "c"), (2, "a")]
    looked = vocabulary.apply_vocabulary(spark.createDataFrame([("a",), ("z",), (None,)], "t string"), vocab, "t")
    assert values(looked, "t", "t_xf") == [("a", 2), ("z", -1), (None, -1)]
    assert vocabulary.vocabulary_size(vocab, 2).first()[0] == 5
    with pytest.raises(ValueError):
        vocabulary.vocabulary_size(vocab, -1)


def test_transform_returns_only_what_the_function_gives(spark):
    rows = [("train", "x", "p", 5), ("validation", "y", "p", 3), ("test", "z", "q", 4)]
    df = spark.createDataFrame(rows, "split string, customer_id string, product_id string, review_rating int")
    out = vocabulary.transform(df, analyse=["train"], splits=["train", "test"])
    assert out.columns == ["customer_id_xf", "product_id_xf", "retrieval_sample_weight"]
    assert values(out, *out.columns) == [(-1, -1, 1.0), (0, 0, 1.0)]
    own = vocabulary.transform(df, lambda rows, analysed: rows.select("product_id"), analyse=["train"], splits=["test"])
    assert values(own, "product_id") == [("q",)]


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), (None,)], "v array<float>")
    assert [r[0] for r in df.select(l2_normalise(F.col("v"))).collect()] == [[0.6, 0.8], [0.0, 0.0], None]
    row = df.select(dot(F.col("v"), F.col("v")).alias("d"), concat_vectors(F.col("v"), F.col("v")).alias("c")).first()
    assert row["d"] == 25.0 and row["c"] == [3.0, 4.0, 3.0, 4.0]


def test_hit_at_k_and_accuracy(spark):
    rows = [("a", ["a", "b"], 1.0), ("b", ["a", "b"], 3.0), ("c", None, 1.0)]
    df = spark.createDataFrame(rows, "label string, preds array<string>, w double")
    label, preds = F.col("label"), F.col("preds")
    assert [r[0] for r in df.select(metrics.hit_at_k(label, preds, 1)).collect()] == [True, False, False]
    row = df.agg(
        metrics.top_k_accuracy(label, preds, 2).alias("plain"), metrics.top_k_accuracy(label, preds, 2, F.col("w")).alias("weighted")
    ).first()
    assert row["plain"] == pytest.approx(2 / 3) and row["weighted"] == pytest.approx(0.8)
    assert df.filter("w > 9").agg(metrics.top_k_accuracy(label, preds)).first()[0] is None


def gate_of(spark, value, baseline, count=1.0):
    def table(v, n):
        return spark.createDataFrame(
            [("overall", "example_count", n), ("overall", "top_k_accuracy", v)], "slice string, metric string, value double"
        )

    base = None if baseline is None else table(baseline, 1.0)
    return metrics.gate(table(value, count), base).first()["ok"]


@pytest.mark.parametrize(
    "value, baseline, count, ok",
    [(0.2, None, 1.0, True), (0.2, 0.1, 1.0, True), (0.1, 0.1, 1.0, False), (0.05, 0.1, 1.0, False),
     (0.2, 0.0, 1.0, False), (0.2, None, 0.0, False), (0.2, 0.1, 0.0, False)],
)
def test_gate(spark, value, baseline, count, ok):
    assert gate_of(spark, value, baseline, count) is ok


def test_side_by_side_keeps_left_rows_and_rank(spark):
    left = spark.createDataFrame([("c", 1), ("c", 2), ("c", 3), ("d", 1)], "customer_id string, at int")
    right = spark.createDataFrame([("c", "p", 2), ("c", "q", 1)], "customer_id string, item string, rank int")
    out = joins.side_by_side(left, right, "customer_id", [F.col("at").desc()], ["rank"])
    assert values(out, "customer_id", "position", "at", "item") == [
        ("c", 1, 3, "q"), ("c", 2, 2, "p"), ("c", 3, 1, None), ("d", 1, 1, None),
    ]


def test_loss_weights_must_be_positive():
    with pytest.raises(ValueError):
        negatives.combine_losses(F.lit(0.0), F.lit(1.0), 0.0, 1.0)


def test_statistics_of_missing_and_empty(spark):
    df = spark.createDataFrame([("x", 0.0), (None, None), ("", 4.0)], "s string, n double")
    got = {(r["feature"], r["stat"]): r["value"] for r in statistics.feature_statistics(df).collect()}
    assert got["n", "num_missing"] == 1 and got["n", "num_zeros"] == 1 and got["n", "mean"] == 2 and got["n", "std_dev"] == 2
    assert got["s", "unique"] == 2 and got["s", "avg_length"] == 0.5 and got["s", "num_missing"] == 1


def test_long_values_stay_themselves(spark):
    long = {c: c * 70 + "x" * 5000 for c in "abc"}
    values = [long["a"]] * 3 + [long["b"]] * 2 + [long["c"], None, "short"]
    df = spark.createDataFrame([(t, i % 2) for i, t in enumerate(values)], "s string, g int")
    top = statistics.top_values(df.select("s"), n=3).orderBy("rank").collect()
    last = min((long["c"], "short"), key=lambda v: hashlib.sha256(v.encode()).hexdigest())
    assert [(r["value"], r["count"]) for r in top] == [(long["a"], 3), (long["b"], 2), (last, 1)]
    by = {(r["g"], r["rank"]): (r["value"], r["count"]) for r in statistics.top_values(df, ["g"], ["s"], 1).collect()}
    assert by == {(0, 1): (long["a"], 2), (1, 1): by[1, 1]} and by[1, 1][1] == 1
    schema = {r["feature"]: r["domain"] for r in statistics.infer_schema(df, domain_limit=4).collect()}
    assert schema["s"] == sorted([*long.values(), "short"])
    assert {r["feature"]: r["domain"] for r in statistics.infer_schema(df, domain_limit=3).collect()}["s"] is None


def test_exact_quantiles_with_a_hot_group(spark):
    rows = [("hot" if i % 3 else f"g{i % 5}", float(i * 37 % 101), None if i % 4 else 1.0) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, n double, m double")
    fractions = [0.0, 0.25, 0.5, 1.0]
    got = {(r["k"], r["feature"]): r["cuts"] for r in statistics.exact_quantiles(df, ["k"], ["n", "m"], fractions).collect()}
    for k in {r[0] for r in rows}:
        for i, name in ((1, "n"), (2, "m")):
            own = sorted(r[i] for r in rows if r[0] == k and r[i] is not None)
            if own:
                assert got[k, name] == [own[max(1, math.ceil(f * len(own))) - 1] for f in fractions]


def test_profile_has_everything(spark):
    df = spark.createDataFrame([(1, "a", [1]), (3, "a", None), (None, None, [2])], "n int, s string, other array<int>")
    profile = statistics.profile(df, bins=2, exact=True)
    stats = {(r["feature"], r["stat"]): r["value"] for r in profile.statistics.collect()}
    assert stats["other", "num_missing"] == 1 and stats["n", "median"] == 1 and stats["s", "unique"] == 1
    assert [(r["kind"], r["bin"], r["count"]) for r in profile.histograms.orderBy("kind", "bin").collect()] == [
        ("quantile", 1, 1.0), ("quantile", 2, 1.0), ("standard", 1, 1.0), ("standard", 2, 1.0)]
    assert [(r["value"], r["count"]) for r in profile.top_values.collect()] == [("a", 2)]


def test_empty_bins_are_there(spark):
    df = spark.createDataFrame([(1.0, 9.0), (1.2, float("nan"))], "a double, b double")
    got = {(r["feature"], r["bin"]): r["count"] for r in histograms.bin_counts(df, ["a", "b"], 0, 4, 4).collect()}
    assert got == {("a", 1): 0, ("a", 2): 2, ("a", 3): 0, ("a", 4): 0, **{("b", b): 0 for b in range(1, 5)}}


def test_slices_keep_null_apart(spark):
    rows = [(None, "y", 1.0), ("NULL", "y", 0.0), (None, None, 1.0), ("x", None, 0.0)]
    df = spark.createDataFrame(rows, "brand string, dept string, v double")
    table = metrics.metrics_table(df, {"mean": F.avg("v")}, ["brand", "dept"])
    assert {r["slice"] for r in table.collect()} == {
        "brand IS NULL|dept=y", "brand=NULL|dept=y", "brand IS NULL|dept IS NULL", "brand=x|dept IS NULL"}
    assert metrics.compare_metrics(table, table).filter("change = 0 OR value = 0").count() == 4
    one = metrics.metrics_table(df, {"mean": F.avg("v")}, ["dept"])
    assert {r["slice"]: r["value"] for r in one.collect()} == {"dept=y": 0.5, "dept IS NULL": 0.5}


@pytest.mark.parametrize("indexed", [False, True])
def test_bad_vectors_take_no_part(spark, indexed):
    good = [(i, [math.cos(i), math.sin(i)]) for i in range(8)]
    bad = [(20, None), (21, [float("nan"), 1.0]), (22, [float("inf"), 0.0]), (23, []), (24, [None, 1.0]), (25, [1.0]), (None, [1.0, 0.0])]
    items = spark.createDataFrame(good + bad, "item_id long, embedding array<double>")
    queries = items.withColumnRenamed("item_id", "query_id")
    if indexed:
        found = retrieval.pruned_top_k(queries, retrieval.build_index(items), 3)
        assert retrieval.approx_top_k(queries, retrieval.build_index(items), 3, 1).filter("item_id > 7").count() == 0
    else:
        found = retrieval.top_k(queries, items, 3)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["item_id"])
    assert got == {q: sorted(range(8), key=lambda i: (-round(math.cos(q - i), 6), i))[:3] for q in range(8)}
    empty, one = items.limit(0), items.filter("item_id = 5")
    assert retrieval.pruned_top_k(queries, retrieval.build_index(one), 3).count() == 8
    assert retrieval.approx_top_k(queries, retrieval.build_index(one), 3).count() == 8
    assert retrieval.pruned_top_k(queries, retrieval.build_index(items, 4), 3).exceptAll(found).count() == 0
    assert retrieval.top_k(queries, empty, 3).count() == 0
    assert retrieval.pruned_top_k(queries, retrieval.build_index(empty), 3).count() == 0


def test_scores_that_are_not_numbers_are_never_best():
    scores = np.array([[np.nan, 1.0, 2.0, 3.0, -np.inf], [np.nan] * 5])
    rows, cols = retrieval.best_columns(scores, 3)
    assert (rows.tolist(), cols.tolist()) == ([0, 0, 0], [3, 2, 1])


def test_schema_domains(spark):
    rows = [(i, f"v{i % 3}", f"u{i}", None if i == 0 else "k", DAY) for i in range(10)]
    df = spark.createDataFrame(rows, "n long, few string, many string, opt string, at timestamp")
    got = {r["feature"]: r for r in statistics.infer_schema(df, domain_limit=5).collect()}
    assert got["few"]["domain"] == ["v0", "v1", "v2"] and got["many"]["domain"] is None
    assert got["opt"]["presence"] == "optional" and got["n"]["presence"] == "required"
    assert got["at"]["type"] == "timestamp" and got["n"]["domain"] is None


def test_sample_and_shuffle_are_repeatable(spark):
    df = spark.range(100).repartition(7)
    first = [r[0] for r in ordering.sample_n(df, "id", 5, 3).collect()]
    assert first == [r[0] for r in ordering.sample_n(spark.range(100), "id", 5, 3).collect()]
    assert first != [r[0] for r in ordering.sample_n(df, "id", 5, 4).collect()]
    assert sorted(r[0] for r in ordering.shuffle_rows(df, "id").collect()) == list(range(100))


def test_recommend_evaluate_report(spark):
    customers = spark.createDataFrame([("c", [1.0, 0.0]), ("d", [0.0, 1.0])], "customer_id string, embedding array<float>")
    index = spark.createDataFrame([("p", [1.0, 0.0]), ("q", [0.0, 1.0]), ("r", [0.6, 0.8])], "product_id string, embedding array<float>")
    ranked = recommend.recommend(customers, index, 2)
    assert values(ranked, "customer_id", "item_id", "rank") == [("c", "p", 1), ("c", "r", 2), ("d", "q", 1), ("d", "r", 2)]
    examples = spark.createDataFrame([("c", "r"), ("d", "p"), ("unknown", "p")], "customer_id string, product_id string")
    got = {r["metric"]: r["value"] for r in recommend.evaluate(examples, ranked).collect()}
    assert got["example_count"] == 3 and got["top_k_accuracy"] == pytest.approx(1 / 3)
    own = recommend.evaluate(examples, ranked, {"customers": F.count_distinct("customer_id")})
    assert own.first()["value"] == 3

"""Files: CSV with awkward text, splits, releases, publishing, manifests."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from revrec import schemas
from revrec.plans import curate
from revrec.operators import towers
from revrec.sources import artifacts, shared, tables

TEXTS = ['say "hi", twice', "line\nbreak", "back\\slash", "  blanks  ", "'", '""', "ünï ✓", "a,b", "\ttab", 'end"']


def texts(spark):
    return spark.createDataFrame(list(enumerate([*TEXTS, None])), "id int, text string")


def test_csv_keeps_texts(spark, folder):
    tables.write_csv(texts(spark), f"{folder}/t")
    back = tables.read_csv(spark, f"{folder}/t", texts(spark).schema)
    assert {r["id"]: r["text"] for r in back.collect()} == dict(enumerate([*TEXTS, None]))


def test_csv_types_are_inferred_without_schema(spark, folder):
    tables.write_csv(spark.createDataFrame([(1, 2.5, "x")], "a int, b double, c string"), f"{folder}/t")
    assert dict(tables.read_csv(spark, f"{folder}/t").dtypes) == {"a": "int", "b": "double", "c": "string"}


def test_splits_round_trip_by_folder_and_by_pattern(spark, folder):
    df = texts(spark).withColumn("split", F.when(F.col("id") % 2 == 0, "train").otherwise("test"))
    tables.write_splits(df, f"{folder}/s")
    back = tables.read_splits(spark, f"{folder}/s", ["train", "test"], texts(spark).schema)
    assert back.exceptAll(df).count() == 0 and back.count() == df.count()
    only = tables.read_splits(spark, f"{folder}/s", ["test"], texts(spark).schema)
    assert {r["split"] for r in only.collect()} == {"test"}
    tables.write_csv(texts(spark), f"{folder}/p/train.csv")
    named = tables.read_splits(spark, f"{folder}/p", ["train"], texts(spark).schema, "{split}.csv")
    assert named.count() == len(TEXTS) + 1


def test_hash_split(spark):
    df = spark.range(2000)
    parts = tables.hash_split(df, {"a": 3, "b": 1}, ["id"])
    sizes = {r["split"]: r["count"] for r in parts.groupBy("split").count().collect()}
    assert sum(sizes.values()) == 2000 and 1350 < sizes["a"] < 1650
    again = tables.hash_split(df.repartition(9), {"a": 3, "b": 1}, ["id"])
    assert parts.exceptAll(again).count() == 0
    assert tables.hash_split(df, {"single": 1}, ["id"]).select("split").distinct().collect()[0][0] == "single"
    with pytest.raises(ValueError):
        tables.hash_split(df, {"a": 0}, ["id"])


def curated(spark):
    rows = [
        (f"r{i}", i % 5 + 1, TEXTS[i % len(TEXTS)], datetime(2025, 1, 1 + i), "c", f"p{i % 4}", "t", None, "d",
         {8: "validation", 9: "test"}.get((i + 1) % 10, "train"))
        for i in range(20)
    ]
    schema = schemas.T.StructType([*schemas.SPLIT_REVIEWS.fields, schemas.T.StructField("split", schemas.T.StringType())])
    return spark.createDataFrame(rows, schema)


def test_dataset_files(spark, folder):
    counts = {r["split"]: r["row_count"] for r in curate.build_dataset(curated(spark), folder).collect()}
    assert counts == {"train": 16, "validation": 2, "test": 2}
    read = lambda name, schema: tables.read_csv(spark, f"{folder}/{name}", schema)
    assert read("reviews/test.csv", schemas.SPLIT_REVIEWS).count() == 2
    assert read("customers.csv", schemas.CUSTOMERS).count() == 1
    assert read("products.csv", schemas.PRODUCTS).count() == 4
    reviews = read("reviews.csv", schemas.REVIEWS)
    assert reviews.exceptAll(curated(spark).select(schemas.REVIEW_COLUMNS)).count() == 0 and reviews.count() == 20


def test_release_has_no_test_split(spark, folder):
    curate.release_dataset(curated(spark), folder)
    assert sorted(os.listdir(f"{folder}/reviews")) == ["train.csv", "validation.csv"]
    assert tables.release(curated(spark)).filter("split = 'test'").count() == 0
    # Tables without splits cover all reviews.
    assert tables.read_csv(spark, f"{folder}/reviews.csv", schemas.REVIEWS).count() == 20


def test_written_examples(spark, folder):
    tables.write_examples(curated(spark), f"{folder}/x", ["train", "validation"])
    assert sorted(d for d in os.listdir(f"{folder}/x") if d.startswith("split")) == ["split=train", "split=validation"]


def verdict(spark, *oks):
    return spark.createDataFrame([("overall", ok) for ok in oks], "slice string, ok boolean")


def test_publish_only_after_a_positive_verdict(spark, folder):
    df = spark.range(3)
    assert artifacts.publish(df, folder, verdict(spark, True, False), 1) is None
    assert artifacts.publish(df, folder, verdict(spark), 1) is None
    path = artifacts.publish(df, folder, verdict(spark, True), 1)
    assert path.endswith("version=1") and spark.read.parquet(path).count() == 3
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        artifacts.publish(df, folder, verdict(spark, True), 1)
    assert artifacts.publish(df, folder, verdict(spark, True)).split("=")[1].isdigit()


def test_latest_artifact_of_files(spark, folder):
    for i, name in enumerate(["a/saved_model.pb", "b/saved_model.pb", "c/other.txt"]):
        path = f"{folder}/m/{name}"
        os.makedirs(os.path.dirname(path))
        with open(path, "w") as file:
            file.write("x")
        os.utime(path, (1000 + i, 1000 + i))
    files = artifacts.artifact_manifest(spark, f"{folder}/m")
    assert files.count() == 3
    newest = artifacts.require_artifact(artifacts.latest_artifact(files, glob="*/saved_model.pb"))
    assert newest.endswith("/b/saved_model.pb")
    assert artifacts.artifact_manifest(spark, f"{folder}/m", "*.pb").count() == 2
    with pytest.raises(ValueError):
        artifacts.require_artifact(artifacts.latest_artifact(files, prefix="nowhere"))


def test_latest_approved_skips_newer_rejects(spark):
    files = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3)], "path string, generation long")
    verdicts = spark.createDataFrame([("x", True), ("y", True), ("z", False)], "path string, ok boolean")
    assert artifacts.latest_approved(files, verdicts).first()["path"] == "y"


def test_glob_matches_the_whole_path(spark):
    files = spark.createDataFrame([("a/b.pb", 1), ("a/b.pbx", 2), ("zz/a/b.pb", 3)], "path string, generation long")
    assert artifacts.latest_artifact(files, glob="a/*.pb").first()["path"] == "a/b.pb"


def test_materialise_uses_the_shared_folder(spark):
    stored = shared.materialise(spark.range(5), "check")
    base = shared.shared_folder(spark).removeprefix("file:")
    assert all(base in f for f in stored.inputFiles()) and stored.count() == 5


def test_materialised_parts_are_pruned(spark):
    stored = shared.materialise(curated(spark), "parts", ["split"])
    assert stored.columns == curated(spark).columns
    assert stored.exceptAll(curated(spark)).count() == 0 and stored.count() == 20
    only = tables.select_splits(stored, ["test"])
    scan = only._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "split" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert only.count() == 2


def left_over(spark):
    return set(os.listdir(shared.shared_folder(spark).removeprefix("file:")))


def test_scope_drops_all_but_the_kept(spark):
    before = left_over(spark)
    with shared.scope(spark, keep=("result",)):
        inner = shared.materialise(spark.range(5), "inner")
        result = shared.materialise(inner.filter("id > 1"), "result")
        part = shared.materialise(curated(spark), "part", ["split"])
        shared.drop(part)
    assert result.count() == 3
    assert [name.rpartition("-")[0] for name in left_over(spark) - before] == ["result"]
    shared.drop(result)
    assert left_over(spark) == before


def test_scopes_nest_and_end_after_errors(spark):
    before = left_over(spark)
    with pytest.raises(RuntimeError), shared.scope(spark):
        with shared.scope(spark, keep=("up",)):
            shared.materialise(spark.range(1), "up")
        assert left_over(spark) != before
        raise RuntimeError
    assert left_over(spark) == before


def test_dataset_and_training_leave_only_results(spark, folder):
    before = left_over(spark)
    curate.build_dataset(curated(spark), folder).collect()
    curate.release_dataset(curated(spark), f"{folder}/released")
    assert [n.rpartition("-")[0] for n in left_over(spark) - before] == ["row-counts"]
    before = left_over(spark)
    rows = spark.range(60).selectExpr(
        "id AS review_id", "id % 7 AS customer_id_xf", "id % 5 AS product_id_xf", "1.0D AS retrieval_sample_weight")
    customers, products = towers.train_towers(rows, "review_id", rank=4, epochs=3, size=8, batches_per_round=2)
    assert customers.count() == 7 and products.count() == 5
    assert [n.rpartition("-")[0] for n in left_over(spark) - before] == ["towers"]

"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, con, name):
    difference, rows = compare(spark, con, queries()[name], oracle_sql()[name], SF_DIR)
    assert difference is None
    assert rows > 0


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    assert queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry(spark).count() == 10


def test_oracles_belong_to_queries():
    assert set(oracle_sql()) <= set(queries())


# Counts given with the fixture mapping, found without Spark.
def test_expected_counts(spark):
    counts = {r["split"]: r["row_count"] for r in queries()["split_counts"](spark, SF_DIR).collect()}
    assert counts == {"train": 684, "validation": 68, "test": 66}
    assert queries()["latest_reviews"](spark, SF_DIR).count() == 2007
    assert queries()["customers_dim"](spark, SF_DIR).count() == 63
    assert queries()["products_dim"](spark, SF_DIR).count() == 135


def test_known_retrieval_loss(spark):
    row = queries()["retrieval_loss"](spark, "/root/testdata/sf0.01").first()
    assert row["retrieval_loss"] == pytest.approx(615.155034, abs=1e-5)

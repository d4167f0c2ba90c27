"""Exact quantiles by selection: against sorted lists, under ties, hot groups and forced narrowing."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revrec.operators import selection
from revrec.sources import shared

FRACTIONS = [0.0, 0.1, 0.5, 0.9, 1.0]


def plain(rows, fractions=FRACTIONS):
    """{(group, feature): (n, cuts)} of (group, a, b) rows."""
    out = {}
    for g in {r[0] for r in rows}:
        for i, name in ((1, "a"), (2, "b")):
            own = sorted(r[i] for r in rows if r[0] == g and r[i] is not None and not math.isnan(r[i]))
            if own:
                out[g, name] = (len(own), [own[max(1, math.ceil(f * len(own))) - 1] for f in fractions])
    return out


def found(df, by=("g",), **limits):
    rows = selection.exact_quantiles(df, by, ["a", "b"], FRACTIONS, **limits).collect()
    return {(r["g"] if by else None, r["feature"]): (r["n"], r["cuts"]) for r in rows}


def table(spark, rows):
    return spark.createDataFrame(rows, "g string, a double, b double").repartition(5)


def hot(n=4000):
    draw = random.Random(1)
    group = lambda: draw.choice(["hot", "hot", "x", None])
    odd = [None, float("nan"), float("inf"), float("-inf"), -0.0, 7.0]
    return [(group(), draw.choice([7.0, draw.random() * 100]), draw.choice([*odd, draw.gauss(0, 1)])) for _ in range(n)]


@pytest.mark.parametrize("limits", [{}, {"accuracy": 20}, {"accuracy": 4, "ranked": 3}, {"accuracy": 10, "ranked": 1}])
def test_groups_ties_and_odd_values(spark, limits):
    rows = hot()
    assert found(table(spark, rows), **limits) == plain(rows)


def test_without_groups_and_empty(spark):
    rows = [(None, a, b) for _, a, b in hot(500)]
    assert found(table(spark, rows), by=(), accuracy=10) == plain(rows)
    assert found(table(spark, []), by=()) == {} and found(table(spark, [])) == {}
    assert found(table(spark, [("g", None, None)])) == {}


def test_a_sketch_that_misses_is_made_up_for(spark, monkeypatch):
    """Brackets in the wrong place: all values are looked at."""
    real = selection._brackets

    def wrong(df, by, features, fractions, accuracy):
        df = real(df, by, features, fractions, accuracy)
        return shared.materialise(df.withColumns({f"_e{j}": F.transform(f"_e{j}", lambda x: x * 0 + 1e9) for j in range(len(features))}))

    monkeypatch.setattr(selection, "_brackets", wrong)
    rows = hot(300)
    assert found(table(spark, rows), ranked=20) == plain(rows)


def test_only_brackets_cross_the_exchange(spark):
    """Of 20,000 values a median's bracket holds few; nothing else is written."""
    df = spark.range(20_000).select(F.lit("g").alias("g"), F.rand(1).alias("a"), F.rand(2).alias("b"))
    sizes = {}
    shared.observers.append(lambda name, d: sizes.setdefault(name, d.count()))
    try:
        selection.exact_quantiles(df, ["g"], ["a", "b"], [0.5]).collect()
    finally:
        shared.observers.pop()
    assert sizes["brackets"] == 1 and 0 < sizes["inside"] < 400


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["p", "q"]), st.integers(-3, 3).map(float), st.floats(allow_nan=False, width=32)), min_size=1, max_size=60))
def test_any_rows(spark, rows):
    assert found(table(spark, rows), accuracy=5, ranked=2) == plain(rows)

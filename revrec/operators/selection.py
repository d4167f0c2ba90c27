"""Values at exact ranks without sorting all values.

A sketch brackets every wanted rank between two values. One pass counts what lies below each bracket, one gathers
what lies inside, summed per distinct value; only those are ranked. A bracket that still holds many values is cut at
splitters of its own, again and again, so no task ever ranks more than a stated number of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revrec.functions.columns import nan_to_null
from revrec.sources.shared import materialise

#: Rank accuracy of the sketch that brackets; a bracket spans four such parts of the rows.
ACCURACY = 1000
#: Distinct values that one task ranks at most, and the parts that a larger bracket is cut into.
RANKED, PARTS = 100_000, 500


def _value(feature: str) -> Column:
    return nan_to_null(F.col(feature).cast("double"))


def _same(keys: Sequence[str], left: str = "l", right: str = "r") -> list[Column]:
    return [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str], *names: str, how: str = "inner") -> DataFrame:
    """`left` with the columns `names` of `right`, NULL keys equal; without keys `right` has one row."""
    if not keys:
        row = right.select(*names).first()
        kinds = {n: right.schema[n].dataType for n in names}
        return left.withColumns({n: F.lit(row[n] if row else None).cast(kinds[n]) for n in names})
    return left.alias("l").join(right.alias("r"), _same(keys), how).select("l.*", *[f"r.{n}" for n in names])


def _brackets(df: DataFrame, by: Sequence[str], features: Sequence[str], fractions: Sequence[float], accuracy: int) -> DataFrame:
    """(by..., _n0, _e0, _n1, ...): per feature the number of values, and two edges for each fraction."""
    reach = 2 / accuracy
    points = F.array(*[F.lit(float(min(1.0, max(0.0, f + d)))) for f in fractions for d in (-reach, reach)])
    measures = []
    for j, feature in enumerate(features):
        value = _value(feature)
        measures += [F.count(value).alias(f"_n{j}"), F.percentile_approx(value, points, accuracy).alias(f"_e{j}")]
    return materialise(df.groupBy(*by).agg(*measures), "brackets")


def _below(rows: DataFrame, by: Sequence[str], features: Sequence[str], ranks: int) -> DataFrame:
    """(by..., _b0, ...): per feature how many values lie below each bracket."""
    under = [
        F.array(*[F.count_if(_value(feature) < F.get(f"_e{j}", F.lit(2 * i))) for i in range(ranks)]).alias(f"_b{j}")
        for j, feature in enumerate(features)
    ]
    return rows.groupBy(*by).agg(*under)


def _inside(rows: DataFrame, by: Sequence[str], features: Sequence[str], ranks: int) -> DataFrame:
    """(by..., _f, _i, value, n): the distinct values inside each bracket, with their number."""
    cells = []
    for j, feature in enumerate(features):
        value = _value(feature)
        for i in range(ranks):
            low, high = (F.get(f"_e{j}", F.lit(2 * i + k)) for k in (0, 1))
            cell = F.struct(F.lit(j).alias("_f"), F.lit(i).alias("_i"), value.alias("value"))
            cells.append(F.when((value >= low) & (value <= high), cell))
    found = rows.select(*by, F.inline(F.array_compact(F.array(*cells))))
    return found.groupBy(*by, "_f", "_i", "value").agg(F.count("*").alias("n"))


def _narrowed(inside: DataFrame, targets: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Only the part of each bracket that holds the wanted rank, and the rank in it."""
    cuts = F.percentile_approx("value", F.array(*[F.lit(k / PARTS) for k in range(1, PARTS)]), 10 * PARTS)
    cut = materialise(inside.groupBy(*keys).agg(cuts.alias("_cuts")), "cuts")
    placed = _joined(inside, cut, keys, "_cuts")
    placed = placed.withColumn("_part", F.size(F.filter("_cuts", lambda c: c < F.col("value")))).drop("_cuts")
    sums = placed.groupBy(*keys, "_part").agg(F.sum("n").alias("_n"))
    before = F.sum("_n").over(W.partitionBy(*keys).orderBy("_part")) - F.col("_n")
    sums = sums.withColumn("_before", before)
    own = _joined(sums, targets, keys, "_want").filter("_before < _want and _want <= _before + _n")
    own = materialise(own.select(*keys, "_part", (F.col("_want") - F.col("_before")).alias("_want")), "targets")
    kept = _joined(placed, own, [*keys, "_part"], "_want").select(*keys, "value", "n")
    return materialise(kept, "inside"), own.select(*keys, "_want")


def exact_quantiles(df: DataFrame, by: Sequence[str], features: Sequence[str], fractions: Sequence[float],
                    accuracy: int = ACCURACY, ranked: int = RANKED) -> DataFrame:
    """(by..., feature, n, cuts): the values at ranks ceil(fraction * n), the least value for 0.

    NULL and NaN are no values; a group and feature without any has no row. Few fractions, as medians and
    histograms need: every one is a bracket of its own.
    """
    keys, ranks = [*by, "_f", "_i"], len(fractions)
    brackets = _brackets(df, by, features, fractions, accuracy)
    edges = [f"_e{j}" for j in range(len(features))]
    wanted = {
        j: F.array(*[F.greatest(F.lit(1), F.ceil(F.lit(f) * F.col(f"_n{j}"))).cast("bigint") for f in fractions])
        for j in range(len(features))
    }

    def look(rows: DataFrame) -> tuple[DataFrame, DataFrame, int, int]:
        """Brackets' contents, the ranks wanted in them, their most values, and how many ranks lie outside."""
        inside = materialise(_inside(rows, by, features, ranks), "inside")
        counted = _joined(brackets, _below(rows, by, features, ranks), by, *[f"_b{j}" for j in range(len(features))])
        per = [
            F.struct(F.lit(j).alias("_f"), F.col(f"_n{j}").alias("_total"), F.zip_with(wanted[j], f"_b{j}", lambda w, b: w - b).alias("_wants"))
            for j in range(len(features))
        ]
        tall = counted.select(*by, F.inline(F.array(*per))).filter("_total > 0").select(*by, "_f", F.posexplode("_wants").alias("_i", "_want"))
        sizes = inside.groupBy(*keys).agg(F.sum("n").alias("_held"), F.count("*").alias("_values"))
        targets = materialise(_joined(tall, sizes, keys, "_held", "_values", how="left"), "targets")
        outside = (F.col("_want") < 1) | (F.col("_want") > F.coalesce("_held", F.lit(0)))
        most, missed = targets.agg(F.max("_values"), F.count_if(outside)).first()
        return inside, targets, most or 0, missed

    rows = _joined(df, brackets, by, *edges)
    inside, targets, most, missed = look(rows)
    if missed:
        # The sketch promises its accuracy; should it miss, all values are inside.
        everything = F.array(*[F.lit(x) for _ in fractions for x in (float("-inf"), float("inf"))])
        inside, targets, most, _ = look(rows.withColumns({e: everything for e in edges}))
    while most > ranked:
        inside, targets = _narrowed(inside, targets, keys)
        fewer = inside.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
        if fewer >= most:
            break
        most = fewer
    running = F.sum("n").over(W.partitionBy(*keys).orderBy("value"))
    at = _joined(inside.withColumn("_upto", running), targets, keys, "_want").filter("_upto >= _want")
    found = at.groupBy(*keys).agg(F.min("value").alias("value"))
    cuts = F.transform(F.array_sort(F.collect_list(F.struct("_i", "value"))), lambda x: x["value"])
    per = [F.struct(F.lit(j).alias("_f"), F.lit(f).alias("feature"), F.col(f"_n{j}").alias("n")) for j, f in enumerate(features)]
    sizes = brackets.select(*by, F.inline(F.array(*per)))
    lists = found.groupBy(*by, "_f").agg(cuts.alias("cuts"))
    return _joined(lists, sizes, [*by, "_f"], "feature", "n").select(*by, "feature", "n", "cuts")

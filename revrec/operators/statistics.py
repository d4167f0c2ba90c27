"""Per-split feature statistics and a schema inferred from the data.

Results are long tables, so any number of features and splits fits one shape.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from revrec.functions.columns import nan_to_null
from revrec.operators.histograms import bin_number
from revrec.operators.ordering import top_n
from revrec.operators.selection import exact_quantiles
from revrec.sources.shared import materialise
from revrec.sources.tables import union_splits


def numeric_features(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def string_features(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def _long_form(df: DataFrame, by: Sequence[str], features: Sequence[str], kind: str) -> DataFrame:
    """(by..., feature, value): one row per feature and input row, in one pass."""
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).cast(kind).alias("value")) for c in features]
    return df.select(*by, F.inline(F.array(*cells)))


def _side_by_side(df: DataFrame, by: Sequence[str], measures: Sequence[Column]) -> DataFrame:
    """(by..., feature, measures...): all features in one wide aggregate, rows are not multiplied."""
    wide = df.groupBy(*by).agg(*[m.alias(f"_f{i}") for i, m in enumerate(measures)])
    return wide.select(*by, F.inline(F.array(*[F.col(f"_f{i}") for i in range(len(measures))])))


def _tall(wide: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., feature, stat, value)."""
    stats = [c for c in wide.columns if c not in (*by, "feature")]
    cells = [F.struct(F.lit(s).alias("stat"), F.col(s).cast("double").alias("value")) for s in stats]
    return wide.select(*by, "feature", F.inline(F.array(*cells)))


def numeric_statistics(df: DataFrame, by: Sequence[str] = (), features: Sequence[str] | None = None,
                       accuracy: int = 10000, exact: bool = False) -> DataFrame:
    """(by..., feature, stat, value). The median is within 1/accuracy of the row count in rank, or `exact`."""
    features = numeric_features(df) if features is None else features

    def measures(feature: str) -> Column:
        value = nan_to_null(F.col(feature).cast("double"))
        return F.struct(
            F.lit(feature).alias("feature"),
            F.count("*").alias("num_examples"),
            F.count(value).alias("num_present"),
            (F.count("*") - F.count(value)).alias("num_missing"),
            F.avg(value).alias("mean"),
            F.stddev_pop(value).alias("std_dev"),
            F.count_if(value == 0).alias("num_zeros"),
            F.min(value).alias("min"),
            (F.lit(None).cast("double") if exact else F.percentile_approx(value, 0.5, accuracy)).alias("median"),
            F.max(value).alias("max"),
        )

    tall = _tall(_side_by_side(df, by, [measures(f) for f in features]), by)
    if not exact:
        return tall
    medians = exact_quantiles(df, by, features, [0.5]).select(
        *by, "feature", F.lit("median").alias("stat"), F.get("cuts", F.lit(0)).alias("_exact"))
    same = [F.col(f"t.{k}").eqNullSafe(F.col(f"m.{k}")) for k in (*by, "feature", "stat")]
    value = F.when(F.col("t.stat") == "median", F.col("_exact")).otherwise(F.col("t.value"))
    return tall.alias("t").join(medians.alias("m"), same, "left").select(*[f"t.{k}" for k in (*by, "feature", "stat")], value.alias("value"))


def numeric_histograms(df: DataFrame, by: Sequence[str] = (), features: Sequence[str] | None = None,
                       bins: int = 10, accuracy: int = 10000, exact: bool = False) -> DataFrame:
    """(by..., feature, kind, bin, low, high, count): equal-width and equal-depth bins.

    Equal-depth bins give their edges; each holds 1/bins of the rows, up to 1/accuracy in rank or `exact`.
    """
    features = numeric_features(df) if features is None else features
    keys = [*by, "feature"]
    cells = _long_form(df, by, features, "double").withColumn("value", nan_to_null(F.col("value")))
    cells = cells.filter("value is not null")
    fractions = [i / bins for i in range(bins + 1)]
    if exact:
        cut = exact_quantiles(df, by, features, fractions)
        ends = [F.get("cuts", F.lit(0)).alias("_low"), F.get("cuts", F.lit(bins)).alias("_high")]
        shape = cut.select(*keys, *ends, F.col("n").alias("_n"), F.col("cuts").alias("_cuts"))
    else:
        shape = cells.groupBy(*keys).agg(
            F.min("value").alias("_low"),
            F.max("value").alias("_high"),
            F.count("*").alias("_n"),
            F.percentile_approx("value", F.lit(fractions), accuracy).alias("_cuts"),
        )
    # Written once: it is used three times, and Spark then knows its size when it plans the join.
    shape = materialise(shape, "shape")
    numbers = F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin")
    named = [F.col(f"s.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
    counts = (
        cells.alias("c")
        .join(shape.alias("s"), named)
        .select("s.feature", *[f"s.{b}" for b in by], bin_number(F.col("value"), F.col("_low"), F.col("_high"), bins).alias("bin"))
        .groupBy(*keys, "bin")
        .agg(F.count("*").alias("count"))
    )
    width = (F.col("_high") - F.col("_low")) / bins
    bin_ = F.col("bin")
    grid = shape.select(*keys, "_low", "_high", numbers)
    standard = (
        grid.alias("s")
        .join(counts.alias("c"), [*named, F.col("s.bin") == F.col("c.bin")], "left")
        .select(
            *[f"s.{k}" for k in keys],
            F.lit("standard").alias("kind"),
            F.col("s.bin").alias("bin"),
            (F.col("_low") + width * (F.col("s.bin") - 1)).alias("low"),
            (F.col("_low") + width * F.col("s.bin")).alias("high"),
            F.coalesce("count", F.lit(0)).cast("double").alias("count"),
        )
    )
    quantile = shape.select(*keys, "_cuts", "_n", numbers).select(
        *keys,
        F.lit("quantile").alias("kind"),
        bin_,
        F.get("_cuts", bin_ - 1).alias("low"),
        F.get("_cuts", bin_).alias("high"),
        (F.col("_n") / bins).alias("count"),
    )
    return standard.unionByName(quantile)


def _digest(value: Column) -> Column:
    """What stands for a value where only its identity matters: texts of any length shuffle as 32 bytes."""
    return F.unhex(F.sha2(value, 256))


def value_counts(df: DataFrame, by: Sequence[str] = (), features: Sequence[str] | None = None) -> DataFrame:
    """(by..., feature, digest, count) of the present values."""
    features = string_features(df) if features is None else features
    cells = _long_form(df, by, [f for f in features if f not in by], "string").filter("value is not null")
    return cells.groupBy(*by, "feature", _digest(F.col("value")).alias("digest")).agg(F.count("*").alias("count"))


def string_statistics(df: DataFrame, by: Sequence[str] = (), features: Sequence[str] | None = None,
                      approximate: bool = False) -> DataFrame:
    """(by..., feature, stat, value); `approximate` counts distinct values by sketch."""
    features = [f for f in (string_features(df) if features is None else features) if f not in by]
    cells = _long_form(df, by, features, "string")
    keys = [*by, "feature"]
    length = F.char_length("value")
    measures = [
        F.count("*").alias("num_examples"),
        F.count("value").alias("num_present"),
        (F.count("*") - F.count("value")).alias("num_missing"),
        F.sum(length).alias("_chars"),
        F.max(F.coalesce(length, F.lit(0))).alias("max_length"),
    ]
    if approximate:
        wide = cells.groupBy(*keys).agg(*measures, F.approx_count_distinct("value").alias("unique"))
    else:
        # Two levels: per value first, so that a frequent value is folded on the map side.
        per_value = cells.groupBy(*keys, _digest(F.col("value")).alias("_key")).agg(*measures)
        wide = per_value.groupBy(*keys).agg(
            *[F.sum(c).alias(c) for c in ("num_examples", "num_present", "num_missing", "_chars")],
            F.max("max_length").alias("max_length"),
            F.count("_key").alias("unique"),
        )
    wide = wide.withColumn("avg_length", F.try_divide(F.col("_chars"), F.col("num_present"))).drop("_chars")
    return _tall(wide, by)


def top_values(df: DataFrame, by: Sequence[str] = (), features: Sequence[str] | None = None, n: int = 20) -> DataFrame:
    """(by..., feature, rank, value, count): the rank histogram of the n most frequent values.

    Equal counts go by the values' SHA-256. Counted by digest; only the n chosen ones of each
    feature and group are then looked up as text.
    """
    features = [f for f in (string_features(df) if features is None else features) if f not in by]
    order = [F.col("count").desc(), F.col("digest").asc()]
    ranked = materialise(top_n(value_counts(df, by, features), [*by, "feature"], order, n), "ranked")
    cells = _long_form(df, by, features, "string").filter("value is not null").withColumn("digest", _digest(F.col("value")))
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"r.{k}")) for k in (*by, "feature", "digest")]
    # At most n rows a feature and group: Spark sends them to the cells' side where their size allows.
    found = cells.alias("c").join(ranked.alias("r"), same).groupBy(*[F.col(f"r.{k}").alias(k) for k in (*by, "feature", "rank")])
    return found.agg(F.min("c.value").alias("value"), F.first("r.count").alias("count"))


def presence_statistics(df: DataFrame, by: Sequence[str], features: Sequence[str]) -> DataFrame:
    """(by..., feature, stat, value) for features of any type: how often they are there."""
    measures = [
        F.struct(
            F.lit(f).alias("feature"),
            F.count("*").alias("num_examples"),
            F.count(f).alias("num_present"),
            (F.count("*") - F.count(f)).alias("num_missing"),
        )
        for f in features
    ]
    return _tall(_side_by_side(df, by, measures), by)


def feature_statistics(df: DataFrame, split_col: str | None = None, accuracy: int = 10000, exact: bool = False) -> DataFrame:
    """([split], feature, stat, value) of all features: full for numbers and strings, presence for others."""
    by, numeric, strings, others = _kinds(df, split_col)
    parts = []
    if numeric:
        parts.append(numeric_statistics(df, by, numeric, accuracy, exact))
    if strings:
        parts.append(string_statistics(df, by, strings))
    if others:
        parts.append(presence_statistics(df, by, others))
    return union_splits(*parts)


def _kinds(df: DataFrame, split_col: str | None) -> tuple[list[str], list[str], list[str], list[str]]:
    by = [split_col] if split_col else []
    features = [c for c in df.columns if c not in by]
    numeric = [c for c in numeric_features(df) if c in features]
    strings = [c for c in string_features(df) if c in features]
    return by, numeric, strings, [c for c in features if c not in numeric and c not in strings]


@dataclass(frozen=True)
class Profile:
    """Everything about the features of a table, each part worked out when it is first asked for."""

    table: DataFrame
    split_col: str | None = None
    n: int = 20
    bins: int = 10
    accuracy: int = 10000
    exact: bool = False

    @cached_property
    def statistics(self) -> DataFrame:
        """Figures of all features."""
        return feature_statistics(self.table, self.split_col, self.accuracy, self.exact)

    @cached_property
    def histograms(self) -> DataFrame | None:
        """Histograms of numbers, None without any."""
        by, numeric, _, _ = _kinds(self.table, self.split_col)
        return numeric_histograms(self.table, by, numeric, self.bins, self.accuracy, self.exact) if numeric else None

    @cached_property
    def top_values(self) -> DataFrame | None:
        """Top values of strings, None without any."""
        by, _, strings, _ = _kinds(self.table, self.split_col)
        return top_values(self.table, by, strings, self.n) if strings else None


def profile(df: DataFrame, split_col: str | None = None, n: int = 20, bins: int = 10, accuracy: int = 10000,
            exact: bool = False) -> Profile:
    """All statistics of all columns, per split if one is named."""
    return Profile(df, split_col, n, bins, accuracy, exact)


def infer_schema(df: DataFrame, stats: DataFrame | None = None, domain_limit: int = 50,
                 features: Sequence[str] | None = None) -> DataFrame:
    """(feature, type, presence, domain): a domain only for strings with few distinct values.

    `stats` are those of `feature_statistics(df)`; without them only presence is counted.
    """
    features = df.columns if features is None else list(features)
    stats = presence_statistics(df, (), features) if stats is None else stats
    missing = (
        stats.filter(F.col("stat") == "num_missing")
        .groupBy("feature")
        .agg(F.sum("value").alias("_missing"))
    )
    kinds = F.lit(None)
    for c in features:
        kinds = F.when(F.col("feature") == c, df.schema[c].dataType.simpleString()).otherwise(kinds)
    strings = [c for c in string_features(df) if c in features]
    schema = missing.filter(F.col("feature").isin(features)).select(
        "feature",
        kinds.cast("string").alias("type"),
        F.when(F.col("_missing") == 0, "required").otherwise("optional").alias("presence"),
    )
    if not strings:
        return schema.withColumn("domain", F.lit(None).cast("array<string>"))
    # A sketch of every column first: only values of columns that can be under the limit are gathered.
    sketched = df.agg(*[F.approx_count_distinct(c, 0.02).alias(f"_{i}") for i, c in enumerate(strings)]).first()
    likely = [c for i, c in enumerate(strings) if sketched[f"_{i}"] <= 2 * domain_limit]
    if not likely:
        return schema.withColumn("domain", F.lit(None).cast("array<string>"))
    few = top_n(_long_form(df, (), likely, "string").filter("value is not null").distinct(), ["feature"], ["value"], domain_limit + 1)
    domains = few.groupBy("feature").agg(
        F.array_sort(F.collect_list("value")).alias("domain"), F.count("*").alias("_distinct")
    )
    return schema.join(domains.filter(F.col("_distinct") <= domain_limit), "feature", "left").drop("_distinct")

"""Transformations whose analysis is done once and kept: fit, write, load, apply to rows never analysed.

A state is two tables. `figures` has one row per analyser (mean and deviation, least and greatest value, bucket
boundaries, vocabulary size); it is bounded by the number of analysers, so it becomes literals. `tokens` has all
vocabularies, which may be of any size and are joined.

All analysers of a kind share their passes: moments and ranges one aggregate, quantiles one selection, vocabularies
one count of (analyser, token) and one ranking.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revrec.functions.columns import nan_to_null
from revrec.operators.ordering import rank_within
from revrec.operators.selection import exact_quantiles
from revrec.operators.vocabulary import apply_vocabulary
from revrec.sources.shared import materialise


@dataclass(frozen=True)
class Vocabulary:
    """Index of a token, most frequent first; unknown ones in `oov_buckets` slots after the last index."""

    column: str
    oov_buckets: int = 0
    min_count: int = 1


@dataclass(frozen=True)
class ZScore:
    """(value - mean) / deviation of the population; 0 where all values are equal."""

    column: str


@dataclass(frozen=True)
class MinMax:
    """(value - least) / (greatest - least), outside of 0 to 1 for values outside; 0 where all values are equal."""

    column: str


@dataclass(frozen=True)
class Buckets:
    """Number of boundaries not above the value; boundaries are the exact quantiles at k / count."""

    column: str
    count: int = 10


Analyser = Vocabulary | ZScore | MinMax | Buckets
_KINDS = {k.__name__: k for k in (Vocabulary, ZScore, MinMax, Buckets)}
_FIGURES = "name string, spec string, numbers array<double>"


def _number(column: str) -> Column:
    return nan_to_null(F.col(column).cast("double"))


def _moments(df: DataFrame, analysers: Mapping[str, Analyser]) -> dict[str, list[float | None]]:
    """Mean and deviation, or least and greatest value, of all numeric analysers from one pass."""
    measures = {}
    for name, a in analysers.items():
        value = _number(a.column)
        if isinstance(a, ZScore):
            measures[name] = F.array(F.avg(value), F.stddev_pop(value))
        elif isinstance(a, MinMax):
            measures[name] = F.array(F.min(value), F.max(value))
    if not measures:
        return {}
    row = df.agg(*[m.alias(f"_{i}") for i, m in enumerate(measures.values())]).first()
    return {name: row[f"_{i}"] for i, name in enumerate(measures)}


def _boundaries(df: DataFrame, analysers: Mapping[str, Analyser]) -> dict[str, list[float]]:
    """Bucket boundaries, all columns of one bucket count from one selection."""
    out: dict[str, list[float]] = {}
    for count in sorted({a.count for a in analysers.values() if isinstance(a, Buckets)}):
        own = {n: a.column for n, a in analysers.items() if isinstance(a, Buckets) and a.count == count}
        columns = sorted(set(own.values()))
        fractions = [k / count for k in range(1, count)]
        cuts = {r["feature"]: r["cuts"] for r in exact_quantiles(df, [], columns, fractions).collect()} if fractions else {}
        out |= {n: cuts.get(c, []) for n, c in own.items()}
    return out


def _tokens(df: DataFrame, analysers: Mapping[str, Analyser]) -> DataFrame | None:
    """(name, token, index, count) of all vocabularies: one count, one ranking."""
    own = {n: a for n, a in analysers.items() if isinstance(a, Vocabulary)}
    if not own:
        return None
    cells = F.array(*[F.struct(F.lit(n).alias("name"), F.col(a.column).cast("string").alias("token")) for n, a in own.items()])
    counts = df.select(F.inline(cells)).filter("token <> ''").groupBy("name", "token").agg(F.count("*").alias("count"))
    least = F.create_map(*[x for n, a in own.items() for x in (F.lit(n), F.lit(a.min_count))])
    counts = counts.filter(F.col("count") >= least[F.col("name")])
    ranked = rank_within(counts, ["name"], [F.col("count").desc(), F.col("token").desc()], "_rank")
    return ranked.select("name", "token", (F.col("_rank") - 1).alias("index"), "count")


@dataclass(frozen=True)
class State:
    """What fitting found; `write` and `load` keep it, `apply` needs nothing else."""

    analysers: dict[str, Analyser]
    numbers: dict[str, list[float]]
    tokens: DataFrame | None

    def write(self, spark: SparkSession, path: str) -> None:
        """Tokens first, then the figures, so that a state that can be read is whole."""
        if self.tokens is not None:
            self.tokens.write.partitionBy("name").parquet(f"{path}/tokens")
        spec = lambda a: json.dumps({"kind": type(a).__name__, **asdict(a)}, sort_keys=True)
        rows = [(n, spec(a), self.numbers[n]) for n, a in self.analysers.items()]
        spark.createDataFrame(rows, _FIGURES).coalesce(1).write.parquet(f"{path}/figures")

    def cardinality(self, name: str) -> int:
        """Slots that a vocabulary's look-up can return, those for unknown tokens included."""
        return int(self.numbers[name][0]) + self.analysers[name].oov_buckets

    def apply(self, df: DataFrame, keep: Sequence[str | Column] = ()) -> DataFrame:
        """The analysers' outputs under their names, after the columns of `keep`; no row is lost.

        NULL and NaN numbers give NULL, NULL and empty tokens -1; a vocabulary gives -1 for unknown tokens
        where it has no slots for them.
        """
        keep = [F.col(c) if isinstance(c, str) else c for c in keep]
        plain = {n: self._output(n, a) for n, a in self.analysers.items() if not isinstance(a, Vocabulary)}
        words = {n: a for n, a in self.analysers.items() if isinstance(a, Vocabulary)}
        # Columns to look up travel under names of their own, so outputs may be named like inputs.
        out = df.select(*keep, *[c.alias(f"_out_{n}") for n, c in plain.items()], *[F.col(a.column).alias(f"_in_{n}") for n, a in words.items()])
        kept = out.columns[:len(keep)]
        for n, a in words.items():
            own = self.tokens.filter(F.col("name") == n)
            out = apply_vocabulary(out, own, f"_in_{n}", f"_out_{n}", oov_buckets=a.oov_buckets, size=int(self.numbers[n][0]))
        return out.select(*kept, *[F.col(f"_out_{n}").alias(n) for n in self.analysers])

    def _output(self, name: str, a: Analyser) -> Column:
        value, numbers = _number(a.column), self.numbers[name]
        if isinstance(a, Buckets):
            return F.when(value.isNotNull(), F.size(F.filter(F.lit(numbers).cast("array<double>"), lambda b: b <= value)))
        first, second = (F.lit(x).cast("double") for x in numbers)
        width = second if isinstance(a, ZScore) else second - first
        return F.when(value.isNotNull(), F.when(width == 0, 0.0).otherwise((value - first) / width))


def fit(df: DataFrame, analysers: Mapping[str, Analyser]) -> State:
    """Analyses `df` for all analysers, keyed by the names of their outputs."""
    tokens = _tokens(df, analysers)
    if tokens is not None:
        tokens = materialise(tokens, "tokens", by=["name"])
    numbers = _moments(df, analysers) | _boundaries(df, analysers)
    if tokens is not None:
        sizes = {r["name"]: r["count"] for r in tokens.groupBy("name").count().collect()}
        numbers |= {n: [float(sizes.get(n, 0))] for n, a in analysers.items() if isinstance(a, Vocabulary)}
    return State(dict(analysers), {n: [x for x in numbers[n]] for n in analysers}, tokens)


def load(spark: SparkSession, path: str) -> State:
    """A state that `State.write` stored."""
    analysers, numbers = {}, {}
    for row in spark.read.schema(_FIGURES).parquet(f"{path}/figures").collect():
        spec = json.loads(row["spec"])
        analysers[row["name"]] = _KINDS[spec.pop("kind")](**spec)
        numbers[row["name"]] = row["numbers"]
    words = any(isinstance(a, Vocabulary) for a in analysers.values())
    tokens = spark.read.schema("token string, index bigint, count bigint, name string").parquet(f"{path}/tokens") if words else None
    return State(analysers, numbers, tokens)

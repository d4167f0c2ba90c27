"""Quality classifier from trusted positives and unlabelled text (non-negative PU learning).

Each text gets a row of figures that name no label, language, source or id. Their quantile bins make a
linear model; it minimises the non-negative unbiased risk

    prior * R+(positives, +1) + max(0, R(unlabelled, -1) - prior * R(positives, -1))

with the logistic loss, where negative labels never enter and the prior of positives is estimated from the
share of positives among the labelled rows. A batch whose second term falls below zero takes a step
against that term, as the method says. The fit takes at most `sample` positives and `sample` unlabelled rows, chosen by
digest over all rows; figures, the prior and scores cover all rows.

Rules: NULL text is an empty one and is scored like any other; labels of a document that contradict each
other and NULL labels are left out; without a trusted positive every score is the prior (0.5 without
labels); repeated rows are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revrec.llm.texts import documents, fold, slices
from revrec.sources.shared import materialise

#: Positives and unlabelled rows that the fit may take, of each.
SAMPLE = 20_000
THRESHOLD = 0.3
BINS, STEPS, BATCH, RATE, DECAY, SEED = 8, 3000, 256, 0.02, 1e-5, 11

FIGURES = (
    "log_words", "word_length", "upper", "digit", "symbol", "bang", "stop", "comma", "other_mark", "line_share",
    "distinct", "adjacent", "same_lines", "short_lines", "longest_word", "capitals", "marked_words", "long_words",
)
_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "symbol": b"#$%&*|<>{}[]\\^~=_@+/", "bang": b"!?",
    "stop": b".", "comma": b",;:", "other_mark": b"\"'()-`",
}
_MASKS = np.array([[b in kind for b in range(256)] for kind in _KINDS.values()], np.float64)


def figures(text: str) -> list[float]:
    """Shares and lengths that tell prose from junk; all zero for a text without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FIGURES)
    raw = np.frombuffer(text.encode(), np.uint8)
    shares = (_MASKS @ np.bincount(raw, minlength=256) / len(raw)).tolist()
    # Upper case outside ASCII: as many letters as change when all are lowered.
    upper = sum(1 for w in words if len(w) > 1 and w.isupper()) / n
    lines = [x for x in text.split("\n") if x.strip()]
    repeats = sum(map(eq, words, islice(words, 1, None))) / n
    short = sum(len(x) < 20 for x in lines) / len(lines)
    return [
        float(np.log1p(n)), len(text) / n, max(shares[0], upper), *shares[1:], len(lines) / n,
        len(set(words)) / n, repeats, 1 - len(set(lines)) / len(lines), short, float(np.log1p(max(map(len, words)))),
        sum(1 for w in words if w[0].isupper()) / n, sum(1 for w in words if not w[-1].isalnum()) / n,
        sum(1 for w in words if len(w) > 12) / n,
    ]


def figured(docs: DataFrame) -> DataFrame:
    """(doc_id, figures) of every row, from whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = [figures(t or "") for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "figures"])

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, figures array<double>")


@dataclass
class PositiveUnlabelled:
    """Bins and weights of the fitted model; without weights it only knows the prior."""

    prior: float
    edges: np.ndarray | None = None
    centre: np.ndarray | None = None
    spread: np.ndarray | None = None
    weights: np.ndarray | None = None

    def _inputs(self, x: np.ndarray) -> np.ndarray:
        """Standardised figures, the bin of each, and a constant."""
        scaled = np.clip((x - self.centre) / self.spread, -4, 4)
        bins = (x[:, :, None] > self.edges[None]).sum(axis=2)
        marks = (bins[:, :, None] == np.arange(self.edges.shape[1] + 1)).reshape(len(x), -1)
        return np.hstack([scaled, marks, np.ones((len(x), 1))])

    def fit(self, positive: np.ndarray, unlabelled: np.ndarray) -> PositiveUnlabelled:
        both = np.vstack([positive, unlabelled])
        self.edges = np.quantile(both, np.arange(1, BINS) / BINS, axis=0).T
        self.centre, self.spread = both.mean(axis=0), both.std(axis=0) + 1e-9
        p, u = self._inputs(positive), self._inputs(unlabelled)
        rng = np.random.default_rng(SEED)
        w = np.zeros(p.shape[1])
        first, second = np.zeros_like(w), np.zeros_like(w)
        for step in range(1, STEPS + 1):
            a = p[rng.integers(0, len(p), BATCH)]
            b = u[rng.integers(0, len(u), BATCH)]
            sa, sb = _sigmoid(a @ w), _sigmoid(b @ w)
            # log(1 + e^z) is the loss of calling a row negative, log(1 + e^-z) of calling it positive.
            rest = np.logaddexp(0, b @ w).mean() - self.prior * np.logaddexp(0, a @ w).mean()
            up = b.T @ sb / len(b) - self.prior * (a.T @ sa) / len(a)
            gradient = self.prior * (a.T @ (sa - 1)) / len(a) + up if rest >= 0 else -up
            gradient = gradient + DECAY * np.append(w[:-1], 0)
            first = 0.9 * first + 0.1 * gradient
            second = 0.999 * second + 0.001 * gradient ** 2
            w = w - RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
        self.weights = w
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None or not len(x):
            return np.full(len(x), self.prior)
        return _sigmoid(self._inputs(x) @ self.weights)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def learn(rows: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> PositiveUnlabelled:
    """Model from figured rows and (doc_id, quality) labels of the training fold."""
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (fold(F.col("doc_id")) != 0))
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.min("quality").alias("low"), F.max("quality").alias("high")).filter("low = high")
    )
    known = materialise(known.select("doc_id", (F.col("low") == 1).alias("good")), "labels")
    count, good = known.agg(F.count("*"), F.count_if("good")).first()
    prior = float(np.clip((good + 1) / (count + 2), 0.02, 0.98))
    model = PositiveUnlabelled(prior)
    positives = rows.join(known.filter("good"), "doc_id", "left_semi")

    def drawn(df: DataFrame) -> np.ndarray:
        # Rows below a digest that lets through about a third more than wanted, then the smallest of
        # them: each task hands the driver its share of those only, however many tasks there are.
        digest, count = F.xxhash64("doc_id", "figures", F.lit(SEED)), df.count()
        least = min(2**63 - 1, int(-(2**63) + 2**64 * (1.33 * sample + 100) / max(1, count)))
        few = df.filter(digest <= F.lit(least)).orderBy(digest, "doc_id", "figures").limit(sample)
        return np.array([r["figures"] for r in few.select("figures").collect()], np.float64).reshape(-1, len(FIGURES))

    positive, unlabelled = drawn(positives), drawn(rows)
    return model.fit(positive, unlabelled) if len(positive) and len(unlabelled) else model


def score(rows: DataFrame, model: PositiveUnlabelled) -> DataFrame:
    """(doc_id, score) of figured rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("figures").to_pylist(), np.float64).reshape(-1, len(FIGURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], ["doc_id", "score"])

    return rows.select("doc_id", "figures").mapInArrow(run, "doc_id bigint, score double")


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, score) of every row of `docs`, by a model learnt from them and the training labels."""
    rows = materialise(figured(docs), "figures")
    return score(rows, learn(rows, labels, sample))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """Rows of `docs` that score at the threshold or above. Scored where they stand, so no row is joined."""
    model = learn(materialise(figured(docs), "figures"), labels, sample)
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = [figures(t or "") for t in part.column("text").to_pylist()]
                good = model.score(np.array(rows, np.float64).reshape(-1, len(FIGURES))) >= threshold
                yield part.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema).select(*columns)


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    scored = classify(documents(spark, sf_dir), labels)
    return scored.select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )

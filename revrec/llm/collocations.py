"""Phrases of two to five words that stand together more often than their parts let expect.

1. Texts are cut into pieces and words, a block of them at a time. Prefix polynomials over the words' hashes
   give the Rabin-Karp fingerprint of every run of n words with one subtraction and one product each.
2. A shuffle sums the fingerprints' counts, shorter runs first: (1, 2), then 3 where both pairs reached the
   limit, then 4 and 5 where all their triples did. What reaches the limit is written as sorted arrays that
   workers map. A collision can only raise a count here, so no frequent phrase is missed.
3. In a last pass every occurrence of such a fingerprint is compared word by word with the block's first one;
   the words themselves, with their count and a pointer to an occurrence (document, place), are shuffled and
   counted as text. So counts are exact, and only phrases above the limit are ever written out.
4. Scores, containment and ranks are joins over the frequent phrases alone.

Rules: NULL text is empty; NULL lang counts as `und`; a phrase never crosses a piece, so never a document;
repeated rows count as often as they stand there; ties of score and count go by the phrase's bytes; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revrec.llm.language_model import Vocabulary, write_vocabulary
from revrec.llm.texts import documents, give_back, slices, small_batches
from revrec.operators.ordering import top_n
from revrec.sources.shared import materialise, new_path

LONGEST = 5
MIN_COUNT = 100
#: A phrase goes where a longer one has this percentage of its occurrences.
WITHIN = 100
TOP = 2000
#: Bytes of text in a block; its arrays take some thirty times as many.
BLOCK_BYTES = 1 << 20
NO_LANG = "und"
#: Runs of these lengths are counted together, each where the named shorter runs inside reached the limit.
ROUNDS = ((1, 2), (3,), (4, 5))

_BASE = 0x9E3779B97F4A7C15 | 5  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_BREAK, _NEXT = b"\n", b"."  # marks of a piece's and of a text's end; no translated text holds the second
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(
    bytes(range(65, 91)) + b"\t" + _BREAKS, bytes(range(97, 123)) + b" " + _BREAK * len(_BREAKS))
_APART = np.array([chr(b) in " \n." for b in range(256)])
_SPACED = bytes.maketrans(_BREAK + _NEXT, b"  ")

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        factors = np.full(max(n, 1 << 16), base, np.uint64)
        factors[0] = 1
        held = _powers[base] = np.cumprod(factors)
    return held[:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@dataclass
class Block:
    """The words of a block of texts, in order: piece, text and hash of each; the texts' languages.

    With `coded` also the code of each word among the distinct `words`, for comparing words themselves.
    """

    pieces: np.ndarray
    owners: np.ndarray
    hashes: np.ndarray
    langs: list[str]
    codes: np.ndarray | None = None
    words: pa.Array | None = None

    def __post_init__(self):
        import xxhash

        self.names = sorted(set(self.langs))
        at = {name: i for i, name in enumerate(self.names)}
        self.lang = np.array([at[x] for x in self.langs], np.int32)[self.owners] if self.langs else np.empty(0, np.int32)
        self.seeds = np.array([xxhash.xxh64_intdigest(n.encode(), 1) for n in self.names], np.uint64)
        self.prefix = _prefix(self.hashes)

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether a run of n words that begins at a word stays in its piece, and its fingerprint."""
        count = max(0, len(self.hashes) - n + 1)
        inside = self.pieces[:count] == self.pieces[n - 1:n - 1 + count]
        value = (self.prefix[n:n + count] - self.prefix[:count]) * _power(_BASE, count + n - 1)[n - 1:]
        if len(self.seeds):
            value ^= (self.seeds + np.uint64(n))[self.lang[:count]]
        return inside, _mixed(value).view(np.int64)


def _prefix(values: np.ndarray) -> np.ndarray:
    """Sums of values[j] / base^j over the first j: a run's polynomial is a difference times a power of the base."""
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _power(_INVERSE, len(values)))])


def block(texts: Sequence[bytes | None], langs: Sequence[str | None], coded: bool = False) -> Block:
    joined = _NEXT.join((t or b"").translate(_PLAIN) for t in texts)
    raw = np.frombuffer(joined, np.uint8)
    apart = np.concatenate([[True], _APART[raw], [True]])
    edges = np.flatnonzero(apart[1:] != apart[:-1])
    starts, ends = edges[::2], edges[1::2]
    # Words have their polynomial from their bytes, which count from 1 so that no leading one is lost.
    prefix = _prefix(raw.astype(np.uint64) + np.uint64(1))
    hashes = _mixed((prefix[ends] - prefix[starts]) * _power(_BASE, len(raw) + 1)[ends - 1])
    nexts = np.flatnonzero(raw == _NEXT[0])
    breaks = np.flatnonzero((raw == _NEXT[0]) | (raw == _BREAK[0]))
    own = Block(np.searchsorted(breaks, starts), np.searchsorted(nexts, starts), hashes, [NO_LANG if x is None else x for x in langs])
    if coded:
        plain = joined.translate(_SPACED)
        words = pc.split_pattern(pa.array([plain], pa.large_binary()), b" ").flatten().dictionary_encode()
        codes, own.words = np.asarray(words.indices), words.dictionary.cast(pa.large_binary())
        empty = pc.index(own.words, pa.scalar(b"", pa.large_binary())).as_py()
        own.codes = codes[codes != empty]
    return own


def _blocks(batches: Iterator[pa.RecordBatch], coded: bool = False) -> Iterator[tuple[pa.RecordBatch, Block]]:
    for batch in batches:
        for part in slices(batch, most=BLOCK_BYTES):
            yield part, block(part.column("text").cast(pa.large_binary()).to_pylist(), part.column("lang").to_pylist(), coded)
            give_back()


def _known(values: np.ndarray, held: Vocabulary) -> np.ndarray:
    """Which fingerprints the vocabulary holds."""
    distinct, place = np.unique(values, return_inverse=True)
    return (held.ids(distinct) >= 0)[place]


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.col(c).cast(t).alias(c) for c, t in (("doc_id", "bigint"), ("text", "string"), ("lang", "string"))])


def _counted(docs: DataFrame, orders: Sequence[int], known: Vocabulary | None) -> DataFrame:
    """(fp, lang, n) with the runs' counts by fingerprint; in the first round each lang's words, without one."""
    shorter = orders[0] - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own in _blocks(batches):
            held = None
            if known is not None:
                inside, values = own.runs(shorter)
                held = inside.copy()
                held[inside] = _known(values[inside], known)
            else:
                total = np.bincount(own.lang, minlength=len(own.names))
                yield _batch(pa.nulls(len(total), pa.int64()), pa.array(own.names, pa.string()), pa.array(total))
            for n in orders:
                inside, values = own.runs(n)
                if held is not None:
                    for k in range(n - shorter + 1):
                        inside = inside & held[k:k + len(inside)]
                found, count = np.unique(values[inside], return_counts=True)
                for at in range(0, len(found), 1 << 18):
                    some = found[at:at + (1 << 18)]
                    yield _batch(pa.array(some), pa.nulls(len(some), pa.string()), pa.array(count[at:at + (1 << 18)]))

    def _batch(*columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(list(columns), ["fp", "lang", "n"])

    partial = _slim(docs).mapInArrow(run, "fp bigint, lang string, n bigint")
    return partial.groupBy("fp", "lang").agg(F.sum("n").alias("n"))


def _first_places(own: Block, n: int, at: np.ndarray, values: np.ndarray, known: Vocabulary | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First place and count of every distinct run among those at `at` whose fingerprint is known, compared word
    by word and not by fingerprint."""
    found, count = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    while len(at):
        distinct, group = np.unique(values, return_inverse=True)
        held = np.ones(len(distinct), bool) if known is None else known.ids(distinct) >= 0
        number, kept, known = np.cumsum(held) - 1, held[group], None
        at, values, group = at[kept], values[kept], number[group[kept]]
        first = np.empty(np.count_nonzero(held), np.int64)
        first[group[::-1]] = at[::-1]
        head = first[group]
        same = own.lang[at] == own.lang[head]
        for k in range(n):
            same &= own.codes[at + k] == own.codes[head + k]
        found.append(first)
        count.append(np.bincount(group[same], minlength=len(first)))
        # Runs that only share the fingerprint: once more among themselves.
        at, values = at[~same], values[~same]
    return np.concatenate(found), np.concatenate(count)


def _texts(docs: DataFrame, known: dict[int, Vocabulary]) -> DataFrame:
    """(lang, words, phrase, n, doc_id, at): runs with a frequent fingerprint as text, with one occurrence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, own in _blocks(batches, coded=True):
            starts = np.searchsorted(own.owners, np.arange(len(own.langs)))
            ids = part.column("doc_id")
            for n, held in known.items():
                inside, values = own.runs(n)
                at = np.flatnonzero(inside)
                place, count = _first_places(own, n, at, values[at], held)
                for a in range(0, len(place), 1 << 17):
                    some = place[a:a + (1 << 17)]
                    words = [own.words.take(pa.array(own.codes[some + k])) for k in range(n)]
                    phrase = pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.large_binary())) if n > 1 else words[0]
                    owner = own.owners[some]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([own.names[i] for i in own.lang[some].tolist()], pa.string()), pa.array(np.full(len(some), n, np.int32)),
                        phrase.cast(pa.large_string()).cast(pa.string()), pa.array(count[a:a + (1 << 17)]),
                        ids.take(pa.array(owner)), pa.array(some - starts[owner]),
                    ], ["lang", "words", "phrase", "n", "doc_id", "at"])

    return _slim(docs).mapInArrow(run, "lang string, words int, phrase string, n bigint, doc_id bigint, at bigint")


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, count, doc_id, at) of every run of 1 to `longest` words with `min_count` occurrences,
    with the pointer to one of them (its first word's place in that document), and (lang, n) with all words."""
    with small_batches(docs.sparkSession):
        return _frequent(docs, longest, min_count)


def _frequent(docs: DataFrame, longest: int, min_count: int) -> tuple[DataFrame, DataFrame]:
    known: dict[int, Vocabulary] = {}
    totals = last = None
    for orders in ROUNDS:
        orders = [n for n in orders if n <= longest]
        if not orders or last is not None and not last.size:
            break
        counts = _counted(docs, orders, last)
        if totals is None:
            counts = materialise(counts.filter((F.col("n") >= min_count) | F.col("lang").isNotNull()), "runs")
            totals = counts.filter("fp is null").select("lang", "n")
        frequent = counts.filter((F.col("n") >= min_count) & F.col("fp").isNotNull())
        last = write_vocabulary(frequent.select(F.col("fp").alias("hash")), new_path(docs.sparkSession, "frequent"))
        known |= dict.fromkeys(orders, last)
    exact = (
        _texts(docs, known).groupBy("lang", "words", "phrase")
        .agg(F.sum("n").alias("count"), F.first("doc_id").alias("doc_id"), F.first("at").alias("at"))
        .filter(F.col("count") >= min_count)
    )
    return materialise(exact, "phrases"), totals


def _part(first: Column, size: Column) -> Column:
    return F.array_join(F.slice("_words", first, size), " ")


def collocations(phrases: DataFrame, totals: DataFrame, within: int = WITHIN) -> DataFrame:
    """(lang, phrase, a, l, r, n, score, doc_id, at) of the phrases that no longer one stands for.

    l and r are the counts of the parts at the cut of the least score, floor(1000 a n / (l r)), the first of
    such cuts. `phrases` and `totals` as of `frequent_phrases`; a part of a frequent phrase is frequent.
    """
    own = phrases.filter("words > 1").withColumn("_words", F.split("phrase", " "))
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("_k")
    cuts = own.select("lang", "phrase", "count", "words", "_words", cut)
    cuts = cuts.select(
        "lang", "phrase", "count", "_k", _part(F.lit(1), F.col("_k")).alias("_l"),
        _part(F.col("_k") + 1, F.col("words") - F.col("_k")).alias("_r"))
    side = lambda name, out: phrases.select("lang", F.col("phrase").alias(name), F.col("count").alias(out))
    cuts = cuts.join(side("_l", "l"), ["lang", "_l"]).join(side("_r", "r"), ["lang", "_r"]).join(totals, "lang")
    whole = lambda c: F.col(c).cast("decimal(18,0)")
    # Products of two counts and a thousand stay below 38 digits.
    score = F.expr("cast(1000 as decimal(4,0))").cast("decimal(4,0)") * (whole("count") * whole("n"))
    cuts = cuts.withColumn("_over", score.cast("decimal(38,0)")).withColumn("_under", (whole("l") * whole("r")).cast("decimal(38,0)"))
    cuts = cuts.withColumn("score", F.expr("_over div _under").cast("bigint"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "_k", "l", "r", F.col("count").alias("a"), "n")).alias("_b"))
    best = best.select("lang", "phrase", "_b.a", "_b.l", "_b.r", "_b.n", "_b.score")
    size = F.explode(F.filter(F.sequence(F.lit(2), F.col("words") - 1), lambda s: s < F.col("words"))).alias("_size")
    inner = own.filter("words > 2").select("lang", "count", "words", "_words", size)
    inner = inner.select("lang", "count", "_words", "_size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("_size") + 1)).alias("_at"))
    inner = inner.select("lang", "count", _part(F.col("_at"), F.col("_size")).alias("phrase"))
    longer = inner.groupBy("lang", "phrase").agg((100 * F.max("count")).alias("_longer"))
    kept = best.join(longer, ["lang", "phrase"], "left").filter(F.col("_longer").isNull() | (F.col("_longer") < within * F.col("a")))
    return kept.drop("_longer").join(phrases.select("lang", "phrase", "doc_id", "at"), ["lang", "phrase"])


def mine(docs: DataFrame, top: int = TOP, longest: int = LONGEST, min_count: int = MIN_COUNT, within: int = WITHIN) -> DataFrame:
    """The first `top` collocations of each lang with their rank, by score, count and phrase."""
    found = collocations(*frequent_phrases(docs, longest, min_count), within)
    return top_n(found, ["lang"], [F.col("score").desc(), F.col("a").desc(), F.col("phrase")], top)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(documents(spark, sf_dir)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


OP13_SQL = r"""
WITH cut AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), pieces AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM cut
), totals AS (
    SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang
), grams AS (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, range(1, 6) AS t(k) WHERE len(w) >= k
), phrases AS (
    SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, count(*) AS a
    FROM grams GROUP BY 1, 2, 3 HAVING count(*) >= 100
), split AS (
    SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM phrases WHERE k > 1
), cuts AS (
    SELECT lang, k, phrase, a, w, unnest(range(1, k)) AS j FROM split
), scored AS (
    SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, t.n, c.j,
           (1000::HUGEINT * c.a * t.n) // (x.a::HUGEINT * y.a) AS score
    FROM cuts c
    JOIN phrases x ON x.lang = c.lang AND x.phrase = array_to_string(list_slice(c.w, 1, c.j), ' ')
    JOIN phrases y ON y.lang = c.lang AND y.phrase = array_to_string(list_slice(c.w, c.j + 1, c.k), ' ')
    JOIN totals t ON t.lang = c.lang
), best AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), sizes AS (
    SELECT lang, a, w, k, unnest(range(2, k)) AS s FROM split WHERE k > 2
), places AS (
    SELECT lang, a, w, s, unnest(range(1, k - s + 2)) AS i FROM sizes
), longer AS (
    SELECT lang, array_to_string(list_slice(w, i, i + s - 1), ' ') AS phrase, max(a) AS most FROM places GROUP BY 1, 2
)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.phrase) AS rank,
       b.phrase, b.a::BIGINT AS a, b.l::BIGINT AS l, b.r::BIGINT AS r, b.n::BIGINT AS n, b.score::BIGINT AS score
FROM best b LEFT JOIN longer o ON o.lang = b.lang AND o.phrase = b.phrase
WHERE o.most IS NULL OR 100 * o.most < 100 * b.a
QUALIFY row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.phrase) <= 2000
"""

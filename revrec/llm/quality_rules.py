"""Quality rules: figures of each text, and lines that recur across a host's documents.

Every line is normalised (ends trimmed, lower case, white space to one space) and hashed. A line that
stands in more of a host's distinct documents than the limit allows is removed everywhere on that host;
a document that loses more than half of its words with them is depleted and rejected. The limit is a number
of documents, the same on a host of any size. Distinct documents are those of different text, and near copies
count as one: documents of which such lines make up four fifths (the similarity of near-duplicates) are told
apart by the least digest of those lines only. So the pages of a template go, whose own words make up more
than a fifth, while near copies stay for the near-duplicate stage.

Rules: NULL text has no words and fails the base rule; NULL host is one host with the empty name; only
rows equal in doc_id, text and host share a verdict; an empty table gives no rows. Members of a group of near
copies that differ in c of the shared lines count as c + 1 documents at most, however many they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revrec.llm.texts import documents
from revrec.sources.shared import materialise

SPACES, SPACE_RUN, SYMBOLS = " \t\n\x0b\x0c\r", "[\\x20\\x09-\\x0D]+", "[#*$%&|<>]"
MIN_WORDS, MAX_REPEAT = 50, 50
#: A line may stand in so many distinct documents of a host.
MAX_DOCUMENTS = 10
#: Per cent of a document's words in recurring lines from which on it is a near copy of others with them.
NEAR_COPY = 80
#: Per cent of a document's words that may be removed.
MAX_REMOVED = 50


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def normal_line(line: Column) -> Column:
    return F.regexp_replace(F.lower(F.btrim(line, F.lit(SPACES))), SPACE_RUN, " ")


def _windows(words: Column) -> Column:
    """Digest and place of every window of three words, in order of the digest."""
    def window(i: Column) -> Column:
        return F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i"))

    places = F.when(F.size(words) >= 3, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(F.array().cast("array<int>"))
    return F.sort_array(F.transform(places, window))


def _repeated(windows: Column) -> Column:
    """Places of windows whose digest another place has, ascending."""
    def twin(x: Column, j: Column) -> Column:
        before = F.coalesce(F.get(windows, j - 1)["h"] == x["h"], F.lit(False))
        after = F.coalesce(F.get(windows, j + 1)["h"] == x["h"], F.lit(False))
        return before | after

    return F.sort_array(F.transform(F.filter(windows, twin), lambda x: x["i"]))


def _covered(places: Column) -> Column:
    """Words in the windows at these places, each once."""
    own = F.transform(places, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(places, j + 1) - p, F.lit(3))))
    return F.aggregate(own, F.lit(0).cast("bigint"), lambda total, x: total + x)


def base_figures(docs: DataFrame, text: str = "__r_text") -> DataFrame:
    """Adds `_words` (array) and the struct `_base` with the counts of a text; `text` must not be NULL."""
    lines = F.filter(F.split(F.col(text), "\n"), lambda line: F.length(F.btrim(line, F.lit(SPACES))) > 0)
    out = (
        docs.withColumn("__r_words", words_of(F.col(text)))
        .withColumn("__r_lines", lines)
        .withColumn("__r_windows", _windows(F.col("__r_words")))
        .withColumn("__r_places", _repeated(F.col("__r_windows")))
    )
    counts = {
        "n_words": F.size("__r_words"),
        "word_chars": F.length(F.array_join("__r_words", "")),
        "n_symbols": F.length(text) - F.length(F.regexp_replace(F.col(text), SYMBOLS, "")),
        "n_dup_lines": F.size("__r_lines") - F.size(F.array_distinct("__r_lines")),
        "n_repeat_words": _covered(F.col("__r_places")),
    }
    base = F.struct(*[c.cast("bigint").alias(k) for k, c in counts.items()])
    # Generated, not projected: else a filter on the figures is pushed below and its copy of the
    # expressions works out the whole arrays again for each of their elements.
    kept = [F.col(f"`{c}`") for c in docs.columns]
    return out.select(*kept, F.explode(F.array(base)).alias("__r_base"))


def _keyed(docs: DataFrame, text: str, host: str, key: str) -> DataFrame:
    return docs.withColumns({
        "__r_text": F.coalesce(F.col(text).cast("string"), F.lit("")),
        "__r_host": F.coalesce(F.col(host).cast("string"), F.lit("")),
        "__r_key": F.col(key),
    }).withColumn("__r_hash", F.xxhash64("__r_text"))


def _line_digest(normal: Column) -> Column:
    """60 bits of the MD5, which SQL has as well."""
    return F.conv(F.substring(F.md5(normal.cast("binary")), 1, 15), 16, 10).cast("bigint")


def lines_of(docs: DataFrame) -> DataFrame:
    """All lines with words of keyed documents: place, number of words, digest. Written once, used three times."""
    lines = (
        docs.select("__r_key", "__r_hash", "__r_host", F.posexplode(F.split("__r_text", "\n")).alias("__r_at", "__r_line"))
        .withColumn("__r_normal", normal_line(F.col("__r_line"))).filter("__r_normal <> ''")
        .select("__r_key", "__r_hash", "__r_host", "__r_at", F.size(F.split("__r_normal", " ")).alias("__r_n"), _line_digest(F.col("__r_normal")).alias("__r_lh"))
    )
    return materialise(lines, "lines")


def frequent_lines(lines: DataFrame, max_documents: int = MAX_DOCUMENTS, near_copy: int = NEAR_COPY) -> DataFrame:
    """The (host, line) pairs in more than `max_documents` distinct documents, near copies counted as one."""
    line = ["__r_host", "__r_lh"]
    pairs = lines.select(*line, "__r_hash").distinct()
    above = materialise(pairs.groupBy(*line).agg(F.count("*").alias("__r_c")).filter(F.col("__r_c") > max_documents).select(*line), "above")
    flagged = lines.join(above.withColumn("__r_above", F.lit(True)), line, "left")
    share = flagged.groupBy("__r_host", "__r_hash").agg(
        F.sum("__r_n").alias("__r_words"),
        F.sum(F.when(F.col("__r_above"), F.col("__r_n"))).alias("__r_lost"),
        F.min(F.when(F.col("__r_above"), F.col("__r_lh"))).alias("__r_least"),
    ).filter("__r_lost is not null")
    near = 100 * F.col("__r_lost") >= near_copy * F.col("__r_words")
    context = F.struct(near.alias("near"), F.when(near, F.col("__r_least")).otherwise(F.col("__r_hash")).alias("by"))
    contexts = share.select("__r_host", "__r_hash", context.alias("__r_context"))
    counted = (
        pairs.join(above, line).join(contexts, ["__r_host", "__r_hash"])
        .select(*line, "__r_context").distinct().groupBy(*line).agg(F.count("*").alias("__r_c"))
    )
    return counted.filter(F.col("__r_c") > max_documents).select(*line)


def judge(docs: DataFrame, text: str = "text", host: str = "source", key: str = "doc_id", max_documents: int = MAX_DOCUMENTS,
          max_removed: int = MAX_REMOVED, near_copy: int = NEAR_COPY) -> DataFrame:
    """Rows of `docs` with a struct `_rules`: the figures, n_removed words, the places of removed lines
    (`removed`, ascending), base_failed, depleted and kept."""
    keyed = _keyed(docs, text, host, key)
    lines = lines_of(keyed.select("__r_key", "__r_hash", "__r_host", "__r_text"))
    frequent = frequent_lines(lines, max_documents, near_copy)
    removed = (
        lines.join(frequent, ["__r_host", "__r_lh"])
        .groupBy("__r_key", "__r_hash", "__r_host").agg(F.sort_array(F.collect_set(F.struct("__r_at", "__r_n"))).alias("__r_gone"))
        .select(F.col("__r_key").alias("__r_k"), F.col("__r_hash").alias("__r_h"), F.col("__r_host").alias("__r_o"), "__r_gone")
    )
    figures = base_figures(keyed)
    same = F.col("__r_key").eqNullSafe(F.col("__r_k")) & (F.col("__r_hash") == F.col("__r_h")) & (F.col("__r_host") == F.col("__r_o"))
    gone = F.coalesce("__r_gone", F.array().cast("array<struct<__r_at:int,__r_n:int>>"))
    base = F.col("__r_base")
    n_removed = F.aggregate(gone, F.lit(0).cast("bigint"), lambda total, x: total + x["__r_n"])
    failed = (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEAT * base["n_words"])
    out = figures.join(removed, same, "left").withColumn("__r_lost", n_removed)
    depleted = 100 * F.col("__r_lost") > max_removed * base["n_words"]
    rules = F.struct(
        *[base[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        F.col("__r_lost").alias("n_removed"), F.transform(gone, lambda x: x["__r_at"]).alias("removed"),
        failed.alias("base_failed"), depleted.alias("depleted"), (~failed & ~depleted).alias("kept"),
    )
    return out.withColumn("__r_rules", rules).select(*[F.col(f"`{c}`") for c in docs.columns], "__r_rules")


def without_lines(text: Column, places: Column) -> Column:
    """The text without the lines at these ascending places: the stretches between them, joined."""
    lines = F.split(text, "\n")
    starts = F.concat(F.array(F.lit(-1)), places)
    ends = F.concat(places, F.array(F.size(lines)))
    spans = F.arrays_zip(starts.alias("a"), ends.alias("b"))
    kept = F.flatten(F.transform(spans, lambda s: F.slice(lines, s["a"] + 2, s["b"] - s["a"] - 1)))
    return F.when(F.size(places) == 0, text).otherwise(F.array_join(kept, "\n"))


def clean(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that the rules keep, without their removed lines; the columns of `docs`."""
    judged = judge(docs, text, **options).filter("__r_rules.kept")
    return judged.withColumn(text, without_lines(F.col(text), F.col("__r_rules.removed"))).select(*docs.columns)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(documents(spark, sf_dir).select("doc_id", "text", "source"))
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed")
    return judged.select("doc_id", *[F.col(f"__r_rules.{c}").alias(c) for c in columns])


OP1_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host FROM documents
), words AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM docs
), windows AS (
    SELECT r, i, [ws[i], ws[i + 1], ws[i + 2]] AS win
    FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM words)
), twice AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM windows) WHERE c > 1
), repeats AS (
    SELECT r, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r
), raw_lines AS (
    SELECT r, host, text, unnest(string_split(text, chr(10))) AS line FROM docs
), lines AS (
    SELECT r, host, text, line,
           regexp_replace(lower(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), '[\x20\x09-\x0D]+', ' ', 'g') AS normal
    FROM raw_lines
), dups AS (
    SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines WHERE normal <> '' GROUP BY r
), recurring AS (
    SELECT host, normal FROM lines WHERE normal <> '' GROUP BY host, normal HAVING count(DISTINCT text) > 10
), shares AS (
    SELECT host, text, sum(len(string_split(normal, ' '))) AS n, sum(len(string_split(normal, ' '))) FILTER (WHERE x.normal IS NOT NULL) AS lost,
           min(('0x' || substr(md5(normal), 1, 15))::BIGINT) FILTER (WHERE x.normal IS NOT NULL) AS least
    FROM lines l LEFT JOIN recurring x USING (host, normal) WHERE normal <> '' GROUP BY host, text, r
), contexts AS (
    SELECT DISTINCT host, text, CASE WHEN 100 * lost >= 80 * n THEN 'near ' || least ELSE 'own ' || text END AS context
    FROM shares WHERE lost IS NOT NULL
), frequent AS (
    SELECT host, normal FROM lines JOIN recurring USING (host, normal) JOIN contexts USING (host, text)
    GROUP BY host, normal HAVING count(DISTINCT context) > 10
), gone AS (
    SELECT r, sum(len(string_split(normal, ' '))) AS n_removed FROM lines JOIN frequent USING (host, normal) GROUP BY r
), figures AS (
    SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
           coalesce(n_removed, 0) AS n_removed
    FROM words LEFT JOIN repeats USING (r) LEFT JOIN dups USING (r) LEFT JOIN gone USING (r)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT (100 * n_removed > 50 * n_words) AS kept,
       CAST(n_removed AS BIGINT) AS n_removed
FROM figures
"""

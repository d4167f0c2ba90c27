"""Every operator as a named query over the test tables, with the SQL that must agree with it.

The SQL is written from the definitions (windows over whole groups, self-joins), not from the plans.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revrec.functions.columns import product_url, retrieval_weight, shift_index
from revrec.functions.vectors import concat_vectors, l2_normalise
from revrec.operators import compressed, histograms, joins, keyed, metrics, negatives, ordering, retrieval, statistics, transformation, vocabulary
from revrec.plans import curate as curation
from revrec.plans import ratings as rating_plans
from revrec.plans import recommend as rec
from revrec.schemas import SPLIT, TEST, TRAIN, VALIDATION, xf
from revrec.sources import artifacts, tables, testdata
from revrec.sources.shared import materialise, new_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- common tables of the SQL side ---------------------------------------------------------------

REVISIONS = """revisions AS (
  SELECT l_orderkey * 10 + l_linenumber AS uuid, o_custkey AS customer_id, l_partkey AS tsin_id,
    1 + CAST(l_quantity AS INTEGER) % 5 AS rating,
    'flag "' || l_returnflag || '",' || chr(10) || 'supplier ' || CAST(l_suppkey AS VARCHAR) AS body,
    l_shipdate AS updated_at, CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END AS moderation_state_id,
    l_suppkey, l_extendedprice, l_quantity, l_returnflag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

LATEST = REVISIONS + """, latest AS (
  SELECT uuid AS review_id, rating AS review_rating, body AS review_text, updated_at AS review_timestamp,
    customer_id AS customer_id_pii, tsin_id AS tsin
  FROM revisions
  WHERE moderation_state_id = 0 AND CAST(updated_at AS DATE) BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
  QUALIFY row_number() OVER (PARTITION BY uuid ORDER BY updated_at DESC, tsin_id DESC, l_suppkey DESC,
    l_extendedprice DESC, l_quantity DESC, l_returnflag DESC) = 1)"""

VARIANTS = """variants AS (
  SELECT p_partkey AS tsin, 'PLID' || p_partkey AS product_id, p_name AS product_title, p_brand AS product_brand,
    p_type AS product_department, DATE '2001-01-01' + p_size AS stamp FROM part
  UNION ALL
  SELECT p_partkey, 'PLID' || (p_partkey // 4), min(p_name) OVER (PARTITION BY p_partkey // 4), NULL, NULL,
    DATE '2000-01-01' FROM part)"""

PRODUCTS = VARIANTS + """, products AS (
  SELECT tsin, product_id, product_title, product_brand, product_department FROM (
    SELECT * FROM variants QUALIFY row_number() OVER (PARTITION BY tsin ORDER BY stamp DESC, product_id DESC) = 1)
  WHERE product_department IN ('ECONOMY', 'PROMO', 'STANDARD', 'SMALL'))"""

CURATED = LATEST + ", " + PRODUCTS + """, curated AS (
  SELECT review_id, review_rating, review_text, review_timestamp,
    sha256('pepper|' || CAST(customer_id_pii AS VARCHAR)) AS customer_id,
    product_id, product_title, product_brand, product_department,
    CASE row_number() OVER (PARTITION BY customer_id_pii ORDER BY review_timestamp, review_id) % 10
      WHEN 8 THEN 'validation' WHEN 9 THEN 'test' ELSE 'train' END AS split
  FROM latest JOIN products USING (tsin)
  QUALIFY count(*) OVER (PARTITION BY customer_id_pii) >= 10
    AND row_number() OVER (PARTITION BY customer_id_pii ORDER BY review_timestamp DESC, review_id DESC) <= 20)"""

RATED = """rated AS (
  SELECT product_id, product_title, product_brand, product_department, review_rating_mean, review_rating_count,
    (review_rating_mean * review_rating_count + 5) / (review_rating_count + 2) AS review_rating_expected
  FROM (SELECT 'PLID' || p_partkey AS product_id, p_name AS product_title, p_brand AS product_brand,
      p_type AS product_department FROM part)
  JOIN (SELECT 'PLID' || l_partkey AS product_id, avg(1 + CAST(l_quantity AS INTEGER) % 5) AS review_rating_mean,
      count(*) AS review_rating_count FROM lineitem GROUP BY 1) USING (product_id))"""

RATED_COLUMNS = """product_id, product_title, product_brand, product_department,
  round(review_rating_mean, 6) AS review_rating_mean, review_rating_count,
  round(review_rating_expected, 6) AS review_rating_expected"""

VOCABULARY = """vocabulary AS (
  SELECT {column} AS token, row_number() OVER (ORDER BY count(*) DESC, {column} DESC) - 1 AS index, count(*) AS count
  FROM curated WHERE split IN ('train', 'validation') GROUP BY 1)"""

SCORES = """scores AS (
  SELECT q.vec_id AS query_id, i.vec_id AS item_id, q.label AS query_label, i.label AS item_label,
    round(list_inner_product(CAST(q.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[])), 6) AS score
  FROM embeddings q, embeddings i)"""


def _hash_sql(key: str, seed: int = 0) -> str:
    return f"CAST('0x' || substr(md5('{seed}|' || CAST({key} AS VARCHAR)), 1, 15) AS BIGINT)"


def with_(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


# --- inputs --------------------------------------------------------------------------------------


def _rated(spark, sf):
    return rating_plans.product_ratings(testdata.products(spark, sf), testdata.ratings(spark, sf))


def _show(rated):
    return rounded(rated, "review_rating_mean", "review_rating_expected")


def _latest_reviews(spark, sf):
    return curation.latest_reviews(
        testdata.revisions(spark, sf), testdata.FIRST_DAY, testdata.LAST_DAY, tiebreak=testdata.TIEBREAK
    )


def _curated(spark, sf):
    return curation.curate(
        testdata.revisions(spark, sf), testdata.product_docs(spark, sf), salt=testdata.SALT,
        departments=testdata.DEPARTMENTS, first_day=testdata.FIRST_DAY, last_day=testdata.LAST_DAY,
        tiebreak=testdata.TIEBREAK,
    )


def _stored(spark, sf):
    """For plans that use the curated rows more than once."""
    return materialise(_curated(spark, sf), "curated")


# --- ratings -------------------------------------------------------------------------------------


@query(with_(RATED) + f"SELECT {RATED_COLUMNS} FROM rated ORDER BY round(rated.review_rating_expected, 9) DESC, product_id LIMIT 10")
def top_rated_expected(spark, sf):
    return _show(rating_plans.top_rated(_rated(spark, sf), 10, "expected"))


@query(with_(RATED) + f"SELECT {RATED_COLUMNS} FROM rated ORDER BY round(rated.review_rating_mean, 9) DESC, product_id LIMIT 10")
def top_rated_mean(spark, sf):
    return _show(rating_plans.top_rated(_rated(spark, sf), 10, "mean"))


@query(with_(RATED) + f"""SELECT {RATED_COLUMNS} FROM rated
ORDER BY round(rated.review_rating_mean, 9) DESC, rated.review_rating_count DESC, product_id LIMIT 10""")
def top_rated_tiebreak(spark, sf):
    return _show(rating_plans.top_rated(_rated(spark, sf), 10, "mean_count"))


def _ranked_sql(by: str, measure: str = "round(rated.review_rating_mean, 9) DESC, rated.review_rating_count DESC") -> str:
    return with_(RATED) + f"""SELECT {RATED_COLUMNS},
  row_number() OVER (PARTITION BY {by} ORDER BY {measure}, product_id) AS rank FROM rated QUALIFY rank <= 10"""


@query(_ranked_sql("product_brand"))
def top_rated_by_brand(spark, sf):
    return _show(rating_plans.top_rated_by(_rated(spark, sf), ["product_brand"]))


@query(_ranked_sql("product_department", "round(rated.review_rating_expected, 9) DESC"))
def top_rated_by_department(spark, sf):
    return _show(rating_plans.top_rated_by(_rated(spark, sf), ["product_department"], rank_by="expected"))


@query(with_(RATED) + f"""SELECT {RATED_COLUMNS} FROM rated WHERE product_brand = 'Brand#2'
ORDER BY round(rated.review_rating_mean, 9) DESC, rated.review_rating_count DESC, product_id LIMIT 10""")
def top_rated_one_brand(spark, sf):
    return _show(rating_plans.top_rated_in(_rated(spark, sf), "product_brand", "Brand#2"))


@query(with_(RATED) + f"SELECT {RATED_COLUMNS} FROM rated")
def product_ratings(spark, sf):
    return _show(_rated(spark, sf))


@query("SELECT p_brand AS product_brand, count(*) AS size FROM part GROUP BY 1")
def products_per_brand(spark, sf):
    return keyed.group_sizes(testdata.products(spark, sf), "product_brand")


@query("SELECT p_type AS product_department, count(*) AS size FROM part GROUP BY 1")
def products_per_department(spark, sf):
    return keyed.group_sizes(testdata.products(spark, sf), "product_department")


@query(with_(CURATED) + "SELECT customer_id, count(product_id) AS product_id_count FROM curated GROUP BY 1")
def reviews_per_customer(spark, sf):
    return rating_plans.reviews_per_customer(_curated(spark, sf))


def _histogram_sql(source: str, value: str, low: str, high: str, bins: int, last: str = "", where: str = "") -> str:
    return f"""SELECT bin, {low} + ({high} - {low}) / {bins} * (bin - 1) AS low, {low} + ({high} - {low}) / {bins} * bin AS high,
  count(v) AS count{last}
FROM range(1, {bins} + 1) AS b(bin)
LEFT JOIN (SELECT {value} AS v FROM {source}) ON v BETWEEN {low} AND {high}
  AND bin = least({bins}, 1 + CAST(floor({bins} * (v - {low}) / ({high} - {low})) AS BIGINT)) {where} GROUP BY bin"""


@query("SELECT bin, round(low, 6) AS low, round(high, 6) AS high, count FROM ("
       + _histogram_sql("lineitem", "CAST(1 + CAST(l_quantity AS INTEGER) % 5 AS DOUBLE)", "0.5::DOUBLE", "5.5::DOUBLE", 5) + ")")
def rating_histogram(spark, sf):
    return rounded(histograms.histogram(testdata.ratings(spark, sf), "review_rating", 0.5, 5.5, 5), "low", "high")


@query(with_(CURATED, "per_customer AS (SELECT customer_id, count(product_id) AS n FROM curated GROUP BY 1)")
       + "SELECT bin, round(low, 6) AS low, round(high, 6) AS high, count FROM ("
       + _histogram_sql("per_customer", "CAST(n AS DOUBLE)", "9.5::DOUBLE", "20.5::DOUBLE", 11) + ")")
def customer_count_histogram(spark, sf):
    counts = rating_plans.reviews_per_customer(_curated(spark, sf))
    return rounded(histograms.histogram(counts, "product_id_count", 9.5, 20.5, 11), "low", "high")


@query(with_(RATED, "edges AS (SELECT min(review_rating_count)::DOUBLE AS lo, max(review_rating_count)::DOUBLE AS hi FROM rated)")
       + "SELECT bin, round(low, 6) AS low, round(high, 6) AS high, count, round(CASE WHEN count > 0 THEN log10(count) END, 6) AS log10_count FROM ("
       + _histogram_sql("rated", "review_rating_count::DOUBLE", "(SELECT lo FROM edges)", "(SELECT hi FROM edges)", 10) + ")")
def count_histogram_auto(spark, sf):
    summary = materialise(rating_plans.rating_summary(testdata.ratings(spark, sf)), "summary")
    return rounded(histograms.histogram_auto(summary, rating_plans.COUNT, 10), "low", "high", "log10_count")


@query(with_(RATED, """cells AS (SELECT 'review_rating_mean' AS feature, review_rating_mean AS v FROM rated
  UNION ALL SELECT 'review_rating_expected', review_rating_expected FROM rated)""") + """SELECT g.feature, b.bin, count(v) AS count
FROM (SELECT DISTINCT feature FROM cells) g CROSS JOIN range(1, 6) AS b(bin)
LEFT JOIN cells c ON c.feature = g.feature AND v BETWEEN 0.5 AND 5.5
  AND b.bin = least(5, 1 + CAST(floor(5 * (v - 0.5::DOUBLE) / 5.0::DOUBLE) AS BIGINT)) GROUP BY 1, 2""")
def mean_and_expected_histogram(spark, sf):
    return histograms.bin_counts(
        _rated(spark, sf), [rating_plans.MEAN, rating_plans.EXPECTED], 0.5, 5.5, 5
    )


# --- curation ------------------------------------------------------------------------------------


@query(with_(LATEST) + "SELECT * FROM latest")
def latest_reviews(spark, sf):
    return _latest_reviews(spark, sf)


@query(with_(LATEST) + "SELECT * FROM latest")
def latest_reviews_merged(spark, sf):
    """All revisions in three batches, of which the later ones hold older revisions too."""
    revisions = testdata.revisions(spark, sf)
    state = curation.review_state(new_path(spark, "review-state"), testdata.TIEBREAK)
    for batch in range(3):
        own = revisions.filter(F.pmod(F.xxhash64("uuid", "updated_at"), F.lit(3)) == batch)
        curation.merge_revisions(state, own, testdata.FIRST_DAY, testdata.LAST_DAY)
    return curation.current_reviews(spark, state)


@query(with_(PRODUCTS) + "SELECT * FROM products")
def latest_products(spark, sf):
    return curation.latest_products(testdata.product_docs(spark, sf), testdata.DEPARTMENTS)


@query(with_(VARIANTS) + """SELECT tsin, product_id, product_title, product_brand, product_department,
  CAST(stamp AS TIMESTAMP) AS insert_timestamp FROM variants""")
def explode_variants(spark, sf):
    return curation.variant_documents(testdata.product_docs(spark, sf))


@query(with_(CURATED) + "SELECT * FROM curated")
def curated_reviews(spark, sf):
    return _curated(spark, sf)


@query(with_(CURATED) + "SELECT split, count(*) AS row_count FROM curated GROUP BY 1")
def split_counts(spark, sf):
    return keyed.row_counts(_curated(spark, sf), [SPLIT])


@query(with_(CURATED) + "SELECT * FROM curated WHERE split <> 'test'")
def released_reviews(spark, sf):
    return tables.release(_curated(spark, sf))


@query(with_(LATEST) + """SELECT review_id, customer_id_pii AS customer_id,
  CASE row_number() OVER (PARTITION BY customer_id_pii ORDER BY review_timestamp, review_id) % 10
    WHEN 8 THEN 'validation' WHEN 9 THEN 'test' ELSE 'train' END AS split FROM latest""")
def split_labels(spark, sf):
    reviews = _latest_reviews(spark, sf).withColumnRenamed("customer_id_pii", "customer_id")
    return curation.label_splits(reviews.select("review_id", "customer_id", "review_timestamp")).drop("review_timestamp")


@query(with_(LATEST) + """SELECT review_id, customer_id_pii FROM latest
QUALIFY row_number() OVER (PARTITION BY customer_id_pii ORDER BY review_timestamp DESC, review_id DESC) <= 20""")
def recent_reviews(spark, sf):
    return curation.keep_recent(_latest_reviews(spark, sf), "customer_id_pii").select("review_id", "customer_id_pii")


@query(with_(LATEST) + """SELECT review_id, customer_id_pii FROM latest
QUALIFY count(*) OVER (PARTITION BY customer_id_pii) >= 10""")
def active_reviews(spark, sf):
    return curation.keep_active(_latest_reviews(spark, sf), "customer_id_pii").select("review_id", "customer_id_pii")


@query(with_(CURATED) + "SELECT DISTINCT customer_id FROM curated")
def customers_dim(spark, sf):
    return curation.customers_dimension(_curated(spark, sf))


@query(with_(CURATED) + """SELECT DISTINCT product_id, product_title, product_brand, product_department FROM curated""")
def products_dim(spark, sf):
    return curation.products_dimension(_curated(spark, sf))


@query("""SELECT DISTINCT o_custkey AS customer_id_pii, sha256('pepper|' || CAST(o_custkey AS VARCHAR)) AS customer_id
FROM orders""")
def pseudonyms(spark, sf):
    orders = testdata.table(spark, sf, "orders").withColumnRenamed("o_custkey", "customer_id_pii")
    return joins.pseudonyms(orders, "customer_id_pii", testdata.SALT)


@query(with_(CURATED) + """SELECT review_id, review_rating, review_text, review_timestamp, customer_id, product_id FROM curated""")
def csv_round_trip(spark, sf):
    reviews = curation.reviews_table(_curated(spark, sf))
    path = new_path(spark, "reviews-csv")
    tables.write_csv(reviews, path)
    return tables.read_csv(spark, path, reviews.schema)


@query(with_(CURATED) + "SELECT * FROM curated WHERE split IN ('train', 'validation')")
def split_round_trip(spark, sf):
    curated = _curated(spark, sf)
    path = new_path(spark, "splits-csv")
    tables.write_splits(curated, path)
    return tables.read_splits(spark, path, [TRAIN, VALIDATION], curated.drop(SPLIT).schema)


@query(with_(CURATED) + "SELECT * FROM curated")
def shuffled_reviews(spark, sf):
    return ordering.shuffle_rows(_curated(spark, sf), "review_id")


@query(with_(CURATED) + f"""SELECT review_id,
  (row_number() OVER (ORDER BY {_hash_sql('review_id')}, review_id) - 1) // 1024 AS batch_id FROM curated""")
def review_batches(spark, sf):
    reviews = _curated(spark, sf).select("review_id")
    return ordering.assign_batches(reviews, ordering.shuffle_order("review_id"), negatives.BATCH_SIZE)


@query("SELECT p_partkey, 'single' AS split FROM part")
def hash_split_one_bucket(spark, sf):
    return tables.hash_split(testdata.table(spark, sf, "part").select("p_partkey"), {"single": 1}, ["p_partkey"])


@query(f"""SELECT p_partkey, CASE WHEN {_hash_sql('p_partkey')} % 10 < 8 THEN 'train'
  WHEN {_hash_sql('p_partkey')} % 10 < 9 THEN 'validation' ELSE 'test' END AS split FROM part""")
def hash_split(spark, sf):
    parts = testdata.table(spark, sf, "part").select("p_partkey")
    return tables.hash_split(parts, {TRAIN: 8, VALIDATION: 1, TEST: 1}, ["p_partkey"])


@query("SELECT 'PLID' || p_partkey AS product_id, 'https://shop.example/p/PLID' || p_partkey AS url FROM part")
def product_urls(spark, sf):
    products = testdata.products(spark, sf)
    return products.select("product_id", product_url(F.col("product_id"), "https://shop.example/p/").alias("url"))


@query(f"SELECT c_custkey, c_name FROM customer ORDER BY {_hash_sql('c_custkey', 7)}, c_custkey LIMIT 1")
def sampled_customer(spark, sf):
    return ordering.sample_n(testdata.table(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey", 1, 7)


@query("SELECT p_partkey, p_name FROM part ORDER BY p_name, p_partkey LIMIT 10")
def preview(spark, sf):
    return ordering.head(testdata.table(spark, sf, "part").select("p_partkey", "p_name"), ["p_name", "p_partkey"], 10)


# --- statistics, schema, vocabulary --------------------------------------------------------------


def _numeric_sql(source: str, by: str, feature: str) -> str:
    stats = {
        "num_examples": "count(*)", "num_present": f"count({feature})", "num_missing": f"count(*) - count({feature})",
        "mean": f"avg({feature})", "std_dev": f"stddev_pop({feature})",
        "num_zeros": f"count(*) FILTER (WHERE {feature} = 0)", "min": f"min({feature})",
        "median": f"quantile_disc({feature}, 0.5)", "max": f"max({feature})",
    }
    return " UNION ALL ".join(
        f"SELECT {by}, '{feature}' AS feature, '{s}' AS stat, round(CAST({e} AS DOUBLE), 6) AS value FROM {source} GROUP BY {by}"
        for s, e in stats.items()
    )


def _string_sql(source: str, by: str, features: list[str]) -> str:
    parts = []
    for f in features:
        stats = {
            "num_examples": "count(*)", "num_present": f"count({f})", "num_missing": f"count(*) - count({f})",
            "max_length": f"max(coalesce(length({f}), 0))", "unique": f"count(DISTINCT {f})",
            "avg_length": f"avg(length({f}))",
        }
        parts += [
            f"SELECT {by}, '{f}' AS feature, '{s}' AS stat, round(CAST({e} AS DOUBLE), 6) AS value FROM {source} GROUP BY {by}"
            for s, e in stats.items()
        ]
    return " UNION ALL ".join(parts)


_CURATED_NUMBERS = ["review_id", "review_rating"]
_CURATED_STRINGS = ["review_text", "customer_id", "product_id", "product_title", "product_brand", "product_department"]


@query(with_(CURATED) + " UNION ALL ".join(_numeric_sql("curated", "split", f) for f in _CURATED_NUMBERS))
def feature_stats_numeric(spark, sf):
    return rounded(statistics.numeric_statistics(_stored(spark, sf), [SPLIT], exact=True), "value")


@query(" UNION ALL ".join(_numeric_sql("documents", "lang", f) for f in ("doc_id", "n_chars"))
       + " UNION ALL " + _string_sql("documents", "lang", ["text", "source"]))
def feature_stats_documents(spark, sf):
    documents = testdata.table(spark, sf, "documents")
    return rounded(statistics.profile(documents, "lang", exact=True).statistics, "value")


@query(with_(CURATED) + _string_sql("curated", "split", _CURATED_STRINGS))
def feature_stats_string(spark, sf):
    return rounded(statistics.string_statistics(_curated(spark, sf), [SPLIT]), "value")


def _top_sql(source: str, feature: str, by: str = "") -> str:
    return f"""SELECT {by + ", " if by else ""}'{feature}' AS feature,
  row_number() OVER ({f"PARTITION BY {by} " if by else ""}ORDER BY count(*) DESC, sha256({feature})) AS rank, {feature} AS value,
  count(*) AS count FROM {source} WHERE {feature} IS NOT NULL GROUP BY {by + ", " if by else ""}{feature} QUALIFY rank <= 20"""


@query(" UNION ALL ".join(f"SELECT * FROM ({_top_sql('documents', f)})" for f in ("text", "lang", "source")))
def top_values(spark, sf):
    return statistics.top_values(testdata.table(spark, sf, "documents"))


@query(with_(CURATED) + " UNION ALL ".join(f"SELECT * FROM ({_top_sql('curated', f, 'split')})" for f in _CURATED_STRINGS))
def top_values_by_split(spark, sf):
    return statistics.profile(_stored(spark, sf), SPLIT).top_values


def _histograms_sql(feature: str) -> str:
    return f"""(WITH cells AS (SELECT lang, CAST({feature} AS DOUBLE) AS v FROM documents),
shape AS (SELECT lang, min(v) AS lo, max(v) AS hi, count(*) AS n FROM cells GROUP BY 1),
grid AS (SELECT lang, lo, hi, n, bin FROM shape, range(1, 11) AS b(bin))
SELECT g.lang, '{feature}' AS feature, 'standard' AS kind, g.bin, round(lo + (hi - lo) / 10 * (g.bin - 1), 6) AS low,
  round(lo + (hi - lo) / 10 * g.bin, 6) AS high, CAST(count(v) AS DOUBLE) AS count
FROM grid g LEFT JOIN cells c ON c.lang = g.lang AND g.bin = least(10, 1 + CAST(floor(10 * (v - lo) / (hi - lo)) AS BIGINT))
GROUP BY g.lang, lo, hi, g.bin
UNION ALL
SELECT g.lang, '{feature}', 'quantile', g.bin, sorted[greatest(1, ((g.bin - 1) * n + 9) // 10)], sorted[(g.bin * n + 9) // 10],
  round(n / 10, 6) FROM grid g JOIN (SELECT lang, list(v ORDER BY v) AS sorted FROM cells GROUP BY 1) USING (lang))"""


@query(" UNION ALL ".join(f"SELECT * FROM {_histograms_sql(f)}" for f in ("doc_id", "n_chars")))
def numeric_histograms(spark, sf):
    found = statistics.profile(testdata.table(spark, sf, "documents"), "lang", exact=True).histograms
    return rounded(found, "low", "high", "count").withColumn("bin", F.col("bin").cast("long"))


@query("""SELECT 'doc_id' AS feature, 'bigint' AS type, CASE WHEN count(doc_id) = count(*) THEN 'required' ELSE 'optional' END AS presence,
  CAST(NULL AS VARCHAR) AS domain FROM documents
UNION ALL SELECT 'n_chars', 'bigint', CASE WHEN count(n_chars) = count(*) THEN 'required' ELSE 'optional' END, NULL FROM documents
UNION ALL SELECT 'text', 'string', CASE WHEN count(text) = count(*) THEN 'required' ELSE 'optional' END, NULL FROM documents
UNION ALL SELECT 'lang', 'string', CASE WHEN count(lang) = count(*) THEN 'required' ELSE 'optional' END,
  CASE WHEN count(DISTINCT lang) <= 50 THEN (SELECT string_agg(v, '|' ORDER BY v) FROM (SELECT DISTINCT lang AS v FROM documents)) END FROM documents
UNION ALL SELECT 'source', 'string', CASE WHEN count(source) = count(*) THEN 'required' ELSE 'optional' END,
  CASE WHEN count(DISTINCT source) <= 50 THEN (SELECT string_agg(v, '|' ORDER BY v) FROM (SELECT DISTINCT source AS v FROM documents)) END FROM documents""")
def inferred_schema(spark, sf):
    schema = statistics.infer_schema(testdata.table(spark, sf, "documents"))
    return schema.withColumn("domain", F.array_join("domain", "|"))


def _learned(spark, sf):
    return tables.select_splits(_curated(spark, sf), [TRAIN, VALIDATION])


@query(with_(CURATED, VOCABULARY.format(column="product_id")) + "SELECT * FROM vocabulary", name="vocabulary")
def vocabulary_query(spark, sf):
    return vocabulary.build_vocabulary(_learned(spark, sf), "product_id")


@query(with_(CURATED, VOCABULARY.format(column="customer_id")) + "SELECT count(*) + 1 AS cardinality FROM vocabulary")
def vocabulary_size(spark, sf):
    return vocabulary.vocabulary_size(vocabulary.build_vocabulary(_learned(spark, sf), "customer_id"), 1)


_TRANSFORMED = ", ".join([
    CURATED,
    VOCABULARY.format(column="customer_id").replace("vocabulary AS", "customers AS", 1),
    VOCABULARY.format(column="product_id").replace("vocabulary AS", "items AS", 1),
])


@query("WITH " + _TRANSFORMED + """ SELECT review_id, coalesce(c.index, -1) AS customer_id_xf, coalesce(p.index, -1) AS product_id_xf,
  coalesce(p.index, -1) + 1 AS product_slot, CAST(review_rating >= 4 AS INTEGER)::DOUBLE AS retrieval_sample_weight
FROM curated LEFT JOIN customers c ON c.token = customer_id LEFT JOIN items p ON p.token = product_id""")
def transformed_examples(spark, sf):
    curated = _stored(spark, sf)
    examples = vocabulary.transform(
        curated,
        lambda rows, analysed: vocabulary.preprocess(rows, analysed, keep=["review_id"]),
        analyse=[TRAIN, VALIDATION],
        splits=[TRAIN, VALIDATION, TEST],
    )
    return examples.select(
        "review_id", xf("customer_id"), xf("product_id"), shift_index(F.col(xf("product_id"))).alias("product_slot"),
        F.col("retrieval_sample_weight").cast("double").alias("retrieval_sample_weight"),
    )


_OOV = """(SELECT count(*) FROM {words}) + ('0x' || substr(md5({token}), 1, 15))::BIGINT % {slots}"""


@query("WITH " + _TRANSFORMED + f""" SELECT review_id, coalesce(c.index, {_OOV.format(words="customers", token="customer_id", slots=3)}) AS customer_id_xf,
  coalesce(p.index, {_OOV.format(words="items", token="product_id", slots=3)}) AS product_id_xf,
  CAST(review_rating >= 4 AS INTEGER)::DOUBLE AS retrieval_sample_weight
FROM curated LEFT JOIN customers c ON c.token = customer_id LEFT JOIN items p ON p.token = product_id""")
def transformed_examples_oov(spark, sf):
    examples = vocabulary.transform(
        _stored(spark, sf),
        lambda rows, analysed: vocabulary.preprocess(rows, analysed, keep=["review_id"], oov_buckets=3),
        analyse=[TRAIN, VALIDATION], splits=[TRAIN, VALIDATION, TEST],
    )
    return examples.withColumn("retrieval_sample_weight", F.col("retrieval_sample_weight").cast("double"))


_FITTED = {
    "customer": transformation.Vocabulary("customer_id", oov_buckets=5),
    "product": transformation.Vocabulary("product_id", min_count=2),
    "rating_z": transformation.ZScore("review_rating"),
    "rating_01": transformation.MinMax("review_rating"),
    "review_bucket": transformation.Buckets("review_id", 8),
}


@query("WITH " + _TRANSFORMED + f""", learned AS (SELECT * FROM curated WHERE split IN ('train', 'validation')),
figures AS (SELECT avg(review_rating) AS mean, stddev_pop(review_rating) AS dev, min(review_rating) AS lo, max(review_rating) AS hi,
  list(review_id ORDER BY review_id) AS ids, count(*) AS n FROM learned),
cuts AS (SELECT list(ids[(k * n + 7) // 8]) AS cuts FROM figures, range(1, 8) AS t(k))
SELECT review_id, coalesce(c.index, {_OOV.format(words="customers", token="customer_id", slots=5)}) AS customer,
  CASE WHEN p.count >= 2 THEN p.index ELSE -1 END AS product, round((review_rating - mean) / dev, 6) AS rating_z,
  round((review_rating - lo) / (hi - lo), 6) AS rating_01, len(list_filter(cuts, lambda x: x <= review_id)) AS review_bucket
FROM curated CROSS JOIN figures CROSS JOIN cuts
LEFT JOIN customers c ON c.token = customer_id LEFT JOIN items p ON p.token = product_id WHERE split = 'test'""")
def fitted_transform(spark, sf):
    """Fitted on two splits, written, loaded, and applied to the third, which nobody analysed."""
    curated, path = _stored(spark, sf), new_path(spark, "state")
    transformation.fit(tables.select_splits(curated, [TRAIN, VALIDATION]), _FITTED).write(spark, path)
    found = transformation.load(spark, path).apply(tables.select_splits(curated, [TEST]), keep=["review_id"])
    return rounded(found, "rating_z", "rating_01").withColumn("review_bucket", F.col("review_bucket").cast("long"))


@query("WITH " + _TRANSFORMED + """, examples AS (
  SELECT split, c.index AS customer_id_xf, p.index AS product_id_xf, CAST(review_rating >= 4 AS INTEGER)::DOUBLE AS retrieval_sample_weight
  FROM curated JOIN customers c ON c.token = customer_id JOIN items p ON p.token = product_id WHERE split <> 'test') """
       + " UNION ALL ".join(
           f"""SELECT split, '{f}' AS feature, count(*) AS num_present, min({f})::DOUBLE AS min, max({f})::DOUBLE AS max,
  round(avg({f}), 6) AS mean FROM examples GROUP BY split"""
           for f in ("customer_id_xf", "product_id_xf", "retrieval_sample_weight")))
def feature_stats_transformed(spark, sf):
    examples = vocabulary.transform(
        _stored(spark, sf), lambda rows, analysed: vocabulary.preprocess(rows, analysed, keep=[SPLIT]),
        analyse=[TRAIN, VALIDATION], splits=[TRAIN, VALIDATION],
    )
    path = new_path(spark, "examples")
    tables.write_examples(examples, path, [TRAIN, VALIDATION])
    stats = statistics.numeric_statistics(tables.read_table(spark, path), [SPLIT])
    names = ["num_present", "min", "max", "mean"]
    return (
        stats.groupBy(SPLIT, "feature").pivot("stat", names).agg(F.first("value"))
        .withColumn("num_present", F.col("num_present").cast("long"))
        .withColumn("mean", F.round("mean", 6))
    )


# --- vectors, retrieval, metrics -----------------------------------------------------------------


def _vector_sql(select: str) -> str:
    return f"SELECT vec_id, i - 1 AS position, round({select}, 6) AS value FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"


@query("""SELECT vec_id, i - 1 AS position, round(v[i] / nullif(sqrt(list_inner_product(v, v)), 0), 6) AS value
FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""")
def unit_vectors(spark, sf):
    unit = testdata.vectors(spark, sf).select("vec_id", l2_normalise(F.col("embedding")).alias("v"))
    return _components(unit)


@query("""SELECT vec_id, i - 1 AS position, round(v[i], 6) AS value
FROM (SELECT vec_id, list_concat(CAST(embedding AS DOUBLE[]), [CAST(label AS DOUBLE)]) AS v,
  unnest(range(1, len(embedding) + 2)) AS i FROM embeddings)""", name="concat_vectors")
def concatenated_vectors(spark, sf):
    pair = concat_vectors(F.col("embedding").cast("array<double>"), F.array(F.col("label").cast("double")))
    return _components(testdata.vectors(spark, sf).select("vec_id", pair.alias("v")))


def _components(df):
    return df.select("vec_id", F.posexplode("v").alias("position", "value")).select(
        "vec_id", F.col("position").cast("long").alias("position"), F.round("value", 6).alias("value")
    )


_TOPK_SQL = with_(SCORES) + """SELECT query_id, item_id, score,
  row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM scores QUALIFY rank <= {k}"""


def _top_k(spark, sf, k, **blocks):
    vectors = testdata.vectors(spark, sf)
    return retrieval.top_k(vectors, vectors, k, "vec_id", "vec_id", **blocks)


@query(_TOPK_SQL.format(k=10))
def topk_exact(spark, sf):
    return rounded(_top_k(spark, sf, 10), "score")


@query(_TOPK_SQL.format(k=10))
def topk_blocked(spark, sf):
    return rounded(_top_k(spark, sf, 10, query_block=128, item_block=96), "score")


@query(_TOPK_SQL.format(k=10))
def topk_all_cells(spark, sf):
    """The approximate search is exact once every cell is probed."""
    vectors = testdata.vectors(spark, sf)
    index = retrieval.build_index(vectors, 16, "vec_id", seed=1)
    return rounded(retrieval.approx_top_k(vectors, index, 10, 16, "vec_id", 128, 96), "score")


@query(_TOPK_SQL.format(k=10))
def topk_pruned(spark, sf):
    vectors = testdata.vectors(spark, sf)
    index = retrieval.build_index(vectors, 16, "vec_id", seed=1)
    return rounded(retrieval.pruned_top_k(vectors, index, 10, 2, "vec_id"), "score")


@query(with_(SCORES, """vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
centres AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cell, v AS c FROM vectors ORDER BY vec_id LIMIT 16),
near AS (SELECT vec_id, cell, row_number() OVER (PARTITION BY vec_id ORDER BY list_distance(v, c), cell) AS r FROM vectors, centres),
found AS (SELECT s.query_id, s.item_id FROM near q JOIN near i ON i.cell = q.cell AND i.r = 1 AND q.r <= 8
  JOIN scores s ON s.query_id = q.vec_id AND s.item_id = i.vec_id
  QUALIFY row_number() OVER (PARTITION BY s.query_id ORDER BY s.score DESC, s.item_id) <= 10),
best AS (SELECT query_id, item_id FROM scores QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) <= 10),
pairs AS (SELECT count(*) AS n FROM near q JOIN near i ON i.cell = q.cell AND i.r = 1 AND q.r <= 8)""")
       + """SELECT round((SELECT count(*) FROM best JOIN found USING (query_id, item_id)) / (SELECT count(*) FROM best), 6) AS recall,
  round((SELECT n FROM pairs) / (SELECT count(*) FROM scores), 6) AS pair_share""")
def topk_approx_recall(spark, sf):
    """Recall and cost of half of the cells, around the first vectors as centres, so that SQL can follow."""
    vectors = testdata.vectors(spark, sf)
    first = vectors.orderBy("vec_id").limit(16).select("embedding").collect()
    index = retrieval.index_at(vectors, [[float(x) for x in r["embedding"]] for r in first], "vec_id")
    found = retrieval.approx_top_k(vectors, index, 10, 8, "vec_id")
    share = retrieval.pair_share(vectors, index, 8, "vec_id").scalar()
    return rounded(retrieval.recall(found, _top_k(spark, sf, 10)).withColumn("pair_share", share), "recall", "pair_share")


_WORD = 0.125


@query(with_(SCORES, f"""coded AS (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CASE WHEN x < 0 THEN -{_WORD} ELSE {_WORD} END) AS c
  FROM embeddings),
candidates AS (SELECT q.vec_id AS query_id, i.vec_id AS item_id FROM embeddings q, coded i
  QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_inner_product(CAST(q.embedding AS DOUBLE[]), i.c), 6) DESC, i.vec_id) <= 60)""")
       + """SELECT query_id, item_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank
FROM candidates JOIN scores USING (query_id, item_id) QUALIFY rank <= 10""")
def topk_compressed_fixed(spark, sf):
    """Given codewords, so that SQL can follow: the signs of four components a part, around one centre at zero."""
    vectors = testdata.vectors(spark, sf)
    signs = [[_WORD if n >> k & 1 else -_WORD for k in range(4)] for n in range(16)]
    index = compressed.compress_at(vectors, [[0.0] * 64], [signs] * 16, "vec_id")
    return rounded(compressed.compressed_top_k(vectors, index, 10, 1, 60, "vec_id"), "score")


@query()
def topk_compressed(spark, sf):
    """Learned codewords: recall at 10 of 100 re-ranked candidates, and the bytes read as a share of all vectors'."""
    vectors = testdata.vectors(spark, sf)
    index = compressed.compress(vectors, 4, item_id="vec_id")
    found = compressed.compressed_top_k(vectors, index, 10, 4, 100, "vec_id")
    share = compressed.bytes_share(index, vectors.count(), 100)
    return retrieval.recall(found, _top_k(spark, sf, 10)).withColumn("bytes_share", F.lit(share))


@query(with_(SCORES) + "SELECT query_id, item_id, score FROM scores")
def score_pairs(spark, sf):
    """Every query with every candidate."""
    vectors = testdata.vectors(spark, sf)
    scored = joins.score_pairs(
        None, vectors.withColumnRenamed("vec_id", "query_id"), vectors.withColumnRenamed("vec_id", "item_id")
    )
    return rounded(scored.select("query_id", "item_id", "score"), "score")


def _labelled(spark, sf, k):
    """Labels of the k nearest other vectors, in order, beside every vector's own label."""
    vectors = testdata.vectors(spark, sf)
    labels = vectors.select(F.col("vec_id").alias("item_id"), F.col("label").alias("item_label"))
    near = _top_k(spark, sf, k + 1).filter("item_id <> query_id")
    near = ordering.top_n(near.drop("rank"), ["query_id"], [F.col("score").desc(), "item_id"], k)
    lists = retrieval.recommendation_lists(near.join(labels, "item_id"), "query_id", "item_label", "predictions")
    return vectors.select(F.col("vec_id").alias("query_id"), "label").join(lists, "query_id", "left")


_NEAR = SCORES + """, near AS (SELECT query_id, query_label, item_label,
  row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM scores WHERE item_id <> query_id),
hits AS (SELECT query_id, query_label, coalesce(min(rank) FILTER (WHERE query_label = item_label), 1000000) AS first FROM near GROUP BY 1, 2)"""


@query(with_(_NEAR) + "SELECT query_id, first <= 1 AS hit_1, first <= 10 AS hit_10 FROM hits")
def hit_at_k(spark, sf):
    labelled = _labelled(spark, sf, 10)
    return labelled.select(
        "query_id",
        metrics.hit_at_k(F.col("label"), F.col("predictions"), 1).alias("hit_1"),
        metrics.hit_at_k(F.col("label"), F.col("predictions"), 10).alias("hit_10"),
    )


@query(with_(_NEAR) + """SELECT 'overall' AS slice, unnest(['example_count', 'top_k_accuracy', 'weighted_top_k_accuracy']) AS metric,
  unnest([CAST(count(*) AS DOUBLE), round(avg(CAST(first <= 10 AS INTEGER)), 6),
    round(sum(query_label * CAST(first <= 10 AS INTEGER)) / sum(query_label), 6)]) AS value FROM hits""")
def topk_accuracy(spark, sf):
    label, predictions = F.col("label"), F.col("predictions")
    wanted = {
        "example_count": metrics.example_count(),
        "top_k_accuracy": metrics.top_k_accuracy(label, predictions, 10),
        "weighted_top_k_accuracy": metrics.top_k_accuracy(label, predictions, 10, label.cast("double")),
    }
    return rounded(metrics.metrics_table(_labelled(spark, sf, 10), wanted), "value")


@query(with_(_NEAR) + """SELECT 'overall' AS slice, unnest(['top_10_accuracy', 'top_100_accuracy']) AS metric,
  unnest([round(avg(CAST(first <= 10 AS INTEGER)), 6), round(avg(CAST(first <= 100 AS INTEGER)), 6)]) AS value FROM hits""")
def factorized_topk(spark, sf):
    return rounded(metrics.factorized_top_k(_labelled(spark, sf, 100), "label", "predictions"), "value")


# --- negatives and loss --------------------------------------------------------------------------


@query(with_(CURATED, f"""batches AS (SELECT review_id, product_id,
  (row_number() OVER (ORDER BY {_hash_sql('review_id')}, review_id) - 1) // 1024 AS batch_id FROM curated WHERE split = 'train')""")
       + """SELECT a.review_id, a.product_id, a.batch_id, count(*) FILTER (WHERE a.product_id = b.product_id) - 1 AS accidental_hits,
  count(*) FILTER (WHERE a.product_id <> b.product_id) AS negatives FROM batches a JOIN batches b USING (batch_id) GROUP BY 1, 2, 3""")
def batch_negatives(spark, sf):
    train = tables.select_splits(_curated(spark, sf), [TRAIN]).select("review_id", "product_id")
    return negatives.batch_negatives(train, ordering.shuffle_order("review_id"), "product_id")


def _rows(spark, sf):
    """Vectors as training rows; products repeat, so accidental hits occur."""
    return testdata.vectors(spark, sf).select(
        "vec_id", "embedding", (F.col("vec_id") % 50).alias("product"),
        retrieval_weight(F.col("label")).cast("double").alias("weight"),
    )


_PAIRS = """rows_ AS (SELECT vec_id, vec_id // 64 AS batch_id, vec_id % 50 AS product, CAST(label >= 4 AS INTEGER) AS weight,
  CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
pairs AS (SELECT a.vec_id AS row_id, b.vec_id AS negative_id, a.weight, list_inner_product(a.v, b.v) AS s,
  list_inner_product(a.v, a.v) AS positive FROM rows_ a JOIN rows_ b ON a.batch_id = b.batch_id AND a.product <> b.product),
hard AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY round(s, 6) DESC, negative_id) AS rank FROM pairs QUALIFY rank <= 16)"""


@query(with_(_PAIRS) + "SELECT row_id, negative_id, round(s, 6) AS score, rank FROM hard")
def hard_negatives(spark, sf):
    found = negatives.hard_negatives(
        _rows(spark, sf), ["vec_id"], "vec_id", "product", "embedding", "embedding", n=16, size=64
    )
    return rounded(found, "score")


@query(with_(_PAIRS, """losses AS (SELECT row_id, any_value(weight) AS weight,
  ln(sum(exp(s)) + exp(any_value(positive))) - any_value(positive) AS loss FROM hard GROUP BY row_id)""")
       + "SELECT round(sum(weight * loss), 6) AS retrieval_loss, round(0.5 * sum(weight * loss), 6) AS combined_loss FROM losses")
def retrieval_loss(spark, sf):
    loss = negatives.retrieval_loss(
        _rows(spark, sf), ["vec_id"], "vec_id", "product", "embedding", "embedding", "weight", n=16, size=64
    )
    combined = negatives.combine_losses(F.lit(0.0), F.col("retrieval_loss"), 1.0, 0.5)
    return rounded(loss.withColumn("combined_loss", combined), "retrieval_loss", "combined_loss")


# --- recommendation, evaluation, report ----------------------------------------------------------

# A stand-in for learned recommendations that SQL can follow: the ten best products of the
# department of each customer's newest review.


def _best_of_department(curated, *rank_by):
    """Recommendations of each ranking; ratings and tastes are worked out once for all of them."""
    rated = rating_plans.product_ratings(curation.products_dimension(curated), curated)
    rated = materialise(rated, "rated") if len(rank_by) > 1 else rated
    newest = [F.col("review_timestamp").desc(), F.col("review_id").desc()]
    taste = ordering.top_n(curated, ["customer_id"], newest, 1, "_first").select("customer_id", "product_department")
    taste = materialise(taste, "taste") if len(rank_by) > 1 else taste

    def ranked(by):
        best = materialise(rating_plans.top_rated_by(rated, ["product_department"], 10, by), "best")
        best = best.select("product_department", F.col("product_id").alias("item_id"), "rank")
        return taste.join(best, "product_department").select("customer_id", "item_id", "rank")

    return [ranked(by) for by in rank_by]


_BEST = CURATED + """, summary AS (
  SELECT product_id, any_value(product_title) AS product_title, any_value(product_department) AS product_department,
    avg(review_rating) AS mean, count(*) AS n FROM curated GROUP BY 1),
taste AS (SELECT customer_id, product_department FROM curated
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY review_timestamp DESC, review_id DESC) = 1),
ranked AS (SELECT product_department, product_id, product_title,
    row_number() OVER (PARTITION BY product_department ORDER BY round((mean * n + 5) / (n + 2), 9) DESC, product_id) AS expected_rank,
    row_number() OVER (PARTITION BY product_department ORDER BY round(mean, 9) DESC, n DESC, product_id) AS mean_rank FROM summary),
recs AS (SELECT customer_id, product_id, product_title, expected_rank AS rank FROM taste JOIN ranked USING (product_department) WHERE expected_rank <= 10),
base_recs AS (SELECT customer_id, product_id FROM taste JOIN ranked USING (product_department) WHERE mean_rank <= 10)"""


@query(with_(_BEST) + "SELECT customer_id, string_agg(product_id, ',' ORDER BY rank) AS product_ids FROM recs GROUP BY 1")
def recommendation_lists(spark, sf):
    ranked = _best_of_department(_stored(spark, sf), "expected")[0]
    return retrieval.recommendation_lists(ranked, "customer_id").withColumn("product_ids", F.array_join("product_ids", ","))


@query(with_(_BEST, """history AS (SELECT customer_id, review_rating, product_id, product_title,
  row_number() OVER (PARTITION BY customer_id ORDER BY review_timestamp DESC, review_id DESC) AS position FROM curated)""")
       + """SELECT h.customer_id, h.position, h.review_rating, h.product_id AS reviewed_product_id, h.product_title AS reviewed_product_title,
  r.product_id AS recommended_product_id, r.product_title AS recommended_product_title
FROM history h LEFT JOIN recs r ON r.customer_id = h.customer_id AND r.rank = h.position WHERE h.position <= 20""")
def history_report(spark, sf):
    curated = _stored(spark, sf)
    ranked, = _best_of_department(curated, "expected")
    return rec.history_report(curation.reviews_table(curated), curation.products_dimension(curated), ranked)


_SLICED = """, hits AS (SELECT 'product_department=' || product_department AS slice,
    CAST(EXISTS (SELECT 1 FROM recs r WHERE r.customer_id = c.customer_id AND r.product_id = c.product_id) AS INTEGER) AS new_hit,
    CAST(EXISTS (SELECT 1 FROM base_recs r WHERE r.customer_id = c.customer_id AND r.product_id = c.product_id) AS INTEGER) AS old_hit
  FROM curated c WHERE split = 'validation'),
sliced AS (SELECT slice, 'example_count' AS metric, CAST(count(*) AS DOUBLE) AS value, CAST(count(*) AS DOUBLE) AS baseline FROM hits GROUP BY 1
  UNION ALL SELECT slice, 'top_k_accuracy', avg(new_hit), avg(old_hit) FROM hits GROUP BY 1)"""


@query("WITH " + _BEST + """, hits AS (SELECT CASE WHEN product_brand IN ('Brand#1', 'Brand#2', 'Brand#3') THEN 'product_brand IS NULL'
      ELSE 'product_brand=' || product_brand END || '|product_department=' || product_department AS slice,
    CAST(EXISTS (SELECT 1 FROM recs r WHERE r.customer_id = c.customer_id AND r.product_id = c.product_id) AS INTEGER) AS hit
  FROM curated c WHERE split = 'validation')
SELECT slice, 'example_count' AS metric, CAST(count(*) AS DOUBLE) AS value FROM hits GROUP BY 1
UNION ALL SELECT slice, 'top_k_accuracy', round(avg(hit), 6) FROM hits GROUP BY 1""")
def evaluation_two_slices(spark, sf):
    """Slices by two columns, one of them partly NULL."""
    curated = _stored(spark, sf)
    ranked, = _best_of_department(curated, "expected")
    brand = F.when(~F.col("product_brand").isin("Brand#1", "Brand#2", "Brand#3"), F.col("product_brand"))
    examples = tables.select_splits(curated, [VALIDATION]).withColumn("product_brand", brand)
    return rounded(rec.evaluate(examples, ranked, slices=["product_brand", "product_department"]), "value")


@query("WITH " + _BEST + _SLICED + "SELECT slice, metric, round(value, 6) AS value FROM sliced")
def evaluation(spark, sf):
    curated = _stored(spark, sf)
    ranked, = _best_of_department(curated, "expected")
    examples = tables.select_splits(curated, [VALIDATION])
    return rounded(rec.evaluate(examples, ranked, slices=["product_department"]), "value")


def _checks(spark, sf):
    curated = _stored(spark, sf)
    examples = tables.select_splits(curated, [VALIDATION])
    return [
        rec.evaluate(examples, ranked, slices=["product_department"])
        for ranked in _best_of_department(curated, "expected", "mean_count")
    ]


@query("WITH " + _BEST + _SLICED + """SELECT slice, metric, round(value, 6) AS value, round(baseline, 6) AS baseline,
  round((value - baseline) / nullif(baseline, 0), 6) AS change,
  CASE WHEN metric = 'example_count' THEN value >= 1 ELSE coalesce((value - baseline) / nullif(baseline, 0) > 0, false) END AS ok FROM sliced""")
def metric_checks(spark, sf):
    candidate, baseline = _checks(spark, sf)
    return rounded(metrics.metric_checks(candidate, baseline), "value", "baseline", "change")


@query("WITH " + _BEST + _SLICED + """SELECT slice, bool_and(CASE WHEN metric = 'example_count' THEN value >= 1
  ELSE coalesce((value - baseline) / nullif(baseline, 0) > 0, false) END) AS ok FROM sliced GROUP BY 1""")
def release_gate(spark, sf):
    candidate, baseline = _checks(spark, sf)
    return metrics.gate(candidate, baseline)


@query(with_(CURATED) + "SELECT DISTINCT product_id, product_title, product_brand, product_department FROM curated")
def published_version(spark, sf):
    curated = _stored(spark, sf)
    counted = metrics.metrics_table(curated, {"example_count": metrics.example_count()})
    base = new_path(spark, "published")
    path = artifacts.publish(curation.products_dimension(curated), base, metrics.gate(counted), version=1)
    return tables.read_table(spark, path)


_MANIFEST = """manifest AS (SELECT o_custkey AS participant, 'models/' || o_custkey || '/run-' || o_orderkey
    || CASE WHEN o_orderstatus = 'O' THEN '/metrics.json' ELSE '/saved_model.pb' END AS path,
  datediff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS generation, o_totalprice > 100000 AS ok FROM orders)"""


@query(with_(_MANIFEST) + """SELECT participant, path, generation FROM manifest WHERE path LIKE 'models/%/saved_model.pb'
QUALIFY row_number() OVER (PARTITION BY participant ORDER BY generation DESC, path DESC) = 1""")
def latest_artifact(spark, sf):
    return artifacts.latest_artifact(testdata.manifest(spark, sf), "models/", "*/saved_model.pb", ["participant"])


@query(with_(_MANIFEST) + """SELECT participant, path, generation FROM manifest WHERE ok
QUALIFY row_number() OVER (PARTITION BY participant ORDER BY generation DESC, path DESC) = 1""")
def latest_approved(spark, sf):
    files = materialise(testdata.manifest(spark, sf), "manifest")
    return artifacts.latest_approved(files.drop("ok"), files.select("path", "ok"), ["participant"])


# Every customer and every part takes one of the given vectors; purchases are the labels.


def _fixed(spark, sf):
    vectors = testdata.vectors(spark, sf).select("vec_id", "embedding")
    many = vectors.agg(F.count("*")).scalar()
    vectors = materialise(vectors, "vectors")

    def assigned(name, key, out):
        rows = testdata.table(spark, sf, name).select(F.col(key).alias(out), (F.col(key) % many).alias("vec_id"))
        return rows.join(vectors, "vec_id").select(out, "embedding")

    ranked = rec.recommend(assigned("customer", "c_custkey", "customer_id"), assigned("part", "p_partkey", "product_id"))
    return rounded(ranked, "score")


_FIXED = """n AS (SELECT count(*) AS many FROM embeddings),
sides AS (SELECT q.vec_id AS a, i.vec_id AS b,
  round(list_inner_product(CAST(q.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[])), 6) AS score FROM embeddings q, embeddings i),
fixed AS (SELECT c_custkey AS customer_id, p_partkey AS item_id, score,
  row_number() OVER (PARTITION BY c_custkey ORDER BY score DESC, p_partkey) AS rank
  FROM customer, n, part JOIN sides ON a = c_custkey % many AND b = p_partkey % many QUALIFY rank <= 10)"""


@query(with_(_FIXED) + "SELECT customer_id, item_id, score, rank FROM fixed")
def recommend_fixed(spark, sf):
    return _fixed(spark, sf)


@query(with_(_FIXED) + """SELECT 'overall' AS slice, unnest(['example_count', 'top_k_accuracy']) AS metric,
  unnest([CAST(count(*) AS DOUBLE), round(avg(CAST(f.item_id IS NOT NULL AS INTEGER)), 6)]) AS value
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN fixed f ON f.customer_id = o_custkey AND f.item_id = l_partkey""")
def evaluate_fixed(spark, sf):
    purchases = testdata.revisions(spark, sf).select("customer_id", F.col("tsin_id").alias("product_id"))
    return rounded(rec.evaluate(purchases, _fixed(spark, sf)), "value")


@query("WITH " + _TRANSFORMED + """, n AS (SELECT count(*) AS many FROM embeddings), numbered AS (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS place, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
asking AS (SELECT DISTINCT customer_id, c.index % many AS place FROM curated JOIN customers c ON c.token = customer_id, n),
offered AS (SELECT DISTINCT product_id, p.index % many AS place FROM curated JOIN items p ON p.token = product_id, n),
sides AS (SELECT q.place AS a, i.place AS b, round(list_inner_product(q.v, i.v), 6) AS score FROM numbered q, numbered i)
SELECT customer_id, product_id AS item_id, score, row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, product_id) AS rank
FROM asking x, offered y JOIN sides ON a = x.place AND b = y.place QUALIFY rank <= 10""")
def recommend_by_vocabulary(spark, sf):
    """The whole way from raw ids over vocabularies and given vectors to an index and its answers."""
    curated = _stored(spark, sf)
    analysed = tables.select_splits(curated, [TRAIN, VALIDATION])
    vectors = ordering.ordered_index(testdata.vectors(spark, sf).select("vec_id", "embedding"), ["vec_id"], "place")
    vectors = materialise(vectors, "vectors")
    many = vectors.agg(F.count("*")).scalar()

    def given(column):
        tokens = materialise(vocabulary.build_vocabulary(analysed, column), "vocabulary")
        factors = tokens.select("index", (F.col("index") % many).alias("place")).join(vectors, "place")
        return tokens, factors.select("index", "embedding")

    tokens, factors = given("customer_id")
    asking = materialise(rec.embed(curated, "customer_id", tokens, factors), "customers")
    tokens, factors = given("product_id")
    offered = rec.product_index(curated, factors, tokens)
    ranked = rec.recommend(asking, retrieval.build_index(offered, None, "product_id"))
    return rounded(ranked, "score")


def _trained(spark, sf, learner=None, **settings):
    curated = _stored(spark, sf)
    factors = rec.fit(
        tables.select_splits(curated, [TRAIN]), learner, items=curation.products_dimension(curated),
        queries=curation.customers_dimension(curated), analysed=tables.select_splits(curated, [TRAIN, VALIDATION]), **settings,
    )
    return curated, factors, rec.recommend(factors.customers, factors.index)


# What is learned SQL can't follow; what it must look like, it can: who is covered, with how many
# products, in order, by unit vectors, and over how many examples it is measured.
_LEARNED = """, positive AS (SELECT * FROM curated WHERE split = 'train'{positive}),
offered AS (SELECT least(10, count(DISTINCT product_id)) AS k FROM positive)"""


def _learned_lists(factors, ranked):
    unit = F.abs(F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x * x) - 1) < 1e-4
    units = factors.customers.select("customer_id", unit.alias("unit_vector"))
    sorted_scores = F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: -x["score"])
    lists = ranked.groupBy("customer_id").agg(
        F.count_distinct("item_id").alias("products"), (F.max(F.abs("score")) <= 1 + 1e-5).alias("cosines"),
        (sorted_scores == F.array_sort(sorted_scores)).alias("in_order"),
    )
    return lists.join(units, "customer_id")


_LISTS_SQL = """SELECT DISTINCT customer_id, (SELECT k FROM offered) AS products, true AS cosines, true AS in_order, true AS unit_vector
FROM positive"""


@query("WITH " + CURATED + _LEARNED.format(positive=" AND review_rating >= 4") + _LISTS_SQL)
def als_recommendations(spark, sf):
    _, factors, ranked = _trained(spark, sf, rec.fit_factors)
    return _learned_lists(factors, ranked)


@query("WITH " + CURATED + _LEARNED.format(positive="") + _LISTS_SQL)
def tower_recommendations(spark, sf):
    _, factors, ranked = _trained(spark, sf, epochs=2)
    return _learned_lists(factors, ranked)


def _measured(metrics_):
    """The number of examples, and whether an accuracy was found between none and all."""
    value = F.when(F.col("metric") == "example_count", F.col("value")).otherwise(F.col("value").between(0, 1).cast("double"))
    return metrics_.select("slice", "metric", value.alias("value"))


_MEASURED_SQL = """SELECT 'overall' AS slice, unnest(['example_count', 'top_k_accuracy']) AS metric,
  unnest([CAST(count(*) AS DOUBLE), 1.0]) AS value FROM curated WHERE split = 'test'"""


@query(with_(CURATED) + _MEASURED_SQL)
def als_evaluation(spark, sf):
    curated, _, ranked = _trained(spark, sf, rec.fit_factors)
    return _measured(rec.evaluate(tables.select_splits(curated, [TEST]), ranked))


@query(with_(CURATED) + _MEASURED_SQL)
def tower_evaluation(spark, sf):
    curated, _, ranked = _trained(spark, sf)
    return _measured(rec.evaluate(tables.select_splits(curated, [TEST]), ranked))

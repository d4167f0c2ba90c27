"""From review revisions and nested product documents to a split review dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revrec.functions.columns import date_between, product_key, pseudonym, split_label
from revrec.operators.joins import attach_products
from revrec.operators.keyed import distinct_keys, explode_variants, extract_dimension, having_isin, latest_per_key
from revrec.operators.latest_state import LatestState
from revrec.operators.ordering import rank_within, shuffle_rows, top_n
from revrec.schemas import (
    CUSTOMER_ID,
    PRODUCT_ATTRIBUTES,
    PRODUCT_BRAND,
    PRODUCT_DEPARTMENT,
    PRODUCT_ID,
    PRODUCT_TITLE,
    REVIEW_COLUMNS,
    REVIEW_ID,
    REVIEW_RATING,
    REVIEW_TEXT,
    REVIEW_TIMESTAMP,
    SPLIT,
    SPLIT_COLUMNS,
    TEST,
    TRAIN,
    VALIDATION,
)
from revrec.sources.shared import materialise, scope
from revrec.sources.tables import release, select_splits, write_csv

# Fixed values of the dataset.
ACCEPTED = 0
ACTIVE_REVIEWS = 10
RECENT_REVIEWS = 20
DEPARTMENTS = [
    "Home & Kitchen",
    "Garden, Pool & Patio",
    "Health",
    "Beauty",
    "Computers & Tablets",
    "Office & Stationery",
    "Toys",
    "Fashion",
    "Sport",
    "Cellphones & Wearables",
]
FIRST_DAY, LAST_DAY = "2025-01-01", "2025-06-30"


def latest_reviews(revisions: DataFrame, first_day: str = FIRST_DAY, last_day: str = LAST_DAY,
                   accepted: int = ACCEPTED, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Newest accepted revision in range of every review.

    The filters come before the choice: a review whose newest revision was rejected lives on in an
    older accepted one.
    """
    wanted = _accepted_revisions(revisions, first_day, last_day, accepted, tiebreak)
    return _as_reviews(latest_per_key(wanted, ["uuid"], "updated_at", tiebreak))


def _accepted_revisions(revisions: DataFrame, first_day: str, last_day: str, accepted: int, tiebreak: Sequence[str]) -> DataFrame:
    wanted = revisions.filter(
        (F.col("moderation_state_id") == accepted) & date_between("updated_at", first_day, last_day)
    )
    columns = ["uuid", "customer_id", "tsin_id", "rating", "body", "updated_at", *tiebreak]
    return wanted.select(*dict.fromkeys(columns))


def _as_reviews(latest: DataFrame) -> DataFrame:
    return latest.select(
        F.col("uuid").alias(REVIEW_ID),
        F.col("rating").alias(REVIEW_RATING),
        F.col("body").alias(REVIEW_TEXT),
        F.col("updated_at").alias(REVIEW_TIMESTAMP),
        F.col("customer_id").alias("customer_id_pii"),
        F.col("tsin_id").alias("tsin"),
    )


def review_state(base: str, tiebreak: Sequence[str] = (), buckets: int = 64) -> LatestState:
    """A kept-up state of the newest accepted revisions, for `merge_revisions` and `current_reviews`."""
    return LatestState(base, ("uuid",), "updated_at", tuple(tiebreak), buckets)


def merge_revisions(state: LatestState, revisions: DataFrame, first_day: str = FIRST_DAY, last_day: str = LAST_DAY,
                    accepted: int = ACCEPTED) -> int:
    """Takes a batch of revisions into the state without reading earlier ones again.

    Rejected revisions never enter, so they do not displace an accepted one, whichever came first.
    """
    return state.merge(_accepted_revisions(revisions, first_day, last_day, accepted, state.tiebreak))


def current_reviews(spark: SparkSession, state: LatestState, version: int | None = None) -> DataFrame:
    """`latest_reviews` of all revisions merged so far."""
    return _as_reviews(state.read(spark, version))


def variant_documents(docs: DataFrame) -> DataFrame:
    """One row per variant and product document, with the nested attributes brought up."""
    names = F.col("extended.hierarchy.merchandising.forest.names")
    return explode_variants(docs, "productline.variants", "variant").select(
        F.col("variant.id").alias("tsin"),
        product_key(F.col("productline.id")).alias(PRODUCT_ID),
        F.col("productline.title").alias(PRODUCT_TITLE),
        F.col("productline.attributes.brand").alias(PRODUCT_BRAND),
        F.get(names, F.lit(0)).alias(PRODUCT_DEPARTMENT),
        "insert_timestamp",
    )


def latest_products(docs: DataFrame, departments: Sequence[str] = DEPARTMENTS) -> DataFrame:
    """Newest document of every variant; the department list applies to the newest department."""
    latest = latest_per_key(variant_documents(docs), ["tsin"], "insert_timestamp", [PRODUCT_ID])
    return having_isin(latest, PRODUCT_DEPARTMENT, departments).drop("insert_timestamp")


def label_splits(reviews: DataFrame, by: str = CUSTOMER_ID) -> DataFrame:
    """Split label for every review from its position in its customer's history."""
    ranked = rank_within(reviews, [by], [REVIEW_TIMESTAMP, REVIEW_ID], "_rank")
    return ranked.withColumn(SPLIT, split_label(F.col("_rank"))).drop("_rank")


def keep_active(reviews: DataFrame, by: str = CUSTOMER_ID, n: int = ACTIVE_REVIEWS) -> DataFrame:
    """Reviews of customers with at least n."""
    active = materialise(_active(reviews, by, n).select(by), "active")
    return reviews.join(active, by, "left_semi")


def keep_recent(reviews: DataFrame, by: str = CUSTOMER_ID, n: int = RECENT_REVIEWS) -> DataFrame:
    """The n newest reviews of every customer."""
    return top_n(reviews, [by], _newest_first(), n, "_age").drop("_age")


def _active(reviews: DataFrame, by: str, n: int) -> DataFrame:
    return reviews.groupBy(by).agg(F.count("*").alias("_total")).filter(F.col("_total") >= n)


def _newest_first():
    return [F.col(REVIEW_TIMESTAMP).desc(), F.col(REVIEW_ID).desc()]


def split_recent(reviews: DataFrame, by: str = CUSTOMER_ID, active: int = ACTIVE_REVIEWS,
                 recent: int = RECENT_REVIEWS) -> DataFrame:
    """The newest reviews of active customers, labelled by their position in the whole history.

    Counting back from the customer's total gives that position, so no task ever has to sort a whole
    history: a very busy customer is counted by partial sums, and cut to its newest reviews before
    the exchange.
    """
    newest = top_n(reviews, [by], _newest_first(), recent, "_age")
    position = F.col("_total") - F.col("_age") + 1
    return (
        newest.join(_active(reviews, by, active), by)
        .withColumn(SPLIT, split_label(position))
        .drop("_total", "_age")
    )


def curate(revisions: DataFrame, docs: DataFrame, *, salt: str, departments: Sequence[str] = DEPARTMENTS,
           first_day: str = FIRST_DAY, last_day: str = LAST_DAY, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The review dataset with its split column."""
    reviews = latest_reviews(revisions, first_day, last_day, tiebreak=tiebreak)
    products = materialise(latest_products(docs, departments), "products")
    joined = attach_products(reviews.filter("customer_id_pii is not null"), products)
    # Grouped by the short raw key; only kept rows get the long digest.
    return split_recent(joined, "customer_id_pii").withColumn(
        CUSTOMER_ID, pseudonym(F.col("customer_id_pii"), salt)
    ).select(*SPLIT_COLUMNS, SPLIT)


def customers_dimension(curated: DataFrame) -> DataFrame:
    return distinct_keys(curated, [CUSTOMER_ID])


def products_dimension(curated: DataFrame) -> DataFrame:
    """Products of all splits, the test split included."""
    return extract_dimension(curated, PRODUCT_ID, PRODUCT_ATTRIBUTES, REVIEW_TIMESTAMP, [REVIEW_ID])


def reviews_table(curated: DataFrame) -> DataFrame:
    return curated.select(*REVIEW_COLUMNS)


def build_dataset(curated: DataFrame, base: str, seed: int = 0) -> DataFrame:
    """Write customers, products, reviews and one file set per split as CSV; returns row counts.

    The curated rows are written to the shared folder once, and every output reads those.
    """
    with scope(curated.sparkSession, keep=("row-counts",)):
        stored = materialise(curated, "curated", [SPLIT])
        for split in (TRAIN, VALIDATION, TEST):
            rows = select_splits(stored, [split]).drop(SPLIT)
            write_csv(shuffle_rows(rows, REVIEW_ID, seed), f"{base}/reviews/{split}.csv")
        write_csv(customers_dimension(stored), f"{base}/customers.csv")
        write_csv(products_dimension(stored), f"{base}/products.csv")
        write_csv(shuffle_rows(reviews_table(stored), REVIEW_ID, seed), f"{base}/reviews.csv")
        return materialise(stored.groupBy(SPLIT).agg(F.count("*").alias("row_count")), "row-counts")


def release_dataset(curated: DataFrame, base: str, withhold: Sequence[str] = (TEST,)) -> None:
    """Publish the tables for participants: everything but the withheld splits' files."""
    with scope(curated.sparkSession):
        stored = materialise(curated, "curated", [SPLIT])
        write_csv(customers_dimension(stored), f"{base}/customers.csv")
        write_csv(products_dimension(stored), f"{base}/products.csv")
        write_csv(reviews_table(stored), f"{base}/reviews.csv")
        shown = release(stored, withhold)
        for split in (TRAIN, VALIDATION, TEST):
            if split not in withhold:
                write_csv(select_splits(shown, [split]).drop(SPLIT), f"{base}/reviews/{split}.csv")

"""Joins of reviews, products and recommendations.

No side is marked for broadcast: Spark broadcasts a table whose size it knows to be small, and
otherwise splits the shuffle partitions of frequent keys. Both need a table on the looked-up side; a
side that is itself an aggregate on the join key has neither a known size nor an exchange to split,
so the plans write such a side first (`sources.shared.materialise`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revrec.functions.columns import pseudonym
from revrec.functions.vectors import dot
from revrec.operators.ordering import Order, top_n
from revrec.operators.retrieval import all_scores
from revrec.schemas import CUSTOMER_ID, PRODUCT_ID, PRODUCT_TITLE


def pseudonyms(reviews: DataFrame, key: str, salt: str) -> DataFrame:
    """Mapping of every distinct key to its pseudonym."""
    return (
        reviews.filter(F.col(key).isNotNull()).select(key).distinct()
        .withColumn(CUSTOMER_ID, pseudonym(F.col(key), salt))
    )


def attach_pseudonym(reviews: DataFrame, key: str, salt: str) -> DataFrame:
    """Same rows as the inner join with `pseudonyms`: the digest needs no lookup."""
    return reviews.filter(F.col(key).isNotNull()).withColumn(CUSTOMER_ID, pseudonym(F.col(key), salt)).drop(key)


def attach_products(reviews: DataFrame, products: DataFrame, on: str = "tsin") -> DataFrame:
    """Inner join: reviews of unknown or filtered-out products go."""
    return reviews.join(products, on)


def review_history(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """Reviews with their product titles."""
    return reviews.join(products.select(PRODUCT_ID, PRODUCT_TITLE), PRODUCT_ID)


def label_recommendations(ranked: DataFrame, products: DataFrame, item_id: str = "item_id") -> DataFrame:
    """Titles beside recommended ids; the rank is kept."""
    titles = products.select(F.col(PRODUCT_ID).alias(item_id), PRODUCT_TITLE)
    return ranked.join(titles, item_id)


def side_by_side(left: DataFrame, right: DataFrame, by: str, left_order: Order, right_order: Order, n: int = 20) -> DataFrame:
    """Row i of the left beside row i of the right, per key, for the first n rows of the left."""
    left = top_n(left, [by], left_order, n, "position")
    right = top_n(right, [by], right_order, n, "position")
    return left.join(right, [by, "position"], "left")


def score_pairs(pairs: DataFrame | None, queries: DataFrame, items: DataFrame) -> DataFrame:
    """Inner product for given (query_id, item_id) pairs, or with None of every query with every item.

    The best of all pairs by rank are `retrieval.top_k`.
    """
    if pairs is None:
        return all_scores(queries, items)
    q = queries.select("query_id", F.col("embedding").alias("_query"))
    i = items.select("item_id", F.col("embedding").alias("_item"))
    return (
        pairs.join(q, "query_id").join(i, "item_id")
        .withColumn("score", dot(F.col("_query"), F.col("_item")))
        .drop("_query", "_item")
    )

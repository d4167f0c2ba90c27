"""Rating analytics and "top rated" lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revrec.functions.columns import expected_rating, nan_to_null
from revrec.operators.ordering import top_n
from revrec.schemas import CUSTOMER_ID, PRODUCT_ID, REVIEW_RATING

MEAN, COUNT, EXPECTED = "review_rating_mean", "review_rating_count", "review_rating_expected"

# Sort keys of the three rankings, all descending.
RANKINGS = {
    "mean": (MEAN,),
    "mean_count": (MEAN, COUNT),
    "expected": (EXPECTED,),
}
# Means are compared after rounding, so that the order does not hang on the order of summation.
_DIGITS = 9


def rating_summary(reviews: DataFrame) -> DataFrame:
    """Mean and number of ratings per product; a popular product is summed up map-side."""
    rating = nan_to_null(F.col(REVIEW_RATING))
    return reviews.groupBy(PRODUCT_ID).agg(F.avg(rating).alias(MEAN), F.count(rating).alias(COUNT))


def product_ratings(products: DataFrame, reviews: DataFrame) -> DataFrame:
    """Products with their mean, number of ratings and expected rating; unreviewed ones vanish."""
    return products.join(rating_summary(reviews), PRODUCT_ID).withColumn(
        EXPECTED, expected_rating(F.col(MEAN), F.col(COUNT))
    )


def _order(rank_by: str) -> list[Column]:
    keys = [F.round(c, _DIGITS).desc() for c in RANKINGS[rank_by]]
    return [*keys, F.col(PRODUCT_ID).asc()]


def top_rated(rated: DataFrame, n: int = 10, rank_by: str = "mean") -> DataFrame:
    """The n best products overall."""
    return rated.orderBy(*_order(rank_by)).limit(n)


def top_rated_by(rated: DataFrame, by: Sequence[str], n: int = 10, rank_by: str = "mean_count") -> DataFrame:
    """The n best products of every brand or department, with their rank."""
    return top_n(rated, by, _order(rank_by), n)


def top_rated_in(rated: DataFrame, column: str, value: str, n: int = 10, rank_by: str = "mean_count") -> DataFrame:
    """The n best products of one brand or department."""
    return top_rated(rated.filter(F.col(column) == value), n, rank_by)


def reviews_per_customer(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy(CUSTOMER_ID).agg(F.count(PRODUCT_ID).alias("product_id_count"))

"""Column expressions; every one stays inside the JVM."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from revrec.schemas import TEST, TRAIN, VALIDATION

# The star scale, the lowest rating that counts as positive, the product id prefix.
MAX_RATING = 5
POSITIVE_RATING = 4
PRODUCT_PREFIX = "PLID"


def expected_rating(mean: Column, count: Column, max_rating: int = MAX_RATING) -> Column:
    """Rule of succession: one extra best and one extra zero rating; the divisor is at least 2."""
    return (mean * count + F.lit(max_rating)) / (count + F.lit(2))


def retrieval_weight(rating: Column, threshold: int = POSITIVE_RATING) -> Column:
    """1.0 for a positive rating, 0.0 for a lower one, NULL for none."""
    return (rating >= F.lit(threshold)).cast("float")


def product_key(line_id: Column, prefix: str = PRODUCT_PREFIX) -> Column:
    return F.concat(F.lit(prefix), line_id.cast("string"))


def product_url(product_id: Column, base: str) -> Column:
    return F.concat(F.lit(base), product_id)


def pseudonym(key: Column, salt: str) -> Column:
    """Keyed digest: the same on every run and partitioning, so no mapping join is needed."""
    return F.sha2(F.concat(F.lit(salt + "|"), key.cast("string")), 256)


def stable_hash(*cols: Column, seed: int = 0) -> Column:
    """Non-negative 60-bit number from md5, reproducible in any engine."""
    text = F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def date_between(column: str | Column, first: str, last: str) -> Column:
    """Inclusive range of days, written on the bare column so that it reaches the scan."""
    column = F.col(column) if isinstance(column, str) else column
    after = date.fromisoformat(last) + timedelta(days=1)
    return (column >= F.lit(first)) & (column < F.lit(after.isoformat()))


def split_label(rank: Column, n: int = 10, validation: int = 8, test: int = 9) -> Column:
    """Split from the 1-based position of a review in its customer's history."""
    slot = rank % F.lit(n)
    return (
        F.when(slot == validation, VALIDATION).when(slot == test, TEST).otherwise(TRAIN)
    )


def shift_index(index: Column) -> Column:
    """Move vocabulary indices up by one, so that unknown (-1) becomes slot 0."""
    return index + F.lit(1)


def nan_to_null(column: Column) -> Column:
    """Averages and counts then skip missing numbers of either kind."""
    return F.when(~F.isnan(column), column)

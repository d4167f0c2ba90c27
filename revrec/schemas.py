"""Column names and explicit schemas of the known tables."""

from __future__ import annotations

from pyspark.sql import types as T

CUSTOMER_ID = "customer_id"
PRODUCT_ID = "product_id"
PRODUCT_TITLE = "product_title"
PRODUCT_BRAND = "product_brand"
PRODUCT_DEPARTMENT = "product_department"
REVIEW_ID = "review_id"
REVIEW_RATING = "review_rating"
REVIEW_TEXT = "review_text"
REVIEW_TIMESTAMP = "review_timestamp"
RETRIEVAL_SAMPLE_WEIGHT = "retrieval_sample_weight"
SPLIT = "split"

TRAIN, VALIDATION, TEST = "train", "validation", "test"

PRODUCT_ATTRIBUTES = [PRODUCT_TITLE, PRODUCT_BRAND, PRODUCT_DEPARTMENT]
REVIEW_COLUMNS = [REVIEW_ID, REVIEW_RATING, REVIEW_TEXT, REVIEW_TIMESTAMP, CUSTOMER_ID, PRODUCT_ID]
SPLIT_COLUMNS = [*REVIEW_COLUMNS, *PRODUCT_ATTRIBUTES]


def xf(name: str) -> str:
    """Name of the transformed form of a feature."""
    return f"{name}_xf"


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


REVISIONS = _struct(
    uuid=T.StringType(),
    customer_id=T.LongType(),
    tsin_id=T.LongType(),
    rating=T.IntegerType(),
    body=T.StringType(),
    updated_at=T.TimestampType(),
    moderation_state_id=T.IntegerType(),
)

PRODUCT_DOCS = _struct(
    productline=_struct(
        id=T.LongType(),
        title=T.StringType(),
        attributes=_struct(brand=T.StringType()),
        variants=T.ArrayType(_struct(id=T.LongType())),
    ),
    extended=_struct(
        hierarchy=_struct(
            merchandising=_struct(forest=_struct(names=T.ArrayType(T.StringType())))
        )
    ),
    insert_timestamp=T.TimestampType(),
)

CUSTOMERS = _struct(customer_id=T.StringType())

PRODUCTS = _struct(
    product_id=T.StringType(),
    product_title=T.StringType(),
    product_brand=T.StringType(),
    product_department=T.StringType(),
)

REVIEWS = _struct(
    review_id=T.StringType(),
    review_rating=T.IntegerType(),
    review_text=T.StringType(),
    review_timestamp=T.TimestampType(),
    customer_id=T.StringType(),
    product_id=T.StringType(),
)

SPLIT_REVIEWS = T.StructType(REVIEWS.fields + PRODUCTS.fields[1:])

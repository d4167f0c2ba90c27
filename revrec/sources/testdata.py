"""The library's inputs, derived from the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revrec.functions.columns import product_key
from revrec.sources.tables import read_table

# Fixed values of the derived dataset.
DEPARTMENTS = ["ECONOMY", "PROMO", "STANDARD", "SMALL"]
FIRST_DAY, LAST_DAY = "1996-01-01", "2000-12-31"
SALT = "pepper"
TIEBREAK = ["tsin_id", "l_suppkey", "l_extendedprice", "l_quantity", "l_returnflag"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def _rating():
    return F.lit(1) + F.col("l_quantity").cast("int") % 5


def revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as review revisions: keys repeat, and a line status stands for moderation."""
    body = F.concat(
        F.lit('flag "'), F.col("l_returnflag"), F.lit('",\nsupplier '), F.col("l_suppkey").cast("string")
    )
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("uuid"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("tsin_id"),
        _rating().alias("rating"),
        body.alias("body"),
        F.col("l_shipdate").alias("updated_at"),
        F.when(F.col("l_linestatus") == "F", 0).otherwise(1).alias("moderation_state_id"),
        "l_suppkey",
        "l_extendedprice",
        "l_quantity",
        "l_returnflag",
    )


def product_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested product documents: the current one of every part, and an older one for every four
    parts together, without brand and department."""
    part = table(spark, sf_dir, "part")

    def document(line, title, brand, variants, names, stamp):
        attributes = F.struct(brand.alias("brand"))
        productline = F.struct(
            line.alias("id"), title.alias("title"), attributes.alias("attributes"), variants.alias("variants")
        )
        forest = F.struct(names.alias("names"))
        merchandising = F.struct(forest.alias("forest"))
        hierarchy = F.struct(merchandising.alias("merchandising"))
        return [
            productline.alias("productline"),
            F.struct(hierarchy.alias("hierarchy")).alias("extended"),
            stamp.cast("timestamp_ntz").alias("insert_timestamp"),
        ]

    current = part.select(
        *document(
            F.col("p_partkey"), F.col("p_name"), F.col("p_brand"),
            F.array(F.struct(F.col("p_partkey").alias("id"))), F.array("p_type", "p_name"),
            F.date_add(F.lit("2001-01-01").cast("date"), F.col("p_size")),
        )
    )
    older = (
        part.groupBy(F.floor(F.col("p_partkey") / 4).alias("line"))
        .agg(F.min("p_name").alias("title"), F.collect_list(F.struct(F.col("p_partkey").alias("id"))).alias("ids"))
        .select(
            *document(
                F.col("line"), F.col("title"), F.lit(None).cast("string"), F.col("ids"),
                F.array().cast("array<string>"), F.lit("2000-01-01").cast("date"),
            )
        )
    )
    return current.unionByName(older)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        product_key(F.col("p_partkey")).alias("product_id"),
        F.col("p_name").alias("product_title"),
        F.col("p_brand").alias("product_brand"),
        F.col("p_type").alias("product_department"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line as a rating of its product."""
    return table(spark, sf_dir, "lineitem").select(
        product_key(F.col("l_partkey")).alias("product_id"), _rating().alias("review_rating")
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as files that participants (customers) left behind."""
    name = F.when(F.col("o_orderstatus") == "O", "/metrics.json").otherwise("/saved_model.pb")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("participant"),
        F.concat(F.lit("models/"), F.col("o_custkey").cast("string"), F.lit("/run-"),
                 F.col("o_orderkey").cast("string"), name).alias("path"),
        F.datediff(F.col("o_orderdate").cast("date"), F.lit("1990-01-01").cast("date")).cast("long").alias("generation"),
        (F.col("o_totalprice") > 100000).alias("ok"),
    )

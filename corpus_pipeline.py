"""The documents pipeline: stages in order, each over the Parquet that the one before it wrote.

Every stage but the last returns the columns of its input, whatever they are. Empty tables pass through
as empty ones; NULLs and repeated rows are treated as the stage's operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revrec.llm import packing, quality_model, quality_rules, simhash
from revrec.sources.shared import materialise


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines above the limits leave the others, and n_chars follows the text."""
    kept = quality_rules.clean(docs)
    if "n_chars" not in docs.columns:
        return kept
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return kept.withColumn("n_chars", F.when(F.col("n_chars").isNull(), F.col("n_chars")).otherwise(length))


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the threshold go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality_model.keep_good(docs, labels)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return simhash.keep_one(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of the documents with their sequences."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("simhash_near_dedup", simhash_stage),
    ("best_fit_packing", packing_stage),
]

# The classifier and the tokenizer have no SQL; tests/llm/test_pipeline.py holds the stages to plain ones.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *before, (_, last) = STAGES
    for name, stage in before:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)

"""Documents to packed token sequences, stage by stage.

Every stage is a function of (spark, docs, sf_dir). Its result is written as Parquet in the shared folder and read again as the next stage's docs, so a lost
executor costs at most one stage's tasks. Nulls, empty texts, ties and repeated rows are handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterlake.llm import disclosure, exact_dedup, ftrl, order_minhash, packing
from meterlake.llm.common import table, written
from meterlake.llm.queries import BYTES


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier accepts; it learns from the labels and the given documents."""
    return ftrl.accepted(docs, ftrl.fit(docs, table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the smallest id."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicate texts, the one with the smallest id."""
    return order_minhash.deduplicate(docs)


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and terms that disclose it replaced; n_chars follows the text."""
    from pyspark.sql import functions as F

    out = disclosure.sanitised(docs)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: one row for each piece with its place."""
    return packing.op10_columns(packing.packed(docs, BYTES))


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("personal_data", personal), ("packing", pack)]

ORACLE_SQL = None  # a trained classifier, sketches and a tokenizer: tests/llm holds run() against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

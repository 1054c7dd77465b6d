"""Exact deduplication by two passes over a Bloom filter; DataFrame functions only.

First pass: every text's hash marks two slots of a filter of ``slots`` bits. Slots are counted (partial counts before the shuffle), and
those marked at least twice become the bits of a bitmap of fixed size. Second pass: a row whose slots are not all
set has no copy and passes straight through; only the others shuffle, as hash and id without their text, to be grouped exactly. A
fuller filter lets more rows through to the exact grouping, it never loses one.

Texts are equal when identical after each run of ASCII white space became one space; null counts as empty. Of equal
texts the smallest id stays; a null id stays only if all are null. Rows equal in text and id are one document: each row is reported with the same
verdict, and ``deduplicate`` returns one of them. Extra columns of any name are carried by ``deduplicate`` and ignored otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.bitmaps import SLOTS, filter_of, looked_up, tested
from meterlake.llm.common import kept, squeezed, table, written

def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_sha256, keep_id, group_size, kept."""
    keyed = written(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.sha2(squeezed(text_col).cast("binary"), 256)).alias("key")), "text_keys")
    rows = tested(keyed, "key", filter_of(keyed, "key", least=2, slots=slots), slots)
    groups = rows.where("maybe").groupBy("key").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = kept(groups.where("group_size > 1"))
    alone = [F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size")]
    straight = rows.where(~F.col("maybe")).select("doc_id", "key", *alone)
    checked = rows.where("maybe").select("doc_id", "key").join(groups, "key", "left")
    settled = checked.select("doc_id", "key", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"))
    return straight.unionByName(settled).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("key")).alias("text_sha256"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are. Rows without a copy don't shuffle."""
    marks = copies(docs, id_col, text_col, slots).where("group_size > 1")
    groups = kept(marks.groupBy(F.unhex("text_sha256").alias("__key")).agg(F.min("keep_id").alias("__keep"), F.lit(True).alias("__found")))
    own = [f"c_{i}" for i in range(len(docs.columns))]
    keyed = docs.toDF(*own)
    keyed = keyed.withColumn("__key", F.unhex(F.sha2(squeezed(own[docs.columns.index(text_col)]).cast("binary"), 256)))
    out = looked_up(keyed, "__key", groups, slots)
    alone = out.where(F.col("__found").isNull())
    heads = out.where(F.col("__found") & F.col(own[docs.columns.index(id_col)]).cast("long").eqNullSafe(F.col("__keep"))).dropDuplicates(["__key"])  # rows may be equal in text and id
    return alone.select(*own).unionAll(heads.select(*own)).toDF(*docs.columns)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
     g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
"""

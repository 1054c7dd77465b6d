"""What several operators of this package share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.session import scratch_path, shared_dir

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
pa.set_memory_pool(pa.system_memory_pool())  # workers live on after a task and should give memory back

SPACE = r"[\x20\x09-\x0D]+"
SLICE_CHARS = 2_000_000  # text handled at once inside a task


def full_text(column: str | Column = "text") -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def squeezed(column: str | Column = "text") -> Column:
    """The text with each run of ASCII white space replaced by one space."""
    return F.regexp_replace(full_text(column), SPACE, " ")


def kept(df: DataFrame) -> DataFrame:
    """The frame computed once, in the folder all executors share; later reads don't recompute it."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def give_back() -> None:
    """Free memory that this worker still holds goes back to the machine; workers of other stages run beside it."""
    pa.default_memory_pool().release_unused()


def slices(batches: Iterable[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The batches cut so that one slice holds about SLICE_CHARS of text, or one longer row."""
    for batch in batches:
        start, size = 0, 0
        sizes = pc.binary_length(batch.column(text)).fill_null(0).to_pylist()
        for i, n in enumerate(sizes):
            if size and size + n > SLICE_CHARS:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)
    give_back()


def map_text(df: DataFrame, text: str, schema: pa.Schema, make: Callable[[], Callable[[pa.RecordBatch, list[str]], dict]]) -> DataFrame:
    """Rows by a task-local function of (slice, its texts) that returns the columns of ``schema``.

    ``make`` runs once in each task, for what a task prepares (a tokenizer, a compiled pattern).
    """
    from pyspark.sql.pandas.types import from_arrow_schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for part in slices(batches, text):
            yield pa.RecordBatch.from_pydict(work(part, [x or "" for x in part.column(text).to_pylist()]), schema=schema)

    return df.mapInArrow(run, from_arrow_schema(schema))


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """Rows no model is fitted on: crc32 of the id as text is a multiple of ``folds``. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """At most ``max_rows`` labelled texts outside the held-out fold, as (order, text, label) in one partition.

    The bound is the caller's documented parameter. Rows are drawn by a hash of their id, so the draw is the same in every run.
    A document labelled twice counts with its smaller label; null labels, ids and texts are left out.
    """
    drawn = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
        .withColumn("order", F.xxhash64("doc_id")).orderBy("order", "doc_id").limit(max_rows)
    )
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    return (
        texts.join(F.broadcast(drawn), "doc_id")  # at most max_rows short rows
        .select("order", "text", "label").repartition(1).sortWithinPartitions("order", "text")
    )

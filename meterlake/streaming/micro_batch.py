"""The medallion micro-batch: one validated batch fans out to six tables, safely under retries."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from functools import partial
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterlake import schemas
from meterlake.functions import now
from meterlake.operators.aggregates import hourly_region
from meterlake.operators.cleaning import REASON, clean_events, detect_anomalies, reject_events, split_valid, validate_events
from meterlake.operators.windows import latest_per_key
from meterlake.sources.readers import exists
from meterlake.sources.sinks import together, write_batch

log = logging.getLogger(__name__)


class Sinks(NamedTuple):
    """Where the six outputs go; every table is partitioned by ``batch_id``."""

    clean: str
    rejected: str
    latest: str
    anomalies: str
    hourly: str
    metrics: str

    @classmethod
    def under(cls, root: str) -> Sinks:
        return cls(*[f"{root.rstrip('/')}/{name}" for name in cls._fields])


def latest_readings(clean: DataFrame) -> DataFrame:
    """Latest reading per meter, heartbeats left out."""
    return latest_per_key(clean.where(F.col("event_type") != "heartbeat"), ["meter_id"], "event_timestamp", ["event_id"])


def batch_metrics(validated: DataFrame, batch_id: int, as_of: str | None = None) -> DataFrame:
    """One row of counts, from one pass over the batch."""
    valid = F.col(REASON) == ""
    anomaly = valid & ((F.col("event_type") == "anomaly") | (F.col("kwh") > schemas.ANOMALY_KWH))
    return validated.agg(
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.count("*").alias("total_events"),
        F.count_if(valid).alias("valid_events"),
        F.count_if(~valid).alias("rejected_events"),
        F.count_if(F.coalesce(anomaly, F.lit(False))).alias("anomaly_events"),
    ).withColumn("latest_processed_timestamp", now(as_of))


def _needed(validated: DataFrame) -> DataFrame:
    """What the six tables are made of. A valid row's raw text is in none of them, so only rejects keep theirs; what is left out here is not dealt out for the ranking either."""
    raw = F.when(F.col(REASON) != "", F.col("raw_event_payload")).alias("raw_event_payload")
    fields = ("event_id", "meter_id", "customer_id", "region_name", "event_ts", "kwh", "voltage", "event_type", "source_system", "producer_ts")
    return validated.select(raw, "ingestion_timestamp", "bronze_source_system", *fields, REASON)


def process_batch(
    batch: DataFrame, batch_id: int, sinks: Sinks, regions: Sequence[str] = schemas.REGIONS, as_of: str | None = None,
) -> None:
    """Validate a batch of envelopes and replace batch ``batch_id`` in all six tables.

    The first write fills the cache, the next four run side by side from it, metrics come last and so mark the batch as
    complete. A batch that is retried overwrites its own folders, so every table holds each batch once. A batch
    without rows writes nothing.
    """
    if batch.isEmpty():
        log.info("batch %s: no events", batch_id)
        return
    validated = _needed(validate_events(batch, regions)).persist()
    try:
        clean = clean_events(validated, as_of)
        _, rejected = split_valid(validated)
        write_batch(clean, sinks.clean, batch_id)
        derived = {
            sinks.rejected: reject_events(rejected, as_of=as_of),
            sinks.latest: latest_readings(clean),
            sinks.anomalies: detect_anomalies(clean, as_of=as_of),
            sinks.hourly: hourly_region(clean, as_of=as_of),
        }
        together([partial(write_batch, frame, path, batch_id) for path, frame in derived.items()])
        write_batch(batch_metrics(validated, batch_id, as_of), sinks.metrics, batch_id)
    finally:
        validated.unpersist()


def run_stream(
    stream: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str,
    trigger: Mapping[str, object] | None = None, duration: float | None = None,
) -> StreamingQuery:
    """Start ``on_batch`` on every micro-batch.

    The default trigger takes what is there and ends; ``{"processingTime": "10 seconds"}`` runs on. With a
    ``duration`` in seconds a running query is stopped after that time. An availableNow query is awaited.
    """
    trigger = dict(trigger or {"availableNow": True})
    query = (
        stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )
    if duration is not None:
        if not query.awaitTermination(duration):
            query.stop()
    elif trigger.get("availableNow"):
        query.awaitTermination()
    return query


def run_medallion(
    stream: DataFrame, sinks: Sinks, checkpoint: str, regions: Sequence[str] = schemas.REGIONS,
    as_of: str | None = None, **options,
) -> StreamingQuery:
    return run_stream(stream, lambda df, n: process_batch(df, n, sinks, regions, as_of), checkpoint, **options)


# -- readers that make one table of the per-batch parts -------------------------------
def read_batches(spark: SparkSession, path: str, complete: str | None = None) -> DataFrame:
    """A per-batch table with its ``batch_id`` as a bigint column.

    ``complete`` names the metrics table, which each batch writes last: only batches it holds are read, so a batch that failed half-way is
    invisible until its retry. The batch id is the folder, so the filter prunes files.
    """
    rows = spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    if complete is None:
        return rows
    if not exists(spark, complete):
        return rows.where("false")
    done = spark.read.parquet(complete).select(F.col("batch_id").cast("bigint").alias("batch_id")).distinct()
    return rows.join(done, "batch_id", "left_semi")


def unique_events(clean: DataFrame) -> DataFrame:
    """Silver events without the copies that arrived in later batches."""
    return latest_per_key(clean.withColumn("__age", -F.col("batch_id")), ["event_id"], "__age", ["record_hash"]).drop("__age")


def merge_latest(parts: DataFrame) -> DataFrame:
    """One row per meter out of the per-batch latest rows."""
    return latest_per_key(parts, ["meter_id"], "event_timestamp", ["event_id"])


def merge_hourly(clean: DataFrame, as_of: str | None = None) -> DataFrame:
    """Exact hours from silver: distinct meters of two batches do not add up, so parts are not summed."""
    return hourly_region(unique_events(clean), as_of=as_of)


def late_rows(clean: DataFrame, delay: str, ts: str = "event_timestamp") -> DataFrame:
    """Silver rows a watermark of ``delay`` would have dropped: older than the newest event of the
    batches before theirs, less the delay. One row per batch decides."""
    from pyspark.sql import Window as W

    newest = clean.groupBy("batch_id").agg(F.max(ts).alias("__newest"))
    earlier = W.orderBy("batch_id").rowsBetween(W.unboundedPreceding, -1)
    marks = newest.select("batch_id", (F.max("__newest").over(earlier) - F.expr(f"INTERVAL {delay}")).alias("__mark"))
    return clean.join(marks, "batch_id").where(F.col(ts) < F.col("__mark")).drop("__mark")

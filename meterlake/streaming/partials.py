"""Hours as parts that merge exactly: a batch leaves sums and bitmaps of its meters, and no reader goes back to the events.

A meter has a dense number (``meter_numbers``). A part is one row per hour, region and bucket of numbers: the batch's total, its events and a bitmap of
the meters seen. Totals and counts of parts add up, bitmaps are or-ed, so the distinct meters of many batches are exact. A meter without a number is a row of its own, by
name, and just as exact. An event that came in an earlier batch is left out when the part is made, by the ids kept for its day; so parts never overlap.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions import exact, now
from meterlake.operators.dimensions import assign_keys
from meterlake.operators.windows import latest_per_key
from meterlake.sources.readers import exists
from meterlake.sources.sinks import write_batch

_SEEN = "event_id string, event_day date, batch_id bigint"
_PARTS = "window_start timestamp, window_end timestamp, region_name string, bucket bigint, meter_id string, meters binary, total decimal(38,4), events bigint, batch_id bigint"


class HourParts(NamedTuple):
    """Where the parts and the ids of the events in them lie, both by ``batch_id``."""

    parts: str
    seen: str

    @classmethod
    def under(cls, root: str) -> HourParts:
        return cls(*[f"{root.rstrip('/')}/{name}" for name in cls._fields])


def meter_numbers(meters: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(meter_id, meter_number): dense numbers from 1; known ones stay, new meters follow, so old bitmaps keep their meaning."""
    return assign_keys(meters, "meter_id", known, "meter_number")


def hour_parts(events: DataFrame, numbers: DataFrame, ts: str = "event_timestamp", value: str = "kwh", width: str = "1 hour") -> DataFrame:
    """Parts of events that hold each id once, heartbeats left out. The dimension meets sums per meter, not events."""
    per_meter = (
        events.where(F.col("event_type") != "heartbeat").groupBy(F.window(ts, width).alias("w"), "region_name", "meter_id")
        .agg(F.sum(exact(value)).alias("total"), F.count("*").alias("events"))
    )
    number = F.col("meter_number")
    placed = per_meter.join(numbers.select("meter_id", "meter_number"), "meter_id", "left").select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "region_name", F.bitmap_bucket_number(number).alias("bucket"),
        F.when(number.isNull(), F.col("meter_id")).alias("meter_id"), F.bitmap_bit_position(number).alias("__at"), number.isNotNull().alias("__numbered"), "total", "events")
    made = placed.groupBy("window_start", "window_end", "region_name", "bucket", "meter_id").agg(
        F.bitmap_construct_agg("__at").alias("__map"), F.every("__numbered").alias("__numbered"), F.sum("total").cast("decimal(38,4)").alias("total"), F.sum("events").alias("events"))
    return made.withColumn("meters", F.when(F.col("__numbered"), F.col("__map"))).select("window_start", "window_end", "region_name", "bucket", "meter_id", "meters", "total", "events")


def add_hours(clean: DataFrame, batch_id: int, where: HourParts, numbers: DataFrame) -> None:
    """Replace the part of batch ``batch_id``: its silver events, less those an earlier batch has.

    Ids are looked up among those of the days the batch touches. An id counts as a repeat within its own day; of copies in one batch the greatest ``record_hash`` counts. The part is written last,
    and a batch that is retried sees only batches before it, so it makes the same part again.
    """
    spark = clean.sparkSession
    once = latest_per_key(clean, ["event_id"], "record_hash", ["event_timestamp"]).withColumn("event_day", F.to_date("event_timestamp"))
    # events are parsed, judged and ranked once, for the days, the ids and the parts
    first = once.select("event_id", "event_day", "event_timestamp", "event_type", "region_name", "meter_id", "kwh").persist()
    fresh = first
    try:
        if batch_id and exists(spark, where.seen):
            before = spark.read.schema(_SEEN).parquet(where.seen).where(F.col("batch_id") < batch_id)
            days = first.select("event_day").distinct()
            fresh = first.join(before.join(days, "event_day", "left_semi").select("event_id", "event_day"), ["event_id", "event_day"], "left_anti").persist()
        write_batch(fresh.select("event_id", "event_day"), where.seen, batch_id, partition_by=["event_day"])
        write_batch(hour_parts(fresh, numbers), where.parts, batch_id)
    finally:
        fresh.unpersist()
        first.unpersist()


def merged_hours(spark: SparkSession, where: HourParts, as_of: str | None = None) -> DataFrame:
    """Hours per region over all batches, from the parts alone: total, events, exact distinct meters."""
    return merge_parts(spark.read.schema(_PARTS).parquet(where.parts), as_of)


def merge_parts(parts: DataFrame, as_of: str | None = None) -> DataFrame:
    per_bucket = parts.groupBy("window_start", "window_end", "region_name", "bucket", "meter_id").agg(
        F.bitmap_or_agg("meters").alias("meters"), F.sum("total").alias("total"), F.sum("events").alias("events"))
    unnumbered = F.when(F.col("meter_id").isNotNull(), 1).otherwise(0)
    return per_bucket.groupBy("window_start", "window_end", "region_name").agg(
        F.sum("total").cast("decimal(18,4)").cast("double").alias("total_kwh"), F.sum("events").alias("event_count"),
        F.sum(F.when(F.col("bucket").isNotNull(), F.bitmap_count("meters")).otherwise(unnumbered)).cast("bigint").alias("unique_meter_count"),
    ).withColumn("processed_timestamp", now(as_of))

"""Aggregations. All combine on the map side first; totals are exact decimals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterlake.functions import boundary_diff, exact, kwh_average, kwh_total, now


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def daily_region(df: DataFrame, day: str = "reading_date", region: str = "region_name", value: str = "kwh",
                 meter: str = "meter_id") -> DataFrame:
    """Per day and region: total, average, rows and distinct meters.

    Aggregates per meter first, so the distinct count needs no second copy of the rows and
    a region that holds a third of all rows is spread over its meters.
    """
    per_meter = df.groupBy(day, region, meter).agg(F.sum(exact(value)).alias("__sum"), F.count("*").alias("__rows"),
                                                   F.count(value).alias("__values"))
    total = F.sum("__sum")
    return per_meter.groupBy(day, region).agg(
        total.cast("decimal(18,4)").alias("total_kwh"),
        F.try_divide(total, F.sum("__values")).cast("decimal(18,4)").alias("average_kwh"),
        F.sum("__rows").alias("reading_count"),
        F.count(meter).alias("unique_meter_count"),
    )


def daily_customer(df: DataFrame, day: str = "reading_date", value: str = "kwh") -> DataFrame:
    return df.groupBy(day, "customer_id", "meter_id", "region_name").agg(
        kwh_total(value).alias("total_kwh"), F.count("*").alias("reading_count"))


def monthly_region(daily: DataFrame, day: str = "reading_date") -> DataFrame:
    """Months from daily rows; meters are the greatest daily distinct count."""
    return daily.groupBy(
        F.year(day).alias("year_number"), F.month(day).alias("month_number"), "region_name"
    ).agg(
        kwh_total("total_kwh").alias("total_kwh"),
        kwh_average("total_kwh").alias("average_daily_kwh"),
        F.max("unique_meter_count").alias("unique_meter_count"),
    )


def average_of_daily_sums(df: DataFrame, keys: Sequence[str], day: str, value: str = "kwh") -> DataFrame:
    """Two-level average: sum per key and day, then the mean of those sums."""
    daily = df.groupBy(*keys, day).agg(F.sum(exact(value)).alias("__daily"))
    return daily.groupBy(*keys).agg(kwh_average("__daily").alias("average_daily_kwh"))


def activity_span(df: DataFrame, keys: Sequence[str], ts: str, day: str) -> DataFrame:
    """First and last time and number of distinct days per key."""
    daily = df.groupBy(*keys, day).agg(F.min(ts).alias("__first"), F.max(ts).alias("__last"))
    return daily.groupBy(*keys).agg(
        F.count(day).alias("active_days"),
        F.min("__first").alias("first_reading_timestamp"), F.max("__last").alias("last_reading_timestamp"))


def customer_usage(df: DataFrame, keys: Sequence[str] = ("customer_id", "region_name"), day: str = "reading_date",
                   ts: str = "reading_timestamp", value: str = "kwh") -> DataFrame:
    """Per customer and region: total, mean daily total, active days, first and last reading.

    One pass: days first, then customers. No join of two aggregates over the same rows.
    """
    daily = df.groupBy(*keys, day).agg(
        F.sum(exact(value)).alias("__daily"), F.min(ts).alias("__first"), F.max(ts).alias("__last"))
    return daily.groupBy(*keys).agg(
        kwh_total("__daily").alias("total_kwh"),
        kwh_average("__daily").alias("average_daily_kwh"),
        F.count(day).alias("active_days"),
        F.min("__first").alias("first_reading_timestamp"),
        F.max("__last").alias("last_reading_timestamp"),
    )


def hourly_region(events: DataFrame, ts: str = "event_timestamp", value: str = "kwh", width: str = "1 hour",
                  as_of: str | None = None) -> DataFrame:
    """Tumbling window per region without heartbeats: total, events, distinct meters."""
    hour = F.window(ts, width)
    per_meter = (
        events.where(F.col("event_type") != "heartbeat")
        .groupBy(hour.alias("w"), "region_name", "meter_id")
        .agg(F.sum(exact(value)).alias("__sum"), F.count("*").alias("__rows"))
    )
    return per_meter.groupBy("w", "region_name").agg(
        F.sum("__sum").cast("decimal(18,4)").cast("double").alias("total_kwh"),
        F.sum("__rows").alias("event_count"),
        F.count("meter_id").alias("unique_meter_count"),
    ).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "region_name", "total_kwh", "event_count", "unique_meter_count", now(as_of).alias("processed_timestamp"),
    )


def running_daily(df: DataFrame, keys: Sequence[str], day: str, value: str) -> DataFrame:
    """Daily totals per key and their running sum, in day order.

    Rows are summed to days first, so a window group holds one row per calendar day, however
    many rows the key has. For a running sum over unsummed rows see ``windows.running_sum``.
    """
    daily = df.groupBy(*keys, day).agg(F.sum(value).alias("daily_total"))
    upto = W.partitionBy(*keys).orderBy(day).rowsBetween(W.unboundedPreceding, W.currentRow)
    return daily.withColumn("running_total", F.sum("daily_total").over(upto))


def anomaly_by_region(anomalies: DataFrame, keys: Sequence[str] = ("region_name", "anomaly_type")) -> DataFrame:
    above = exact("kwh") - F.coalesce(exact("expected_kwh"), F.lit(0))
    return anomalies.groupBy(*keys).agg(
        F.count("*").alias("anomaly_count"),
        F.avg(exact("anomaly_score")).cast("decimal(18,4)").alias("average_anomaly_score"),
        F.sum(above).cast("decimal(18,4)").alias("total_kwh_above_expected"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "duplicate_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name)).where(F.col(name) > 1)


def scalar_row(spark, values: Mapping[str, DataFrame]) -> DataFrame:
    """One row out of one-value frames, as scalar subqueries."""
    one = spark.range(1)
    return one.select(*[frame.scalar().alias(name) for name, frame in values.items()])


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all([
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ])


def rejects_by_reason(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("rejection_reason").agg(
        F.count("*").alias("rejected_count"),
        F.min("rejected_at").alias("first_rejected_at"),
        F.max("rejected_at").alias("latest_rejected_at"),
    )


def tagged_union(tables: Mapping[str, tuple[DataFrame, str]], columns: Mapping[str, str], extra: str) -> DataFrame:
    """Findings of several tables under one schema: table_name, record_id (text) and ``extra``.

    ``tables[name]`` is (rows, id column); ``columns[name]`` is the column shown as ``extra``.
    """
    return union_all([
        df.select(F.lit(name).alias("table_name"), F.col(id_col).cast("string").alias("record_id"),
                  F.col(columns[name]).alias(extra))
        for name, (df, id_col) in tables.items()
    ])


def distinct_regions(frames: Sequence[DataFrame], column: str = "region_name") -> DataFrame:
    return union_all([f.select(column) for f in frames]).distinct().orderBy(column)


def latest_over(sources: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Latest time per source: source_name, latest_reading_timestamp."""
    return union_all([
        df.agg(F.max(ts).alias("latest_reading_timestamp")).select(F.lit(name).alias("source_name"), "latest_reading_timestamp")
        for name, (df, ts) in sources.items()
    ])


def hours_since(df: DataFrame, ts: str, as_of: str | None = None, name: str = "hours_since_latest_reading") -> DataFrame:
    return df.withColumn(name, boundary_diff("HOUR", F.col(ts), now(as_of)))


def region_by_month(df: DataFrame, months: Sequence[int] = range(1, 13), value: str = "total_kwh") -> DataFrame:
    """Matrix: one row per region and year, one column per month.

    The months are given, so the pivot needs no extra job to find them.
    """
    return (
        df.groupBy("year_number", "region_name").pivot("month_number", list(months))
        .agg(F.sum(exact(value)).cast("decimal(18,4)"))
        .select("year_number", "region_name", *[F.col(str(m)).alias(f"month_{m:02d}") for m in months])
    )

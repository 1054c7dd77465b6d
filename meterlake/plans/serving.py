"""Parameterised serving queries and BI measures over the serving views.

A filter that is not given leaves no trace in the plan; one on a dimension cuts the fact by its keys before it is summed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake import schemas
from meterlake.functions import optional_date_range, optional_eq, optional_ts_range, safe_divide
from meterlake.operators.aggregates import distinct_regions, hours_since, scalar_row

Views = Mapping[str, DataFrame]


def _page(df: DataFrame, limit: int | None, *order: Column | str) -> DataFrame:
    """All rows in order, or the page of ``limit`` rows that the caller asks for."""
    if limit is None:
        return df.orderBy(*order)
    if limit < 1:
        raise ValueError(f"a page has at least one row, not {limit}")
    return df.orderBy(*order).limit(limit)


def regions(views: Views) -> DataFrame:
    if hasattr(views, "region_names"):
        return views.region_names()
    return distinct_regions([views[n] for n in ("daily_region", "monthly_region", "latest_reading", "anomaly_events")])


def daily(views: Views, region_name: str | None = None, start_date: str | None = None, end_date: str | None = None,
          limit: int | None = None) -> DataFrame:
    view = views.narrowed(
        "daily_region", dim_region=lambda d: optional_eq(d, "region_name", region_name), dim_date=lambda d: optional_date_range(d, "full_date", start_date, end_date),
    ) if hasattr(views, "narrowed") else views["daily_region"]
    rows = optional_date_range(optional_eq(view, "region_name", region_name), "reading_date", start_date, end_date)
    return _page(rows, limit, "reading_date", "region_name")


def monthly(views: Views, region_name: str | None = None, limit: int | None = None) -> DataFrame:
    view = views.narrowed("monthly_region", dim_region=lambda d: optional_eq(d, "region_name", region_name)) if hasattr(views, "narrowed") else views["monthly_region"]
    rows = optional_eq(view, "region_name", region_name)
    return _page(rows, limit, "year_number", "month_number", "region_name")


def customer(views: Views, customer_id: str) -> DataFrame:
    """One customer's rows; an empty result means there is no such customer."""
    return views["customer_usage"].where(F.col("customer_id") == customer_id)


def latest(views: Views, meter_id: str | None = None, limit: int | None = None) -> DataFrame:
    return _page(optional_eq(views["latest_reading"], "meter_id", meter_id), limit, F.desc("event_timestamp"), "meter_id")


def anomalies(views: Views, region_name: str | None = None, start_date: str | None = None, end_date: str | None = None,
              limit: int | None = None) -> DataFrame:
    rows = optional_ts_range(optional_eq(views["anomaly_events"], "region_name", region_name), "detected_at", start_date, end_date)
    return _page(rows, limit, F.desc("detected_at"), "anomaly_id")


def kpis(views: Views) -> DataFrame:
    return views["kpis"]


def runs(views: Views, status: str | None = None, limit: int | None = None) -> DataFrame:
    return _page(optional_eq(views["run_summary"], "status", status), limit, F.desc("started_at"), "pipeline_run_id")


def checks(views: Views, status: str | None = None, limit: int | None = None) -> DataFrame:
    return _page(optional_eq(views["quality_summary"], "status", status), limit, F.desc("checked_at"), "check_id")


def freshness(views: Views, as_of: str | None = None) -> DataFrame:
    row = hours_since(views["kpis"].select("latest_reading_timestamp"), "latest_reading_timestamp", as_of)
    return schemas.assert_contract(row, schemas.VIEW_CONTRACTS["freshness"])


def query(spark: SparkSession, sql: str, args: Mapping[str, object] | None = None) -> DataFrame:
    """Run a read-only statement with named parameters."""
    if not sql.lstrip().upper().startswith(("SELECT", "WITH")):
        raise ValueError("only SELECT and WITH statements are allowed")
    return spark.sql(sql, args=dict(args or {}))


# -- BI measures: each one row, one column -------------------------------------------------
def total_kwh(views: Views) -> DataFrame:
    return views["daily_region"].agg(F.sum("total_kwh").alias("total_kwh"))


def average_daily_kwh(views: Views) -> DataFrame:
    return views["daily_region"].agg(F.avg("total_kwh").alias("average_daily_kwh"))


def total_anomalies(views: Views) -> DataFrame:
    return views["anomaly_events"].agg(F.count("*").alias("total_anomalies"))


def active_meters(views: Views) -> DataFrame:
    return views["latest_reading"].agg(F.countDistinct("meter_id").alias("active_meters"))


def latest_reading_timestamp(views: Views) -> DataFrame:
    return views["kpis"].agg(F.max("latest_reading_timestamp").alias("latest_reading_timestamp"))


def failed_pipeline_runs(views: Views) -> DataFrame:
    return views["run_summary"].agg(F.count_if(F.col("status") == "failed").alias("failed_pipeline_runs"))


def failed_quality_checks(views: Views) -> DataFrame:
    return views["quality_summary"].agg(F.count_if(F.col("status") == "failed").alias("failed_quality_checks"))


def anomaly_rate(views: Views) -> DataFrame:
    """Anomalies per active meter; 0 when there are no meters."""
    row = scalar_row(views["kpis"].sparkSession, {"a": total_anomalies(views), "m": active_meters(views)})
    return row.select(safe_divide("a", "m").alias("anomaly_rate"))


def anomaly_count_by_region(views: Views) -> DataFrame:
    return views["anomaly_events"].groupBy("region_name").agg(F.count("*").alias("anomaly_count"))


def top_latest_meters(views: Views, k: int = 10) -> DataFrame:
    return views["latest_reading"].orderBy(F.desc("kwh"), "meter_id").limit(k)

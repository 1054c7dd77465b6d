"""Analytics queries and serving views over the star schema.

``tables`` maps names to DataFrames: fact_consumption, fact_reading, fact_anomaly, dim_date, dim_region,
dim_customer, dim_meter, dim_tariff, pipeline_run, quality_check.

Every fact query groups by the fact's own keys *before* it joins dimensions. The big table is
read once, combined map-side and shuffled as partial sums; dimensions meet only those sums. Inner joins still
drop facts without a dimension row, because a whole group shares its keys.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterlake import schemas
from meterlake.functions import boundary_diff, now
from meterlake.operators.aggregates import (
    anomaly_by_region, distinct_regions, hours_since, latest_over, monthly_region, region_by_month, running_daily, scalar_row,
)
from meterlake.operators.joins import star_join
from meterlake.operators.windows import latest_per_key, top_k
from meterlake.plans.planned import Planned

Tables = Mapping[str, DataFrame]
_KEYS = {"dim_date": "date_id", "dim_region": "region_id", "dim_customer": "customer_id", "dim_tariff": "tariff_id"}


def _key_sums(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    return fact.groupBy(*keys).agg(
        F.sum("kwh").alias("kwh"), F.sum("estimated_cost").alias("cost"), F.count("*").alias("rows"),
        F.count("kwh").alias("kwh_rows"))


def _with_dims(sums: DataFrame, tables: Tables, *dims: str, how: str = "inner") -> DataFrame:
    return star_join(sums, {d: tables[d] for d in dims}, _KEYS, how)


def _dec(col: Column) -> Column:
    return col.cast("decimal(18,4)")


def _total() -> Column:
    return _dec(F.sum("kwh")).alias("total_kwh")


def _cost() -> Column:
    return _dec(F.sum("cost")).alias("total_estimated_cost")


def _rows(name: str) -> Column:
    return F.sum("rows").alias(name)


def _mean(name: str) -> Column:
    return _dec(F.try_divide(F.sum("kwh"), F.sum("kwh_rows"))).alias(name)


# -- analytics ----------------------------------------------------------------------
def daily_by_region(tables: Tables) -> DataFrame:
    joined = _with_dims(_key_sums(tables["fact_consumption"], ["date_id", "region_id"]), tables, "dim_date", "dim_region")
    return joined.groupBy("full_date", "region_name").agg(
        _total(), _cost(), _rows("reading_count"),
    ).orderBy("full_date", "region_name")


def monthly_by_region(tables: Tables) -> DataFrame:
    joined = _with_dims(_key_sums(tables["fact_consumption"], ["date_id", "region_id"]), tables, "dim_date", "dim_region")
    return joined.groupBy("year_number", "month_number", "month_name", "region_name").agg(
        _total(), _cost(),
    ).orderBy("year_number", "month_number", "region_name")


def top_meters(tables: Tables, k: int = 5) -> DataFrame:
    sums = _key_sums(tables["fact_consumption"], ["meter_id", "customer_id", "region_id"])
    keys = ["meter_id", "customer_segment", "region_name"]
    totals = _with_dims(sums, tables, "dim_customer", "dim_region").groupBy(*keys).agg(
        _total(), _cost())
    return top_k(totals, "total_kwh", k, keys)


def latest_by_meter(tables: Tables) -> DataFrame:
    latest = latest_per_key(tables["fact_reading"], ["meter_id"], "event_timestamp", ["reading_id"])
    return latest.select("reading_id", "meter_id", "event_timestamp", "kwh", "voltage").orderBy("meter_id")


def running_by_region(tables: Tables) -> DataFrame:
    joined = _with_dims(_key_sums(tables["fact_consumption"], ["date_id", "region_id"]), tables, "dim_date", "dim_region")
    return running_daily(joined, ["region_name"], "full_date", "kwh").select(
        "full_date", "region_name", _dec(F.col("daily_total")).alias("daily_kwh"),
        _dec(F.col("running_total")).alias("running_region_kwh"),
    ).orderBy("region_name", "full_date")


def segment_average(tables: Tables) -> DataFrame:
    """Customers are unique in the dimension, so counting the per-customer sums counts customers."""
    joined = _with_dims(_key_sums(tables["fact_consumption"], ["customer_id"]), tables, "dim_customer")
    return joined.groupBy("customer_segment").agg(
        F.count("customer_id").alias("customer_count"), _rows("fact_row_count"),
        _mean("average_daily_kwh"), _total(),
    ).orderBy(F.desc("total_kwh"), "customer_segment")


def tariff_cost(tables: Tables) -> DataFrame:
    keys = ["tariff_id", "tariff_name", "price_per_kwh", "standing_charge_daily"]
    fact = tables["fact_consumption"]
    known = tables["dim_tariff"].select(*keys).withColumn("__fk", F.col("tariff_id"))
    sums = _key_sums(fact, ["tariff_id"]).withColumnRenamed("tariff_id", "__fk")
    return sums.join(known, "__fk", "left").groupBy(*keys).agg(
        _rows("consumption_rows"), _total(), _cost(),
    ).orderBy(F.desc("total_estimated_cost"), "tariff_id")


def anomalies_by_region(tables: Tables) -> DataFrame:
    by_key = star_join(tables["fact_anomaly"], {"dim_region": tables["dim_region"]}, _KEYS)
    return anomaly_by_region(by_key).orderBy(
        F.desc("anomaly_count"), F.desc("average_anomaly_score"), "region_name", "anomaly_type")


def weekday_weekend(tables: Tables) -> DataFrame:
    joined = _with_dims(_key_sums(tables["fact_consumption"], ["date_id"]), tables, "dim_date")
    return joined.groupBy(F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("day_type")).agg(
        _rows("consumption_rows"), _mean("average_kwh"), _total(),
        _cost(),
    ).orderBy("day_type")


def freshness_by_source(tables: Tables, as_of: str | None = None) -> DataFrame:
    latest = latest_over({
        "batch_consumption": (tables["fact_consumption"], "reading_timestamp"),
        "smart_meter_events": (tables["fact_reading"], "event_timestamp"),
    })
    return hours_since(latest, "latest_reading_timestamp", as_of).orderBy(F.desc("latest_reading_timestamp"))


def _duration(as_of: str | None) -> Column:
    return boundary_diff("SECOND", F.col("started_at"), F.coalesce("finished_at", now(as_of)))


def run_statistics(tables: Tables, as_of: str | None = None) -> DataFrame:
    """Runs per pipeline and status. The mean duration is a whole number; open runs last until now."""
    runs = tables["pipeline_run"].withColumn("__seconds", _duration(as_of))
    return runs.groupBy("pipeline_name", "pipeline_type", "status").agg(
        F.count("*").alias("run_count"),
        *[F.sum(f"records_{x}").alias(f"total_records_{x}") for x in ("read", "written", "rejected")],
        (F.sum("__seconds") / F.count("__seconds")).cast("bigint").alias("average_duration_seconds"),
    ).orderBy("pipeline_type", "pipeline_name", "status")


def check_statistics(tables: Tables) -> DataFrame:
    return tables["quality_check"].groupBy("table_name", "check_name").agg(
        F.count("*").alias("check_run_count"),
        F.count_if(F.col("status") == "failed").alias("failed_run_count"),
        F.sum("failed_count").alias("total_failed_records"),
        F.max("checked_at").alias("latest_checked_at"),
    ).orderBy(F.desc("total_failed_records"), "table_name", "check_name")


def failed_rows(df: DataFrame, newest_by: str, tie_break: str) -> DataFrame:
    """Failed runs or checks, newest first."""
    return df.where(F.col("status") == "failed").orderBy(F.desc(newest_by), tie_break)


# -- serving views --------------------------------------------------------------------
def _daily_meter_sums(tables: Tables) -> DataFrame:
    """Per day and region with distinct meters: meters are grouped first, then counted."""
    per_meter = _key_sums(tables["fact_consumption"], ["date_id", "region_id", "meter_id"])
    per_key = per_meter.groupBy("date_id", "region_id").agg(
        F.sum("kwh").alias("kwh"), F.sum("rows").alias("rows"), F.sum("kwh_rows").alias("kwh_rows"),
        F.count("meter_id").alias("meters"))
    return _with_dims(per_key, tables, "dim_date", "dim_region")


def view_daily_region(tables: Tables) -> DataFrame:
    """Dates and region names are unique in their dimensions, so one key pair is one row."""
    return _daily_meter_sums(tables).select(
        F.col("full_date").alias("reading_date"), "region_name", _dec(F.col("kwh")).alias("total_kwh"),
        _dec(F.try_divide("kwh", "kwh_rows")).alias("average_kwh"),
        F.col("rows").alias("reading_count"), F.col("meters").alias("unique_meter_count"))


def view_monthly_region(tables: Tables) -> DataFrame:
    daily = _daily_meter_sums(tables).select(
        F.col("full_date").alias("reading_date"), "region_name", F.col("kwh").alias("total_kwh"),
        F.col("meters").alias("unique_meter_count"))
    return monthly_region(daily)


def view_customer_usage(tables: Tables) -> DataFrame:
    """The mean runs over a customer's days in all regions; totals and times are per region.

    The fact is read once: summed to days, then a window per customer adds up its days. Such a window holds a
    customer's days and regions, not its rows. Days of one customer lie together for all that follows.
    """
    per_day = tables["fact_consumption"].groupBy("customer_id", "region_id", "date_id").agg(
        F.sum("kwh").alias("kwh"), F.min("reading_timestamp").alias("first"), F.max("reading_timestamp").alias("last"))
    dated = per_day.join(tables["dim_date"].select("date_id", "full_date"), "date_id", "left").repartition("customer_id")
    customer = W.partitionBy("customer_id")
    new_day = F.row_number().over(W.partitionBy("customer_id", "full_date").orderBy("region_id", "date_id")) == 1
    known = F.col("full_date").isNotNull()
    spread = dated.withColumn("new_day", known & new_day).withColumns({
        "days": F.count_if("new_day").over(customer), "dated_kwh": F.sum(F.when(known, F.col("kwh"))).over(customer)})
    totals = spread.where(F.col("days") > 0).groupBy("customer_id", "region_id").agg(
        F.sum("kwh").alias("kwh"), F.min("first").alias("first"), F.max("last").alias("last"),
        _dec(F.max(F.try_divide("dated_kwh", "days"))).alias("average_daily_kwh"))
    joined = _with_dims(totals, tables, "dim_customer", "dim_region")
    return joined.groupBy("customer_id", "customer_segment", "region_name").agg(
        _dec(F.sum("kwh")).alias("total_kwh"), F.max("average_daily_kwh").alias("average_daily_kwh"),
        F.min("first").alias("first_reading_timestamp"), F.max("last").alias("last_reading_timestamp"))


def view_latest_reading(tables: Tables) -> DataFrame:
    known = star_join(tables["fact_reading"], {"dim_region": tables["dim_region"].select("region_id", "region_name")}, _KEYS)
    return latest_per_key(known, ["meter_id"], "event_timestamp", ["reading_id"]).select(
        "meter_id", "customer_id", "region_name", "event_timestamp", "kwh", "voltage")


def view_anomaly_events(tables: Tables) -> DataFrame:
    known = star_join(tables["fact_anomaly"], {"dim_region": tables["dim_region"].select("region_id", "region_name")}, _KEYS)
    return known.select(*schemas.VIEW_CONTRACTS["anomaly_events"].names)


def view_quality_summary(tables: Tables) -> DataFrame:
    return tables["quality_check"].select(*schemas.VIEW_CONTRACTS["quality_summary"].names)


def view_run_summary(tables: Tables, as_of: str | None = None) -> DataFrame:
    timed = tables["pipeline_run"].withColumn("duration_seconds", _duration(as_of))
    return timed.select(*schemas.VIEW_CONTRACTS["run_summary"].names)


def view_kpis(tables: Tables) -> DataFrame:
    """One row out of one narrow aggregate per table."""
    def rows(name: str) -> DataFrame:
        return tables[name].agg(F.count("*"))

    def failed(name: str) -> DataFrame:
        return tables[name].agg(F.count_if(F.col("status") == "failed"))

    consumption = F.struct(
        _dec(F.coalesce(F.sum("kwh"), F.lit(0))).alias("total_kwh"), F.max("reading_timestamp").alias("latest"))
    row = scalar_row(tables["fact_consumption"].sparkSession, {
        "consumption": tables["fact_consumption"].agg(consumption),
        "latest_event": tables["fact_reading"].agg(F.max("event_timestamp")),
        "total_customers": rows("dim_customer"),
        "total_meters": rows("dim_meter"),
        "total_anomalies": rows("fact_anomaly"),
        "failed_pipeline_runs": failed("pipeline_run"),
        "failed_data_quality_checks": failed("quality_check"),
    })
    return row.withColumns({
        "total_kwh": F.col("consumption.total_kwh"),
        "latest_reading_timestamp": F.greatest("consumption.latest", "latest_event"),
    }).select(*schemas.VIEW_CONTRACTS["kpis"].names)


class ServingViews(Planned):
    """The views by name, and views over a part of the dimensions."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]], tables: Tables):
        super().__init__(builders)
        self.tables = tables

    def narrowed(self, name: str, **filters: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """A consumption view over the dimension rows each filter leaves: the fact is cut by its keys before it is summed."""
        tables = dict(self.tables)
        for dim, keep in filters.items():
            rows = keep(tables[dim])
            if rows is not tables[dim]:  # a filter that was not asked for leaves no trace
                tables[dim] = rows
                tables["fact_consumption"] = tables["fact_consumption"].join(rows.select(_KEYS[dim]), _KEYS[dim], "left_semi")
        view = {"daily_region": view_daily_region, "monthly_region": view_monthly_region}[name](tables)
        return schemas.assert_contract(view, schemas.VIEW_CONTRACTS[name])

    def region_names(self) -> DataFrame:
        """Names of regions with consumption, latest readings or anomalies; from keys where the view's rows are not needed."""
        t = self.tables
        dated = t["fact_consumption"].select("region_id", "date_id").distinct().join(t["dim_date"].select("date_id"), "date_id", "left_semi")
        keys = dated.select("region_id").unionAll(t["fact_anomaly"].select("region_id")).distinct()
        named = t["dim_region"].join(keys, "region_id", "left_semi").select("region_name")
        return distinct_regions([named, self["latest_reading"]])


def serving_views(tables: Tables, as_of: str | None = None) -> ServingViews:
    """All eight views by name, each checked against its contract when it is planned."""
    builders = {
        "daily_region": view_daily_region, "monthly_region": view_monthly_region, "customer_usage": view_customer_usage,
        "latest_reading": view_latest_reading, "anomaly_events": view_anomaly_events,
        "quality_summary": view_quality_summary, "run_summary": partial(view_run_summary, as_of=as_of), "kpis": view_kpis,
    }

    def checked(name: str) -> DataFrame:
        return schemas.assert_contract(builders[name](tables), schemas.VIEW_CONTRACTS[name])

    return ServingViews({name: partial(checked, name) for name in builders}, tables)


def register_views(tables: Tables, as_of: str | None = None, prefix: str = "serving_") -> list[str]:
    """Register the views for SQL; returns their names."""
    names = []
    for name, df in serving_views(tables, as_of).items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


def region_month_matrix(views: Tables) -> DataFrame:
    return region_by_month(views["monthly_region"])

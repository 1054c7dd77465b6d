"""Every operator as a query over the provided tables: name -> function of (session, folder)."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake import functions as fn
from meterlake import schemas
from meterlake.operators import aggregates as agg
from meterlake.operators import cleaning, dimensions, joins, quality, windows
from meterlake.plans import batch, runlog, serving, stream_load, tables, warehouse
from meterlake.plans.tables import AS_OF, REGIONS
from meterlake.session import scratch_path
from meterlake.sources import offset_log, readers, sinks, versions
from meterlake.streaming import micro_batch, partials, stateful

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
_LANDED = 8  # files of a landed batch, each written by a task of its own


def portable(df: DataFrame) -> DataFrame:
    """Types every engine prints alike: text for dates and times, double for decimals, bigint for integers."""
    def column(field: T.StructField):
        kind, col = field.dataType, F.col(field.name)
        if isinstance(kind, T.TimestampType):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.DateType):
            col = col.cast("string")
        elif isinstance(kind, (T.DecimalType, T.FloatType)):
            col = col.cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            col = col.cast("bigint")
        return col.alias(field.name)

    return df.select(*[column(f) for f in df.schema])


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return portable(function(spark, sf_dir))

    QUERIES[function.__name__] = run
    return run


def _without_audit(df: DataFrame) -> DataFrame:
    return df.drop("processed_timestamp")


# -- typing and rules -----------------------------------------------------------------------
@query
def clean_text_typed(s, d):
    raw = tables.dirty_consumption(s, d)
    text = raw.withColumns({c: fn.clean_text(c) for c in ("meter_id", "region_name")})
    return fn.typed(text, {"reading_timestamp": "timestamp", "kwh": "double"}).drop("ingestion_timestamp")


@query
def rejection_reasons(s, d):
    raw = tables.dirty_consumption(s, d)
    text = raw.withColumns({c: fn.clean_text(c) for c in ("meter_id", "customer_id", "region_name")}).withColumn("raw_kwh", F.col("kwh"))
    typed = fn.typed(text, {"reading_timestamp": "timestamp", "kwh": "double"})
    return typed.select("source_file", "customer_id", "raw_kwh", fn.rejection_reason(fn.consumption_rules(REGIONS)).alias("rejection_reason"))


@query
def row_rules(s, d):
    raw = tables.dirty_consumption(s, d)
    return raw.select("source_file", "customer_id", "kwh", fn.rejection_reason(fn.consumption_rules(REGIONS, style="row")).alias("rejection_reason"))


@query
def rejects_by_reason(s, d):
    _, rejects = cleaning.transform_consumption(tables.dirty_consumption(s, d), REGIONS, AS_OF)
    return agg.rejects_by_reason(rejects)


def _validated_events(s, d):
    return cleaning.validate_events(tables.envelopes(s, d), REGIONS)


@query
def event_rules(s, d):
    return _validated_events(s, d).select("raw_event_payload", "rejection_reason")


def _row_checked_events(s, d):
    parsed = cleaning.parse_events(tables.envelopes(s, d)).where(~F.col("is_malformed"))
    parsed = parsed.withColumn("source_system", F.when(F.col("voltage") > 231, F.col("bronze_source_system")))
    return parsed.withColumn("rejection_reason", fn.rejection_reason(fn.event_row_rules(REGIONS)))


@query
def event_row_rules(s, d):
    return _row_checked_events(s, d).select("event_id", "producer_timestamp", "rejection_reason")


@query
def classify_events(s, d):
    return _row_checked_events(s, d).select("event_id", "producer_timestamp", fn.classify_event("rejection_reason").alias("event_class"))


# -- cleaning ---------------------------------------------------------------------------------
@query
def clean_consumption(s, d):
    clean, _ = cleaning.transform_consumption(tables.dirty_consumption(s, d), REGIONS, AS_OF)
    return clean


@query
def rejected_consumption(s, d):
    _, rejects = cleaning.transform_consumption(tables.dirty_consumption(s, d), REGIONS, AS_OF)
    return rejects


@query
def clean_weather(s, d):
    clean, _ = cleaning.transform_weather(tables.bronze_weather(s, d), REGIONS, AS_OF)
    return clean


@query
def rejected_weather(s, d):
    _, rejects = cleaning.transform_weather(tables.bronze_weather(s, d), REGIONS, AS_OF)
    return rejects


@query
def all_rejects(s, d):
    _, consumption = cleaning.transform_consumption(tables.dirty_consumption(s, d), REGIONS, AS_OF)
    _, weather = cleaning.transform_weather(tables.bronze_weather(s, d), REGIONS, AS_OF)
    return agg.union_all([consumption, weather]).groupBy("source_system", "rejection_reason").agg(F.count("*").alias("rejected_count"))


@query
def clean_customers(s, d):
    return _without_audit(cleaning.transform_metadata(*tables.raw_metadata(s, d))[0])


@query
def clean_meters(s, d):
    return _without_audit(cleaning.transform_metadata(*tables.raw_metadata(s, d))[1])


@query
def parse_events(s, d):
    return cleaning.parse_events(tables.envelopes(s, d)).select(
        "raw_event_payload", "is_malformed", "event_id", "meter_id", "kwh", "voltage", "event_ts", "producer_ts")


@query
def clean_events(s, d):
    return cleaning.clean_events(_validated_events(s, d), AS_OF)


@query
def rejected_events(s, d):
    _, rejected = cleaning.split_valid(_validated_events(s, d))
    return cleaning.reject_events(rejected, as_of=AS_OF)


# -- aggregates ---------------------------------------------------------------------------------
@query
def daily_region(s, d):
    return agg.daily_region(tables.silver_readings(s, d))


@query
def daily_customer(s, d):
    return agg.daily_customer(tables.silver_readings(s, d))


@query
def monthly_region(s, d):
    return agg.monthly_region(agg.daily_region(tables.silver_readings(s, d)))


@query
def customer_usage(s, d):
    return agg.customer_usage(tables.silver_readings(s, d))


@query
def average_of_daily_sums(s, d):
    return agg.average_of_daily_sums(tables.silver_readings(s, d), ["region_name"], "reading_date")


@query
def activity_span(s, d):
    return agg.activity_span(tables.silver_readings(s, d), ["customer_id"], "reading_timestamp", "reading_date")


@query
def weather_features(s, d):
    weather, _ = cleaning.transform_weather(tables.bronze_weather(s, d), REGIONS, AS_OF)
    return _without_audit(joins.weather_features(tables.silver_readings(s, d), weather))


@query
def hourly_region(s, d):
    return _without_audit(agg.hourly_region(tables.clean_stream_events(s, d)))


@query
def anomalies(s, d):
    return _without_audit(cleaning.detect_anomalies(tables.clean_stream_events(s, d), as_of=AS_OF)).drop("expected_kwh")


@query
def duplicate_keys(s, d):
    return agg.duplicate_keys(tables.dirty_consumption(s, d), ["meter_id", "reading_timestamp"])


@query
def duplicate_event_ids(s, d):
    parsed = cleaning.parse_events(tables.envelopes(s, d))
    return agg.duplicate_keys(parsed.where(F.col("event_id").isNotNull()), ["event_id"])


@query
def table_counts(s, d):
    return agg.table_counts(tables.star(s, d))


@query
def region_month_matrix(s, d):
    return warehouse.region_month_matrix({"monthly_region": warehouse.view_monthly_region(tables.star(s, d))})


# -- windows and limits ----------------------------------------------------------------------------
@query
def dedup_latest_per_key(s, d):
    return windows.latest_per_key(tables.dirty_consumption(s, d), ["customer_id"], "ingestion_timestamp", ["source_file", "kwh", "meter_id"])


@query
def latest_reading(s, d):
    return micro_batch.latest_readings(tables.clean_stream_events(s, d)).drop("n")


@query
def row_number_per_key(s, d):
    r = tables.readings(s, d).select("region_name", "event_id", "event_timestamp")
    return windows.row_number_per_key(r, ["region_name"], ["event_timestamp", "event_id"])


@query
def running_sum(s, d):
    r = tables.readings(s, d).select("region_name", "event_id", "event_timestamp", "kwh")
    return windows.running_sum(r, ["region_name"], ["event_timestamp", "event_id"], "kwh", "running_kwh")


@query
def recent_avg_anomaly(s, d):
    r = tables.readings(s, d).select("meter_id", "event_id", "event_timestamp", "kwh")
    return windows.recent_avg_anomaly(r, "meter_id", "event_timestamp", "kwh", n=5, tie_break=["event_id"]).drop("recent_average")


@query
def event_numbers(s, d):
    return windows.sequence_number(tables.readings(s, d).select("event_id", "meter_id"), ["meter_id", "event_id"])


@query
def top_latest(s, d):
    return windows.top_latest(tables.readings(s, d).select("event_id", "meter_id", "event_timestamp", "kwh"), 10)


@query
def newest_anomalies(s, d):
    asia = warehouse.view_anomaly_events(tables.star(s, d)).where(F.col("region_name") == "ASIA")
    return windows.newest(asia, "detected_at", 100, ["anomaly_id"]).drop("expected_kwh")


# -- joins ----------------------------------------------------------------------------------------------
@query
def range_join(s, d):
    star = tables.star(s, d)
    active = star["dim_customer"].select(
        "customer_id", "signup_date", F.date_add("signup_date", F.col("household_size") * 7).alias("trial_end"))
    spine = active.agg(F.min("signup_date").alias("a"), F.max("trial_end").alias("b")).select(F.explode(F.sequence("a", "b")).alias("full_date"))
    days = dimensions.dim_date(spine, "full_date")
    return joins.range_join(active, days.select("full_date", "date_id", "is_weekend"), "full_date", "signup_date", "trial_end")


@query
def range_join_times(s, d):
    """Readings within up to an hour after each heartbeat in the same region, by time."""
    r = tables.readings(s, d)
    quiet = r.where(F.col("event_type") == "heartbeat").select(
        F.col("event_id").alias("heartbeat_id"), "region_name", F.col("event_timestamp").alias("watch_from"), (F.col("event_timestamp") + F.make_dt_interval(mins=F.col("n") % 7 * 10)).alias("watch_to"))
    # a reading's time is made text before it meets its heartbeats, not once for each of them
    stamp = F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss").alias("event_timestamp")
    others = r.where(F.col("event_type") != "heartbeat").select("region_name", "event_id", F.col("event_timestamp").alias("at"), stamp)
    return joins.range_join_times(quiet, others, "at", "watch_from", "watch_to", ["region_name"]).select("heartbeat_id", "event_id", "event_timestamp")


@query
def meter_slots(s, d):
    slots = joins.with_slots(tables.star(s, d)["dim_meter"].select("meter_id"), 6)
    start = F.lit("2026-01-14").cast("timestamp")
    return slots.withColumn("event_timestamp", start + F.make_dt_interval(F.lit(0), (F.col("slot_number") - 1) * 4)).withColumn(
        "reading_id", F.concat(F.lit("READ-"), "meter_id", F.lit("-"), fn.pad_id("", "slot_number", 2)))


@query
def anomaly_readings(s, d):
    star = tables.star(s, d)
    a = star["fact_anomaly"].select("anomaly_id", "reading_id", "anomaly_score")
    return a.join(star["fact_reading"].select("reading_id", "meter_id", "event_timestamp", "kwh", "voltage"), "reading_id")


@query
def inactive_parent(s, d):
    star = tables.star(s, d)
    return joins.active_child_inactive_parent(
        star["dim_meter"].select("meter_id", "customer_id", "is_active"), star["dim_customer"], "customer_id")


@query
def lookup_rejects(s, d):
    faulty = tables.faulty_consumption(s, d).select("consumption_id", "customer_id", "kwh")
    _, unknown = joins.lookup(faulty, tables.dim_customer(s, d), "customer_id", ["customer_segment"], "reject")
    return unknown


# -- star schema --------------------------------------------------------------------------------------------
@query
def dim_date(s, d):
    return tables.star(s, d)["dim_date"]


@query
def dim_region(s, d):
    customers, _, _ = cleaning.transform_metadata(*tables.raw_metadata(s, d))
    return dimensions.dim_region(customers)


@query
def surrogate_keys(s, d):
    """Meter types get keys after those of the two types known already."""
    parts = tables.read(s, d, "part")
    known = parts.where(F.col("p_type") < "M").select("p_type").distinct()
    existing = windows.sequence_number(known, [windows.descending("p_type")], "type_id")
    return dimensions.assign_keys(parts.select("p_type"), "p_type", existing, "type_id")


@query
def upsert_dim(s, d):
    customers = tables.dim_customer(s, d).select("customer_id", "customer_segment", "household_size", "is_active")
    target = customers.where(F.col("customer_segment") != "Public Sector").withColumn("created_at", F.lit("2023-01-01").cast("timestamp"))
    source = customers.where("is_active").withColumn("household_size", F.col("household_size") + 1).withColumn("created_at", fn.now(AS_OF))
    return dimensions.upsert(target, source, ["customer_id"], preserve=["created_at"])


def _dimension_rows(s, d):
    """(target, source): a dimension without its public customers, and new rows of the active ones."""
    customers = tables.dim_customer(s, d).select("customer_id", "customer_segment", "household_size", "is_active")
    return customers.where(F.col("customer_segment") != "Public Sector"), customers.where("is_active").withColumn("household_size", F.col("household_size") + 1)


@query
def upsert_changes(s, d):
    """A dimension in hash buckets; rows arrive twice, the larger household counts, and unchanged rows write nothing."""
    path = scratch_path(s, "dim_buckets")
    target, source = _dimension_rows(s, d)
    target = target.withColumn("created_at", F.lit("2023-01-01").cast("timestamp"))
    sinks.replace_buckets(target, path, ["customer_id"], 8)
    again = source.withColumn("created_at", fn.now(AS_OF))
    again = again.unionByName(again.withColumn("household_size", F.col("household_size") - 1))
    for _ in range(2):  # the second time all is the same
        changes = dimensions.row_changes(sinks.read_buckets(s, path), again, ["customer_id"], ["created_at"], [F.desc("household_size")])
        sinks.replace_buckets(changes.where(F.col("change") != "same").drop("change"), path, ["customer_id"], 8)
    return sinks.read_buckets(s, path)


@query
def dim_history(s, d):
    """The same change as history: replaced rows are closed, new ones open; seen twice, recorded once."""
    target, source = _dimension_rows(s, d)
    history = target.withColumns({"valid_from": F.lit("2023-01-01").cast("timestamp"), "valid_to": F.lit(None).cast("timestamp")})
    once = dimensions.record_history(history, source, ["customer_id"], AS_OF)
    return dimensions.record_history(once, source, ["customer_id"], "2024-03-01 00:00:00")


@query
def insert_missing(s, d):
    star = tables.star(s, d)
    loaded = star["fact_reading"].where(F.col("event_type") == "reading").select("reading_id", "meter_id", "kwh")
    return joins.insert_missing(loaded.withColumn("kwh", F.lit(0).cast("decimal(12,4)")),
                                star["fact_reading"].select("reading_id", "meter_id", "kwh"), ["reading_id"])


@query
def consumption_fact(s, d):
    daily = agg.daily_customer(tables.silver_readings(s, d))
    return dimensions.build_consumption_fact(daily, tables.dim_customer(s, d), tables.dim_region(s, d), tables.dim_tariff(s), "batch_7")


@query
def readings_fact(s, d):
    star, events = tables.star(s, d), tables.clean_stream_events(s, d)
    loaded, _ = dimensions.reading_rows(events.where(F.col("event_type") == "heartbeat"), star["dim_region"])
    everything, _ = dimensions.load_readings(loaded, events, star["dim_region"])
    return everything


@query
def anomalies_fact(s, d):
    found = cleaning.detect_anomalies(tables.clean_stream_events(s, d), as_of=AS_OF)
    known_regions = tables.dim_region(s, d).where(F.col("region_name") != "ASIA")
    rows, _ = dimensions.anomaly_rows(found, known_regions)
    return rows.drop("expected_kwh")


@query
def replace_batch(s, d):
    fact = tables.fact_consumption(s, d).select("consumption_id", "meter_id", "kwh", "batch_id")
    redone = fact.where(F.col("batch_id") == "batch_1996").withColumn("kwh", (F.col("kwh") + 1).cast("decimal(12,4)"))
    return dimensions.replace_batch(fact, redone, "batch_1996")


@query
def replay_events(s, d):
    raw = tables.dirty_consumption(s, d)
    return cleaning.rows_to_events(raw, ["source_file", "customer_id", "ingestion_timestamp", "kwh", "meter_id"], AS_OF)


# -- analytics, views, serving ---------------------------------------------------------------------------------
def _analytics(name: str, function: Callable[..., DataFrame]) -> None:
    def run(s, d):
        return function(tables.star(s, d))
    run.__name__ = name
    query(run)


for _name, _function in {
    "star_daily": warehouse.daily_by_region, "star_monthly": warehouse.monthly_by_region, "top_meters": warehouse.top_meters,
    "latest_by_meter": warehouse.latest_by_meter, "running_daily": warehouse.running_by_region,
    "segment_average": warehouse.segment_average, "tariff_cost": warehouse.tariff_cost,
    "anomaly_by_region": warehouse.anomalies_by_region, "weekday_weekend": warehouse.weekday_weekend,
    "freshness": lambda t: warehouse.freshness_by_source(t, AS_OF), "run_statistics": lambda t: warehouse.run_statistics(t, AS_OF),
    "check_statistics": warehouse.check_statistics,
    "failed_runs": lambda t: warehouse.failed_rows(t["pipeline_run"], "started_at", "pipeline_run_id"),
    "failed_checks": lambda t: warehouse.failed_rows(t["quality_check"], "checked_at", "check_id"),
    "view_daily": warehouse.view_daily_region, "view_monthly": warehouse.view_monthly_region,
    "view_customer": warehouse.view_customer_usage, "view_latest": warehouse.view_latest_reading,
    "view_anomaly": lambda t: warehouse.view_anomaly_events(t).drop("expected_kwh"), "view_quality": warehouse.view_quality_summary,
    "view_runs": lambda t: warehouse.view_run_summary(t, AS_OF), "kpis": warehouse.view_kpis,
}.items():
    _analytics(_name, _function)


def _serving(name: str, function: Callable[..., DataFrame]) -> None:
    def run(s, d):
        return function(warehouse.serving_views(tables.star(s, d), AS_OF))
    run.__name__ = name
    query(run)


for _name, _function in {
    "p_regions": serving.regions,
    "p_daily": lambda v: serving.daily(v, "ASIA", "1996-01-01", "1996-12-31", 1000),
    "p_daily_default": lambda v: serving.daily(v, limit=100),
    "p_daily_bad_date": lambda v: serving.daily(v, start_date="not a date"),
    "p_monthly": lambda v: serving.monthly(v, "EUROPE"),
    "p_customer": lambda v: serving.customer(v, "CUST-000042"),
    "p_latest": lambda v: serving.latest(v, limit=5000),
    "p_latest_meter": lambda v: serving.latest(v, "MTR-000007"),
    "p_anomalies": lambda v: serving.anomalies(v, "AFRICA", "2024-01-05", "2024-01-20", 500).drop("expected_kwh"),
    "p_kpis": serving.kpis,
    "p_runs": lambda v: serving.runs(v, "failed", 50),
    "p_checks": lambda v: serving.checks(v, "failed", 100),
    "p_freshness": lambda v: serving.freshness(v, AS_OF),
    "measure_total_kwh": serving.total_kwh,
    "measure_average_daily_kwh": serving.average_daily_kwh,
    "measure_total_anomalies": serving.total_anomalies,
    "measure_active_meters": serving.active_meters,
    "measure_latest_reading_timestamp": serving.latest_reading_timestamp,
    "measure_failed_pipeline_runs": serving.failed_pipeline_runs,
    "measure_failed_quality_checks": serving.failed_quality_checks,
    "measure_anomaly_rate": serving.anomaly_rate,
    "measure_anomaly_count_by_region": serving.anomaly_count_by_region,
    "measure_top_latest_meters": serving.top_latest_meters,
}.items():
    _serving(_name, _function)


@query
def p_sql(s, d):
    """The same views by SQL text with named, optional parameters."""
    warehouse.register_views(tables.star(s, d), AS_OF)
    return serving.query(s, """
        SELECT region_name, sum(total_kwh) AS total_kwh FROM serving_daily_region
        WHERE (:region IS NULL OR region_name = :region) AND reading_date >= try_cast(:start AS date)
        GROUP BY region_name""", {"region": None, "start": "1998-01-01"})


# -- quality -------------------------------------------------------------------------------------------------------
def _quality_tables(s, d):
    return ChainMap({"fact_consumption": tables.faulty_consumption(s, d)}, tables.star(s, d))


@query
def null_meter_check(s, d):
    t = _quality_tables(s, d)
    return quality.null_check({"fact_consumption": (t["fact_consumption"], "consumption_id"), "fact_reading": (t["fact_reading"], "reading_id"),
                               "fact_anomaly": (t["fact_anomaly"], "anomaly_id")}, "meter_id").drop("meter_id")


@query
def null_customer_check(s, d):
    t = _quality_tables(s, d)
    return quality.null_check({"fact_consumption": (t["fact_consumption"], "consumption_id"), "fact_reading": (t["fact_reading"], "reading_id")},
                              "customer_id").drop("customer_id")


@query
def negative_check(s, d):
    t = _quality_tables(s, d)
    return quality.negative_check({"fact_consumption": (t["fact_consumption"], "consumption_id"), "fact_reading": (t["fact_reading"], "reading_id"),
                                   "fact_anomaly": (t["fact_anomaly"], "anomaly_id")})


@query
def future_check(s, d):
    t = _quality_tables(s, d)
    return quality.future_check({"fact_consumption": (t["fact_consumption"], "consumption_id", "reading_timestamp"),
                                 "fact_reading": (t["fact_reading"], "reading_id", "event_timestamp")}, "2001-01-01 00:00:00")


FACT_RELATIONSHIPS = tuple(
    joins.ForeignKey(f"{fact}_missing_{dim}", fact, record, key, f"dim_{dim}", key, dim == "tariff")
    for fact, record, dims in (
        ("fact_consumption", "consumption_id", ("meter", "customer", "region", "tariff", "date")),
        ("fact_reading", "reading_id", ("meter", "customer", "region", "date")))
    for dim in dims for key in (f"{dim}_id",)
)


@query
def orphan_rows(s, d):
    """Whole fact rows whose customer is unknown; a row without a customer is none of them."""
    fact = tables.faulty_consumption(s, d).select("consumption_id", "customer_id", "kwh")
    return joins.orphans(fact, tables.dim_customer(s, d), "customer_id", "customer_id", skip_null=True)


@query
def orphan_report(s, d):
    return joins.referential_report(_quality_tables(s, d), FACT_RELATIONSHIPS)


@query
def quality_suite(s, d):
    t = _quality_tables(s, d)
    fact = t["fact_consumption"]
    checks = [
        quality.has_rows("consumption_has_rows", "fact_consumption"),
        quality.no_row_where("consumption_no_negative_kwh", "fact_consumption", F.col("kwh") < 0),
        quality.no_row_where("consumption_no_null_meter_id", "fact_consumption", F.col("meter_id").isNull()),
        quality.any_value("consumption_latest_timestamp_present", "fact_consumption", "reading_timestamp"),
        quality.no_orphans_of("fact_consumption", t, [joins.ForeignKey("consumption_no_missing_region", "fact_consumption", "consumption_id", "region_id", "dim_region", "region_id")]),
        quality.no_duplicates("reading_no_duplicate_id", "fact_reading", t["fact_reading"], ["reading_id"]),
        quality.no_duplicates("consumption_no_duplicate_id", "fact_consumption", fact, ["consumption_id"]),
        quality.no_row_where("run_failed", "pipeline_run", F.col("status") == "failed"),
        quality.Check("run_record_exists", "pipeline_run", F.when(F.count_if(F.col("pipeline_run_id") == "RUN-00000007") > 0, 0).otherwise(1)),
    ]
    return quality.run_checks(t, checks, "RUN-00000007", AS_OF)


@query
def audit_unique(s, d):
    return quality.audit_unique(tables.fact_consumption(s, d), ["consumption_id"])


FOREIGN_KEYS = (
    # name, child, column, parent, key
    ("customer_region", "dim_customer", "region_id", "dim_region", "region_id"),
    ("meter_customer", "dim_meter", "customer_id", "dim_customer", "customer_id"),
    ("meter_region", "dim_meter", "region_id", "dim_region", "region_id"),
    ("consumption_meter", "fact_consumption", "meter_id", "dim_meter", "meter_id"),
    ("consumption_customer", "fact_consumption", "customer_id", "dim_customer", "customer_id"),
    ("consumption_region", "fact_consumption", "region_id", "dim_region", "region_id"),
    ("consumption_tariff", "fact_consumption", "tariff_id", "dim_tariff", "tariff_id"),
    ("consumption_date", "fact_consumption", "date_id", "dim_date", "date_id"),
    ("reading_meter", "fact_reading", "meter_id", "dim_meter", "meter_id"),
    ("reading_customer", "fact_reading", "customer_id", "dim_customer", "customer_id"),
    ("reading_region", "fact_reading", "region_id", "dim_region", "region_id"),
    ("reading_date", "fact_reading", "date_id", "dim_date", "date_id"),
    ("anomaly_reading", "fact_anomaly", "reading_id", "fact_reading", "reading_id"),
    ("anomaly_meter", "fact_anomaly", "meter_id", "dim_meter", "meter_id"),
    ("anomaly_region", "fact_anomaly", "region_id", "dim_region", "region_id"),
    ("anomaly_date", "fact_anomaly", "date_id", "dim_date", "date_id"),
    ("check_run", "quality_check", "pipeline_run_id", "pipeline_run", "pipeline_run_id"),
)


@query
def audit_fk(s, d):
    return quality.audit_fk(_quality_tables(s, d), FOREIGN_KEYS)


@query
def audit_checks(s, d):
    return quality.audit_checks(tables.faulty_consumption(s, d), {
        "kwh_not_negative": F.col("kwh") >= 0,
        "cost_not_negative": F.col("estimated_cost") >= 0,
        "date_id_in_range": F.col("date_id").between(20000101, 29991231),
        "meter_not_blank": F.length(F.trim("meter_id")) > 0,
        "source_known": F.col("source_system").isin("batch_load", "sample_batch"),
    })


@query
def audit_run_checks(s, d):
    return quality.audit_checks(tables.pipeline_run(s, d), {
        "status_known": F.col("status").isin(*schemas.RUN_STATUSES),
        "finish_after_start": F.col("finished_at") >= F.col("started_at"),
        "counts_add_up": F.col("records_read") == F.col("records_written") + F.col("records_rejected"),
        "rejects_below_50": F.col("records_rejected") < 50,
    })


@query
def audit_not_null(s, d):
    return quality.audit_not_null(tables.faulty_consumption(s, d), ["consumption_id", "meter_id", "customer_id", "tariff_id"])


@query
def with_defaults(s, d):
    runs = tables.pipeline_run(s, d).select("pipeline_run_id", "finished_at", "error_message")
    return quality.with_defaults(runs, {
        "finished_at": F.lit(AS_OF).cast("timestamp"), "error_message": "none", "records_lost": 0, "processing_status": "received"})


# -- bookkeeping ---------------------------------------------------------------------------------------------------------
@query
def run_ids(s, d):
    orders = tables.read(s, d, "orders")
    return orders.select("o_orderkey", runlog.run_id(F.lit("daily_load"), F.col("o_orderkey").cast("string")).alias("run_id"),
                         runlog.check_id(F.col("o_orderkey").cast("string"), F.lit("no_nulls")).alias("check_id"))


@query
def run_log(s, d):
    """Start and finish states of all runs in one log, and the state each run is in."""
    runs = tables.pipeline_run(s, d)
    starts = runs.withColumns({"status": F.lit("running"), "finished_at": F.lit(None).cast("timestamp"), "error_message": F.lit(None).cast("string")})
    ends = runs.where(F.col("finished_at").isNotNull()).withColumn("started_at", F.lit(None).cast("timestamp"))
    log = starts.unionByName(ends).select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c == "error_message" else F.col(c) for c in runs.columns])
    return runlog.current_runs(log).select("pipeline_run_id", "status", "started_at", "records_read")


@query
def observed_counts(s, d):
    """Rows counted while they are written, with no second scan."""
    facts = tables.faulty_consumption(s, d).select("consumption_id", "meter_id", "kwh")
    observed, seen = runlog.observe_counts(facts, "facts_written", negative=F.col("kwh") < 0, without_meter=F.col("meter_id").isNull())
    sinks.write_table(observed, scratch_path(s, "observed"))
    return readers.values_table(s, [(seen.get["rows"], seen.get["negative"], seen.get["without_meter"])], "rows bigint, negative bigint, without_meter bigint")


@query
def record_checks(s, d):
    checks = tables.quality_check(s, d).select("check_id", "status")
    known = windows.distinct_by(checks.where(F.col("status") == "failed"), ["check_id"])
    results = windows.distinct_by(checks, ["check_id"])
    return runlog.record_checks(known, results)


# -- streams: events land as files, run through a stream, and must equal the batch result -------------------------------------
_RUNS: dict[tuple[str, str, str], object] = {}


def _once(s: SparkSession, d: str, name: str, build: Callable[[], object]):
    """Stream runs shared by several queries of one session."""
    key = (s.sparkContext.applicationId, d, name)
    if key not in _RUNS:
        _RUNS[key] = build()
    return _RUNS[key]


def _landing(s, d) -> str:
    def build():
        path = scratch_path(s, "landing")
        sinks.write_events(tables.event_payloads(s, d).select(F.col("raw_event_payload").alias("value")), path)
        return path
    return _once(s, d, "landing", build)


def _medallion(s, d) -> micro_batch.Sinks:
    def build():
        root = scratch_path(s, "medallion")
        out = micro_batch.Sinks.under(root)
        micro_batch.run_medallion(readers.event_stream(s, "json_landing", _landing(s, d), as_of=AS_OF), out, f"{root}/checkpoint", REGIONS, AS_OF)
        return out
    return _once(s, d, "medallion", build)


def _complete(s, d, name: str) -> DataFrame:
    out = _medallion(s, d)
    return micro_batch.read_batches(s, getattr(out, name), out.metrics)


def _captured(s, d) -> str:
    def build():
        root = scratch_path(s, "bronze")
        stream = readers.text_event_stream(s, _landing(s, d), as_of=AS_OF)
        sinks.capture_bronze(stream, f"{root}/data", f"{root}/checkpoint").awaitTermination()
        return f"{root}/data"
    return _once(s, d, "bronze", build)


def _stream_facts(s, d) -> stream_load.Loaded:
    """The whole stream loaded twice; regions leave one out, so that some rows stay behind."""
    def build():
        root = scratch_path(s, "stream_facts")
        known = tables.dim_region(s, d).where("region_name != 'ASIA'")
        for load in ("load_1", "load_2"):
            out = stream_load.load_stream(s, _medallion(s, d), known, f"{root}/readings", f"{root}/anomalies", load)
        return out
    return _once(s, d, "stream_facts", build)


@query
def stream_fact_readings(s, d):
    return _stream_facts(s, d).readings.select("reading_id", "meter_id", "region_id", "date_id", "event_timestamp", "kwh", "voltage")


@query
def stream_fact_anomalies(s, d):
    return _stream_facts(s, d).anomalies.select("anomaly_id", "meter_id", "region_id", "anomaly_type", "kwh")


@query
def stream_fact_incremental(s, d):
    """Four batches, loaded two by two; each load opens its own batches only, and a third finds nothing to do."""
    def build():
        root = scratch_path(s, "stream_new")
        out = micro_batch.Sinks.under(f"{root}/silver")
        known = tables.dim_region(s, d).where("region_name != 'ASIA'")
        payloads = tables.event_payloads(s, d).select(F.col("raw_event_payload").alias("value"))
        half = F.xxhash64("value") % 2 == 0
        for load, rows in (("load_1", payloads.where(half)), ("load_2", payloads.where(~half))):
            sinks.write_events(rows.repartition(2 * _LANDED), f"{root}/landing")
            stream = readers.text_event_stream(s, f"{root}/landing", as_of=AS_OF, max_files=_LANDED)
            micro_batch.run_medallion(stream, out, f"{root}/checkpoint", REGIONS, AS_OF)
            stream_load.load_new(s, out, known, f"{root}/readings", f"{root}/anomalies", f"{root}/processed", load)
        assert stream_load.load_new(s, out, known, f"{root}/readings", f"{root}/anomalies", f"{root}/processed", "load_3") is None
        return f"{root}/readings"
    facts = s.read.parquet(_once(s, d, "stream_new", build))
    return facts.select("reading_id", "meter_id", "region_id", "date_id", "event_timestamp", "kwh", "voltage")


@query
def stream_unknown_regions(s, d):
    return _stream_facts(s, d).unknown


@query
def stream_capture(s, d):
    return readers.read_table(s, _captured(s, d), schemas.ENVELOPE).select("raw_event_payload", "ingestion_timestamp", "source_system")


@query
def stream_metadata(s, d):
    """Captured envelopes name the file each event came from: events for each file, and whether they are those of the file itself."""
    captured = readers.read_table(s, _captured(s, d), schemas.ENVELOPE)
    name = F.element_at(F.split("producer_metadata", "/"), -1)
    mine = captured.groupBy(name.alias("file")).agg(F.count("*").alias("events"))
    landed = s.read.text(_landing(s, d)).groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("lines"))
    return mine.join(landed, "file", "full").agg(F.sum("events").alias("events"), F.count_if(~F.col("events").eqNullSafe(F.col("lines"))).alias("files_that_differ"))


@query
def stream_resumed(s, d):
    """A stream on a clock, stopped after a time, and started again when more files have come: every event once."""
    def build():
        root = scratch_path(s, "resumed")
        payloads = tables.event_payloads(s, d).select(F.col("raw_event_payload").alias("value"))
        half = F.xxhash64("value") % 2 == 0

        def write(batch: DataFrame, batch_id: int) -> None:
            sinks.write_batch(batch, f"{root}/data", batch_id)

        for rows, options in ((payloads.where(half), {"trigger": {"processingTime": "1 second"}, "duration": 12}), (payloads.where(~half), {})):
            sinks.write_events(rows, f"{root}/landing")
            micro_batch.run_stream(readers.text_event_stream(s, f"{root}/landing", as_of=AS_OF), write, f"{root}/checkpoint", **options)
        return f"{root}/data"
    return s.read.parquet(_once(s, d, "resumed", build)).select("raw_event_payload", "ingestion_timestamp", "source_system")


@query
def stream_offset_range(s, d):
    """A landed log in four partitions, read from offset 100 of each to its middle, and after a restart from there to its end."""
    def build():
        root = scratch_path(s, "offsets")
        log = tables.offset_log(s, d)
        offset_log.land_log(log, f"{root}/log", 2_500)
        middle = {str(r["partition"]): r["n"] // 2 for r in log.groupBy("partition").agg(F.count("*").alias("n")).collect()}
        for ending in (middle, None):
            stream = offset_log.offset_log_stream(s, f"{root}/log", dict.fromkeys(middle, 100), ending, 2_500)
            sinks.capture_bronze(readers.kafka_to_envelope(stream, as_of=AS_OF), f"{root}/data", f"{root}/checkpoint").awaitTermination()
        return f"{root}/data"
    return s.read.parquet(_once(s, d, "offsets", build)).select("raw_event_payload", "partition_id", "offset", "source_system")


@query
def stream_invalid(s, d):
    """Dead-letter rows of the stateful path, as a stream of their own."""
    def build():
        root = scratch_path(s, "invalid")
        lost = stateful.invalid_event_stream(readers.bronze_event_stream(s, _captured(s, d)), REGIONS, AS_OF)
        stateful.to_table(lost, f"{root}/data", f"{root}/checkpoint")
        return f"{root}/data"
    return s.read.parquet(_once(s, d, "invalid", build))


@query
def stream_clean(s, d):
    return _complete(s, d, "clean").drop("batch_id")


@query
def stream_rejected(s, d):
    return _complete(s, d, "rejected").drop("batch_id")


@query
def stream_anomalies(s, d):
    return _complete(s, d, "anomalies").select("anomaly_id", "region_name", "anomaly_type", "anomaly_score", "kwh")


@query
def stream_latest(s, d):
    parts = _complete(s, d, "latest")
    return micro_batch.merge_latest(parts).select("meter_id", "event_id", "event_timestamp", "kwh")


@query
def stream_hourly(s, d):
    return _without_audit(micro_batch.merge_hourly(_complete(s, d, "clean")))


@query
def stream_hourly_merged(s, d):
    """Hours out of the parts that several batches left; silver is not read again."""
    def build():
        root = scratch_path(s, "hour_parts")
        where = partials.HourParts.under(root)
        sinks.write_table(partials.meter_numbers(tables.dim_meter(s, d)), f"{root}/numbers")
        numbers = s.read.parquet(f"{root}/numbers")

        def add(batch: DataFrame, batch_id: int) -> None:
            clean = cleaning.clean_events(cleaning.validate_events(batch, REGIONS), AS_OF)
            partials.add_hours(clean, batch_id, where, numbers)

        # three batches of files that many tasks write: a repeat of an event often lies in another batch
        sinks.write_events(tables.event_payloads(s, d).select(F.col("raw_event_payload").alias("value")).repartition(3 * _LANDED), f"{root}/landing")
        micro_batch.run_stream(readers.text_event_stream(s, f"{root}/landing", as_of=AS_OF, max_files=_LANDED), add, f"{root}/checkpoint")
        return where
    return _without_audit(partials.merged_hours(s, _once(s, d, "hour_parts", build), AS_OF))


@query
def stream_metrics(s, d):
    parts = micro_batch.read_batches(s, _medallion(s, d).metrics)
    return parts.agg(*[F.sum(c).alias(c) for c in ("total_events", "valid_events", "rejected_events", "anomaly_events")])


@query
def stream_dedup(s, d):
    """Repeats dropped by keyed state over the captured bronze stream; the event time lies in January 2024."""
    def build():
        root = scratch_path(s, "dedup")
        events = stateful.typed_event_stream(readers.bronze_event_stream(s, _captured(s, d)))
        unique = stateful.dedup_events(events.where(F.col("event_timestamp").isNotNull()), "60 days")
        stateful.to_table(unique.select("event_id", "customer_id", "event_timestamp"), f"{root}/data", f"{root}/checkpoint")
        return f"{root}/data"
    return s.read.parquet(_once(s, d, "dedup", build))


@query
def stream_hours_closed(s, d):
    """Hours the watermark has closed: valid events, each id once, summed in two stateful steps."""
    def build():
        root = scratch_path(s, "hours")
        events = stateful.valid_event_stream(readers.bronze_event_stream(s, _captured(s, d)), REGIONS)
        once = stateful.dedup_events(events, "2 hours")
        stateful.to_table(stateful.hourly_stream(once, None), f"{root}/data", f"{root}/checkpoint")
        return f"{root}/data"
    return s.read.parquet(_once(s, d, "hours", build))


@query
def stream_latest_state(s, d):
    """Latest reading per meter kept as stream state; every batch rewrites the small result table."""
    def build():
        root = scratch_path(s, "state")
        events = stateful.typed_event_stream(readers.bronze_event_stream(s, _captured(s, d)))
        usable = events.where(F.col("event_timestamp").isNotNull() & (F.col("kwh") >= 0))
        latest = stateful.latest_stream(usable.select("meter_id", "event_id", "event_timestamp", "event_type", "kwh"))
        run = latest.writeStream.outputMode("complete").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
        run.foreachBatch(lambda df, n: sinks.write_table(df, f"{root}/data")).start().awaitTermination()
        return f"{root}/data"
    return s.read.parquet(_once(s, d, "state", build)).select("meter_id", "event_id", "event_timestamp", "kwh")


@query
def stream_latest_ttl(s, d):
    """Latest reading per meter in hash buckets; a meter nothing was heard of for ten days of event time is not in it."""
    def build():
        root = scratch_path(s, "latest_ttl")
        events = stateful.typed_event_stream(readers.bronze_event_stream(s, _captured(s, d)))
        usable = events.where(F.col("event_timestamp").isNotNull() & (F.col("kwh") >= 0))
        stateful.keep_latest(usable.select("meter_id", "event_id", "event_timestamp", "event_type", "kwh"), f"{root}/data", f"{root}/checkpoint", "2 hours", 10 * 86_400, buckets=8)
        return f"{root}/data"
    return sinks.read_buckets(s, _once(s, d, "latest_ttl", build)).select("meter_id", "event_id", "event_timestamp", "kwh")


# -- whole pipeline ------------------------------------------------------------------------------------------------------------
def _write_csv(df: DataFrame, path: str) -> None:
    # keep blanks as they are: whitespace is part of the dirt
    df.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def _pipeline(s, d) -> batch.Result:
    def build():
        bronze, root = scratch_path(s, "bronze_csv"), scratch_path(s, "lake")
        customers, meters, tariffs = tables.raw_metadata(s, d, blanks=False)
        sinks.together([partial(_write_csv, df, f"{bronze}/{name}") for name, df in {
            "historical_consumption": tables.dirty_consumption(s, d).select(*schemas.BRONZE_CONSUMPTION.names),
            "weather": tables.bronze_weather(s, d).select(*schemas.BRONZE_WEATHER.names),
            "customers.csv": customers, "meters.csv": meters, "tariffs.csv": tariffs}.items()])
        return batch.run_batch(s, bronze, root, "batch_1", REGIONS, AS_OF, log=f"{root}/log")
    return _once(s, d, "lake", build)


@query
def batch_facts(s, d):
    """Consumption facts out of the whole pipeline, from CSV to the quality gate."""
    return _pipeline(s, d).tables["fact_consumption"]


@query
def batch_gold_daily(s, d):
    return _pipeline(s, d).tables["daily_region_consumption"]


@query
def batch_gate(s, d):
    return _pipeline(s, d).checks.drop("check_id")


@query
def batch_run_log(s, d):
    """The run's state as the pipeline itself recorded it."""
    return _pipeline(s, d).log.select("pipeline_name", "status", "started_at", "finished_at", "records_read", "records_written")


@query
def batch_check_history(s, d):
    return _pipeline(s, d).history.select("check_name", "status", "failed_count")


# -- sources and sinks: what is read back must equal what was written -------------------------------------------------------------
@query
def io_csv_tree(s, d):
    path = scratch_path(s, "csv")
    raw = tables.dirty_consumption(s, d).select(*schemas.BRONZE_CONSUMPTION.names)
    _write_csv(raw.where(F.col("source_file") != "file_resent"), f"{path}/year=2024/month=01")
    _write_csv(raw.where(F.col("source_file") == "file_resent"), f"{path}/year=2024/month=02")
    return readers.read_csv_tree(s, path, schemas.BRONZE_CONSUMPTION).drop(schemas.CORRUPT)


@query
def csv_reordered_header(s, d):
    """Three files of one tree: as declared, turned round, and with a column nobody asked for."""
    path, names = scratch_path(s, "csv"), schemas.BRONZE_CONSUMPTION.names
    raw = tables.dirty_consumption(s, d).select(*names)
    _write_csv(raw.where("source_file = 'file_resent'"), f"{path}/a")
    _write_csv(raw.where("source_file in ('file_0', 'file_1')").select(*reversed(names)), f"{path}/b")
    _write_csv(raw.where("source_file in ('file_2', 'file_3')").select(F.lit("note").alias("note"), *names), f"{path}/c")
    return readers.read_csv_tree(s, path, schemas.BRONZE_CONSUMPTION).drop(schemas.CORRUPT)


@query
def csv_surplus_fields(s, d):
    """Rows with one field more than their header stay as text. Each row is written below a header line, so every part file begins with one; the other header lines are rows of the right length."""
    path = scratch_path(s, "csv")
    line = F.concat_ws(",", "meter_id", "customer_id", F.lit("EUROPE"), F.lit("smart"), F.lit("2020-01-01"), F.lit("true"), F.lit("too much"))
    tables.dim_meter(s, d).select(F.concat(F.lit(",".join(schemas.BRONZE_METER.names) + "\n"), line).alias("value")).write.text(f"{path}/meters.csv")
    return readers.read_csv_file(s, f"{path}/meters.csv", schemas.BRONZE_METER).where(F.col(schemas.CORRUPT).isNotNull()).select(schemas.CORRUPT)


@query
def csv_quoted_header(s, d):
    """A header and values in quotes."""
    path = scratch_path(s, "csv")
    raw = tables.dirty_consumption(s, d).select(*schemas.BRONZE_CONSUMPTION.names)
    writer = raw.write.option("header", True).option("quoteAll", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.csv(path)
    return readers.read_csv_tree(s, path, schemas.BRONZE_CONSUMPTION).drop(schemas.CORRUPT)


@query
def csv_multiline(s, d):
    """Quoted values with line breaks and commas in them."""
    path = scratch_path(s, "csv")
    meters = tables.dim_meter(s, d).select("meter_id", F.concat("customer_id", F.lit("\nsecond, line"), F.when(F.col("region_id") > 2, "\n").otherwise("")).alias("customer_id"),
                                           F.lit("EUROPE").alias("region_name"), "meter_type", F.col("installation_date").cast("string").alias("installation_date"), F.lit("true").alias("is_active"))
    meters.select(*schemas.BRONZE_METER.names).write.option("header", True).option("quoteAll", True).option("ignoreTrailingWhiteSpace", False).csv(path)
    return readers.read_csv_tree(s, path, schemas.BRONZE_METER, multi_line=True).select("meter_id", "customer_id", "meter_type", schemas.CORRUPT)


@query
def reject_unstorable_kwh(s, d):
    """Values no fact can hold are rejected, not a failed job."""
    n = F.col("n")
    kwh = F.when(n % 59 == 0, "1e300").when(n % 61 == 0, "1e12").when(n % 67 == 0, "Infinity").otherwise(F.col("kwh").cast("string"))
    typed = tables.readings(s, d).withColumns({"raw": kwh, "kwh": kwh.try_cast("double")}).withColumnRenamed("event_timestamp", "reading_timestamp")
    judged = typed.withColumn("rejection_reason", fn.rejection_reason(fn.consumption_rules(REGIONS)))
    return judged.where("rejection_reason != ''").select("event_id", F.col("raw").alias("kwh"), "rejection_reason")


@query
def rejected_metadata(s, d):
    return cleaning.rejected_metadata(*tables.raw_metadata(s, d), AS_OF).select("source_system", "source_reference", "rejection_reason")


@query
def batch_dimension_rejects(s, d):
    customers = tables.dim_customer(s, d).join(tables.dim_region(s, d).select("region_id", "region_name"), "region_id").drop("region_id")
    known = tables.dim_region(s, d).where("region_name != 'ASIA'")
    _, lost = joins.lookup(customers, known, "region_name", ["region_id"], "reject")
    return dimensions.lookup_rejects(lost, "dim_customer", "customer_id", "batch_1", AS_OF).select("source_reference", "rejection_reason")


@query
def late_rows(s, d):
    """Every third reading as a batch of its own; what a watermark of ten days would have dropped."""
    silver = tables.readings(s, d).withColumn("batch_id", F.col("n") % 3)
    return micro_batch.late_rows(silver, "10 DAYS").select("event_id", "batch_id")


@query
def lookup_drop(s, d):
    known = tables.dim_region(s, d).where("region_name != 'ASIA'")
    return joins.lookup(tables.dim_meter(s, d).select("meter_id", "region_id"), known, "region_id", ["region_name"], "drop").select("meter_id", "region_name")


@query
def load_anomalies(s, d):
    """Half of the anomalies are there; loading all of them twice adds the other half once."""
    regions = tables.dim_region(s, d)
    found = cleaning.detect_anomalies(tables.clean_stream_events(s, d), as_of=AS_OF)
    there, _ = dimensions.anomaly_rows(found.where("kwh > 10"), regions)
    once, _ = dimensions.load_anomalies(there, found, regions)
    twice, _ = dimensions.load_anomalies(once, found, regions)
    return twice.select("anomaly_id", "meter_id", "region_id")


@query
def unknown_regions(s, d):
    found = cleaning.detect_anomalies(tables.clean_stream_events(s, d), as_of=AS_OF)
    _, unknown = dimensions.anomaly_rows(found, tables.dim_region(s, d).where("region_name != 'ASIA'"))
    return unknown.select("anomaly_id", "region_name")


@query
def io_parquet_table(s, d):
    path = scratch_path(s, "table")
    silver = tables.silver_readings(s, d)
    sinks.write_table(silver, path, ["reading_date"], sort_by=["meter_id"])
    return readers.read_table(s, path, silver.schema)


@query
def io_versioned_table(s, d):
    """Published twice: first with half of the rows, then with all; the catalog points at the second version."""
    root, silver = scratch_path(s, "versions"), tables.silver_readings(s, d)
    name = f"readings_{root.rsplit('-', 1)[-1]}"
    for rows in (silver.where("reading_hour < 12"), silver):
        versions.publish(rows, name, root, ["reading_date"], ["meter_id"])
    return s.table(name)


@query
def io_compacted_batches(s, d):
    """Four batches by day, one of them delivered again; days before the twentieth put together afterwards."""
    path = scratch_path(s, "days")
    silver = tables.silver_readings(s, d)
    for n in (0, 1, 2, 3, 2):
        versions.append_batch(silver.where(F.col("reading_hour") % 4 == n), path, f"batch_{n}", "reading_date")
    schema = silver.withColumn("batch_id", F.lit("")).schema
    versions.compact(s, path, schema, "reading_date", "2024-01-20", sort_by=["meter_id"])
    return versions.read_days(s, path, schema)


@query
def io_replace_batch(s, d):
    path = scratch_path(s, "batches")
    fact = tables.fact_consumption(s, d).select("consumption_id", "meter_id", "kwh", F.col("l_returnflag").alias("batch_id"))
    for flag in ("A", "N", "R"):
        sinks.write_batch(fact.where(F.col("batch_id") == flag), path, flag)
    redone = fact.where(F.col("batch_id") == "R").withColumn("kwh", F.lit(1).cast("decimal(12,4)"))
    for _ in range(2):  # a retry changes nothing
        sinks.write_batch(redone, path, "R")
    return s.read.parquet(path)


@query
def io_json_events(s, d):
    path = scratch_path(s, "events")
    events = tables.readings(s, d).select("event_id", "meter_id", "event_type", "n")
    sinks.write_events(events, path)
    schema = "event_id string, meter_id string, event_type string, n bigint"
    return s.read.text(path).select(F.from_json("value", schema).alias("e")).select("e.*")


@query
def kafka_envelopes(s, d):
    payloads = tables.event_payloads(s, d)
    records = payloads.select(
        F.lit(None).cast("binary").alias("key"), F.col("raw_event_payload").cast("binary").alias("value"), F.lit("meter-events").alias("topic"),
        F.col("copy").alias("partition"), F.col("n").alias("offset"), F.lit(AS_OF).cast("timestamp").alias("timestamp"), F.lit(0).alias("timestampType"))
    return readers.kafka_to_envelope(records, as_of=AS_OF)

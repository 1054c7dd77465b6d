"""The provided TPC-H-like and event tables in the shape of a meter platform.

Every frame below is derived by Spark from whole tables; nothing is sampled. Faults (blank ids, broken times,
negative or non-numeric measures, unknown regions, repeats) are put *into* some rows by expressions, the
rows themselves all stay.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake import schemas
from meterlake.functions import choose_tariff, date_id, default_if_falsy, end_of_day, estimated_cost, pad_id
from meterlake.operators.cleaning import detect_anomalies
from meterlake.operators.dimensions import dim_date
from meterlake.operators.windows import row_number_per_key
from meterlake.plans.planned import Planned

AS_OF = "2024-02-01 00:00:00"  # fixed audit time, so results repeat
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")  # names in the region table


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A provided table as it lies; how many splits a file makes is up to the session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(column: str, n: int) -> Column:
    return F.col(column) % n == 0


# -- dimensions -------------------------------------------------------------------------
def dim_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "region").select(
        (F.col("r_regionkey") + 1).cast("int").alias("region_id"), F.col("r_name").alias("region_name"),
        F.lit("UK").alias("country"), F.substring("r_name", 1, 2).alias("postcode_area"))


def _with_customers(df: DataFrame | None, spark: SparkSession, sf_dir: str, user: str | None = None) -> DataFrame:
    """Join customers (all, or those ``df`` names by number in ``user``), their nation and region.

    One table after the other, each by its own number: a small one is broadcast by its file size, so the large
    side is not shuffled for it, and a large one is shuffled on the key alone.
    """
    customer, nation, region = (read(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    if user is not None:
        customer = df.join(customer, df[user] == customer.c_custkey)
    located = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    return located.join(region, located.n_regionkey == region.r_regionkey)


def _customer_columns() -> dict[str, Column]:
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "Small Business").when(
        F.col("c_mktsegment") == "MACHINERY", "Public Sector").otherwise("Residential")
    return {
        "customer_id": pad_id("CUST-", "c_custkey", 6), "customer_segment": segment,
        "household_size": (F.col("c_custkey") % 5 + 1).cast("int"), "region_id": (F.col("r_regionkey") + 1).cast("int"),
    }


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared = _customer_columns()
    region_id = shared.pop("region_id")
    return _with_customers(None, spark, sf_dir).select(
        *[column.alias(name) for name, column in shared.items()],
        F.when(F.col("c_acctbal") < 5000, "flat").otherwise("house").alias("dwelling_type"), region_id.alias("region_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 1000).cast("int")).alias("signup_date"),
        (F.col("c_acctbal") >= 0).alias("is_active"))


def dim_meter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        pad_id("MTR-", "p_partkey", 6).alias("meter_id"), pad_id("CUST-", "p_partkey", 6).alias("customer_id"),
        (F.col("p_size") % 5 + 1).cast("int").alias("region_id"), F.col("p_type").alias("meter_type"),
        F.date_add(F.lit("2015-01-01").cast("date"), F.col("p_size").cast("int")).alias("installation_date"),
        (F.col("p_size") > 10).alias("is_active"))


def dim_tariff(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(list(schemas.TARIFFS), "tariff_id string, tariff_name string, price string, standing string")
    return rows.select(
        "tariff_id", "tariff_name", F.lit("2026-01-01").cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"),
        F.col("price").cast("decimal(10,4)").alias("price_per_kwh"),
        F.col("standing").cast("decimal(10,4)").alias("standing_charge_daily"), F.lit(True).alias("is_active"))


# -- readings ---------------------------------------------------------------------------
def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per event of a known customer."""
    kwh = F.col("value").cast("decimal(12,4)") * F.lit("0.05").cast("decimal(3,2)")
    kind = F.when(F.col("event_type") == "error", "anomaly").when(F.col("event_type") == "signup", "heartbeat").otherwise("reading")
    # the provided times carry no zone; the session zone is UTC
    ts = F.date_trunc("second", F.col("ts").cast("timestamp"))
    return _with_customers(read(spark, sf_dir, "events"), spark, sf_dir, "user_id").select(
        pad_id("evt_", "event_id", 8).alias("event_id"), pad_id("MTR-", "user_id", 6).alias("meter_id"),
        pad_id("CUST-", "user_id", 6).alias("customer_id"), F.col("r_name").alias("region_name"), ts.alias("event_timestamp"),
        kwh.cast("decimal(12,4)").alias("kwh"),
        F.when(~_every("event_id", 7), (230 + F.col("event_id") % 16).cast("double")).alias("voltage"),
        kind.alias("event_type"), F.col("event_id").alias("n"))


def silver_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).select(
        "meter_id", "customer_id", "region_name", F.col("event_timestamp").alias("reading_timestamp"),
        F.to_date("event_timestamp").alias("reading_date"), F.hour("event_timestamp").alias("reading_hour"),
        F.col("kwh").cast("double").alias("kwh"))


def clean_stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).withColumn("kwh", F.col("kwh").cast("double")).withColumn("source_system", F.lit("meter_stream"))


def _with_repeats(df: DataFrame) -> DataFrame:
    """Readings flagged as anomalies are delivered twice; ``copy`` numbers the deliveries."""
    copies = F.when(F.col("event_type") == "anomaly", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("copy", F.explode(copies))


def dirty_consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze consumption text with faults and repeats; the second delivery of every other one is an exact copy."""
    kwh = F.col("kwh").cast("string")
    late_file = (F.col("copy") == 1) & _every("n", 2)
    stamp = F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss")
    return _with_repeats(readings(spark, sf_dir)).select(
        F.when(late_file, "file_resent").otherwise(F.concat(F.lit("file_"), (F.col("n") % 4).cast("string"))).alias("source_file"),
        F.lit("batch_1").alias("batch_id"),
        F.when(_every("n", 17), "  ").otherwise(F.col("meter_id")).alias("meter_id"), "customer_id",
        F.when(_every("n", 29), "Unknown").otherwise(F.concat(F.lit(" "), "region_name")).alias("region_name"),
        F.when(_every("n", 23), "not-a-timestamp").otherwise(stamp).alias("reading_timestamp"),
        F.when(_every("n", 31), "abc").when(_every("n", 19), F.concat(F.lit("-"), kwh)).otherwise(kwh).alias("kwh"),
        stamp.alias("ingestion_timestamp"))


def event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw event texts: (event_no, copy, raw_event_payload), with faults, truncated JSON and repeats."""
    kwh = F.col("kwh").cast("string")
    stamp = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    produced = F.date_format(F.col("event_timestamp") + F.make_dt_interval(F.lit(0), F.col("copy")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    text = F.concat(
        F.lit('{"event_id":"'), "event_id",
        F.lit('","meter_id":"'), F.when(_every("n", 17), "  ").otherwise(F.col("meter_id")),
        F.lit('","customer_id":"'), "customer_id",
        F.lit('","region_name":"'), F.when(_every("n", 29), "Unknown").otherwise(F.col("region_name")),
        F.lit('","event_timestamp":"'), F.when(_every("n", 23), "not-a-timestamp").otherwise(stamp),
        F.lit('","kwh":'), F.when(_every("n", 31), '"abc"').when(_every("n", 19), F.concat(F.lit("-"), kwh)).otherwise(kwh),
        F.lit(',"voltage":'), F.when(_every("n", 43), "0.0").otherwise(F.coalesce(F.col("voltage").cast("string"), F.lit("null"))),
        F.lit(',"event_type":"'), F.when(_every("n", 47), "unknown").otherwise(F.col("event_type")),
        F.lit('","producer_timestamp":"'), produced, F.lit('"}'))
    broken = F.when(_every("n", 37), F.substring(text, 1, 40)).when(_every("n", 41), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    return _with_repeats(readings(spark, sf_dir)).select("n", "copy", broken.alias("raw_event_payload"))


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_payloads(spark, sf_dir).select(
        "raw_event_payload", F.lit(AS_OF).cast("timestamp").alias("ingestion_timestamp"),
        F.lit("local_file_stream").alias("source_system"), *[F.lit(None).cast("string").alias(c) for c in ("partition_id", "offset", "producer_metadata")])


def offset_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event texts as a topic of four partitions: within one, records are numbered by event and copy."""
    return event_payloads(spark, sf_dir).select(
        F.lit("meter-events").alias("topic"), (F.col("n") % 4).cast("int").alias("partition"),
        (F.floor(F.col("n") / 4) * 2 + F.col("copy")).cast("bigint").alias("at"), F.col("raw_event_payload").alias("value"),
    ).transform(lambda rows: row_number_per_key(rows, ["partition"], ["at"], "offset")).select(
        "topic", "partition", (F.col("offset") - 1).cast("bigint").alias("offset"), F.lit(AS_OF).cast("timestamp").alias("timestamp"), F.lit(0).alias("timestampType"), "value")


def bronze_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather text from events: gaps where nothing happened, and some faults."""
    hour = F.date_trunc("hour", "event_timestamp")
    hourly = readings(spark, sf_dir).groupBy("region_name", hour.alias("at")).agg(
        F.min("kwh").alias("low"), F.max("kwh").alias("high"), F.count("*").alias("c"), F.min("n").alias("n"))
    stamp = F.date_format("at", "yyyy-MM-dd HH:mm:ss")
    return hourly.select(
        F.when(_every("n", 13), "yesterday").otherwise(stamp).alias("weather_timestamp"),
        F.when(_every("n", 11), "").otherwise(F.col("region_name")).alias("region_name"),
        F.when(_every("n", 7), "cold").otherwise(F.col("low").cast("string")).alias("temperature_c"),
        F.col("high").cast("string").alias("humidity_percent"), F.col("c").cast("string").alias("wind_speed_kph"),
        F.lit("0.0").alias("precipitation_mm"), stamp.alias("ingestion_timestamp"))


def raw_metadata(spark: SparkSession, sf_dir: str, blanks: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Metadata text with repeated customers, dates that are none and, with ``blanks``, blank customer ids."""
    blank = _every("k", 53) if blanks else F.lit(False)
    c = dim_customer(spark, sf_dir).join(dim_region(spark, sf_dir), "region_id").withColumn("k", F.substring("customer_id", 6, 12).cast("bigint"))
    copies = F.explode(F.when(F.col("customer_segment") == "Residential", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    customers = c.withColumn("copy", copies).select(
        F.when(blank, " ").otherwise(F.concat(F.lit(" "), "customer_id")).alias("customer_id"),
        "customer_segment", F.col("household_size"), "dwelling_type", "region_name", "country",
        F.concat("postcode_area", F.col("copy").cast("string")).alias("postcode_area"),
        F.when(_every("k", 11), "soon").otherwise(F.col("signup_date").cast("string")).alias("signup_date"), "is_active")
    meters = dim_meter(spark, sf_dir).join(dim_region(spark, sf_dir).select("region_id", "region_name"), "region_id").select(
        "meter_id", "customer_id", "region_name", "meter_type", F.col("installation_date").cast("string").alias("installation_date"), "is_active")
    tariffs = dim_tariff(spark).select(
        "tariff_id", "tariff_name", F.col("valid_from").cast("string").alias("valid_from"), F.col("valid_to").cast("string").alias("valid_to"),
        F.col("price_per_kwh").cast("double").alias("price_per_kwh"), F.col("standing_charge_daily").cast("double").alias("standing_charge_daily"), "is_active")
    return customers, meters, tariffs


# -- facts --------------------------------------------------------------------------------
def fact_consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One consumption row per order line; lines marked N have no tariff yet."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("full_date"))
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag", "l_linestatus")
    price, standing = (_tariff_value(i) for i in (2, 3))
    kwh = F.col("l_quantity").cast("decimal(12,4)")
    ordered = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return (
        _with_customers(ordered, spark, sf_dir, "o_custkey").withColumns(_customer_columns())
        .withColumn("tariff", choose_tariff("customer_segment", "household_size"))
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("consumption_id"),
            pad_id("MTR-", "l_partkey", 6).alias("meter_id"), "customer_id", "region_id",
            F.when(F.col("l_returnflag") != "N", F.col("tariff")).alias("tariff_id"),
            date_id("full_date").alias("date_id"), end_of_day("full_date").alias("reading_timestamp"), kwh.alias("kwh"),
            estimated_cost(kwh, price, standing).alias("estimated_cost"), F.lit("batch_load").alias("source_system"),
            F.concat(F.lit("batch_"), F.year("full_date").cast("string")).alias("batch_id"), "l_linenumber", "l_returnflag", "l_linestatus",
        )
    )


def _tariff_value(position: int) -> Column:
    """Price or standing charge of column ``tariff``: three constants, so an expression, not a join."""
    value = F.lit(None).cast("string")
    for row in schemas.TARIFFS:
        value = F.when(F.col("tariff") == row[0], row[position]).otherwise(value)
    return value


def faulty_consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consumption facts with missing meters, unknown customers, regions and tariffs, negative kWh, odd dates."""
    returned, first, open_line = F.col("l_returnflag") == "R", F.col("l_linenumber") == 1, F.col("l_linestatus") == "O"
    return fact_consumption(spark, sf_dir).withColumns({
        "meter_id": F.when(returned & (F.col("l_linenumber") == 7), F.lit(None)).when(returned & first & open_line, "MTR-X").otherwise(F.col("meter_id")),
        "customer_id": F.when(returned & (F.col("l_linenumber") == 6), F.lit(None)).when(returned & (F.col("l_linenumber") == 5), "CUST-X").otherwise(F.col("customer_id")),
        "region_id": F.when(returned & (F.col("l_linenumber") == 4), F.lit(-1)).otherwise(F.col("region_id")).cast("int"),
        "tariff_id": F.when((F.col("l_returnflag") == "A") & first, "T-OLD").otherwise(F.col("tariff_id")),
        "kwh": F.when((F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 2), -F.col("kwh")).otherwise(F.col("kwh")).cast("decimal(12,4)"),
        "date_id": F.when((F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 3), F.lit(19000101)).otherwise(F.col("date_id")),
    })


def fact_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = dim_region(spark, sf_dir).select("region_id", "region_name")
    return readings(spark, sf_dir).join(regions, "region_name").select(
        F.col("event_id").alias("reading_id"), "meter_id", "customer_id", "region_id", date_id("event_timestamp").alias("date_id"),
        "event_timestamp", "kwh", default_if_falsy("voltage").cast("decimal(10,3)").alias("voltage"),
        F.lit("meter_stream").alias("source_system"), "event_id", "event_type")


def fact_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomaly facts, found five minutes after their reading."""
    regions = dim_region(spark, sf_dir).select("region_id", "region_name")
    found = detect_anomalies(clean_stream_events(spark, sf_dir), as_of=AS_OF)
    return found.join(regions, "region_name").select(
        "anomaly_id", F.col("event_id").alias("reading_id"), "meter_id", "region_id", date_id("event_timestamp").alias("date_id"),
        "anomaly_type", *[F.col(c).cast("decimal(12,4)").alias(c) for c in ("anomaly_score", "kwh", "expected_kwh")],
        (F.col("event_timestamp") + F.expr("INTERVAL 5 MINUTES")).alias("detected_at"), "source_system")


# -- monitoring ---------------------------------------------------------------------------
def pipeline_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per order: status, times and counts come from the order."""
    status = F.when(F.col("o_orderstatus") == "F", "succeeded").when(F.col("o_orderstatus") == "O", "running").otherwise("failed")
    amount = F.floor("o_totalprice").cast("int")
    started = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(secs=(F.col("o_orderkey") * 37 % 86400).cast("decimal(18,6)"))
    return read(spark, sf_dir, "orders").select(
        pad_id("RUN-", "o_orderkey", 8).alias("pipeline_run_id"),
        F.concat(F.lit("load_"), F.substring("o_orderpriority", 1, 1)).alias("pipeline_name"),
        F.when(F.substring("o_orderpriority", 1, 1).isin("1", "2"), "streaming").otherwise("batch").alias("pipeline_type"),
        status.alias("status"), started.alias("started_at"),
        F.when(F.col("o_orderstatus") != "O", started + F.make_dt_interval(secs=(amount % 7200).cast("decimal(18,6)"))).alias("finished_at"),
        amount.alias("records_read"), (amount - amount % 100).alias("records_written"), (amount % 100).alias("records_rejected"),
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("order "), F.col("o_orderkey").cast("string"), F.lit(" did not load"))).alias("error_message"))


def quality_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One check result per order line."""
    failed = F.col("l_returnflag") == "R"
    return read(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("DQ-"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"), F.lit("-"),
                 F.col("l_partkey").cast("string"), F.lit("-"), F.col("l_suppkey").cast("string"), F.lit("-"),
                 F.col("l_quantity").cast("int").cast("string")).alias("check_id"),
        pad_id("RUN-", "l_orderkey", 8).alias("pipeline_run_id"),
        F.concat(F.lit("check_"), F.col("l_linenumber").cast("string")).alias("check_name"),
        F.when(F.col("l_linestatus") == "O", "fact_consumption").otherwise("fact_reading").alias("table_name"),
        F.when(failed, "failed").when(F.col("l_returnflag") == "A", "passed").otherwise("warning").alias("status"),
        F.when(failed, F.col("l_quantity").cast("int")).otherwise(0).alias("failed_count"),
        F.col("l_shipdate").cast("timestamp").alias("checked_at"))


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"))
    events = read(spark, sf_dir, "events").select(F.to_date("ts").alias("day"))
    return dim_date(orders.unionByName(events), "day")


def star(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """The whole warehouse by table name; a table is planned when it is first asked for."""
    builders = {
        "dim_date": _days, "dim_tariff": lambda s, d: dim_tariff(s),
        **{f.__name__: f for f in (dim_region, dim_customer, dim_meter, fact_consumption, fact_reading, fact_anomaly,
                                   pipeline_run, quality_check)},
    }
    return Planned({name: partial(build, spark, sf_dir) for name, build in builders.items()})

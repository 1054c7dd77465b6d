"""Explicit schemas, value domains and result contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Results depend on these exact strings and numbers.
# ---------------------------------------------------------------------------
REGIONS = ("North London", "South London", "East London", "West London", "Central London")
EVENT_TYPES = ("reading", "anomaly", "heartbeat")
RUN_STATUSES = ("started", "running", "succeeded", "failed", "cancelled")
CHECK_STATUSES = ("passed", "failed", "warning")
PROCESSING_STATUSES = ("received", "validated", "rejected", "loaded")
TARIFF_BUSINESS = "T-BIZ-2026"
TARIFF_ECO = "T-ECO-2026"
TARIFF_STANDARD = "T-STD-2026"
# tariff_id, tariff_name, price_per_kwh, standing_charge_daily
TARIFFS = (
    (TARIFF_STANDARD, "Standard", "0.2860", "0.5300"),
    (TARIFF_ECO, "Eco", "0.2510", "0.4900"),
    (TARIFF_BUSINESS, "Business", "0.3150", "0.7200"),
)
ANOMALY_KWH = 10
RECENT_AVERAGE_FACTOR = 3
DEFAULT_VOLTAGE = 230.0
MEASURE = "decimal(12,4)"  # what a fact can hold; a reading that does not fit is rejected
CORRUPT = "corrupt_record"  # raw text of a CSV row with too few or too many fields
REQUIRED_EVENT_FIELDS = (
    "event_id", "meter_id", "customer_id", "region_name", "event_timestamp",
    "kwh", "event_type", "source_system", "producer_timestamp",
)

# ---------------------------------------------------------------------------
# Bronze (read-time) schemas
# ---------------------------------------------------------------------------
_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(), "binary": T.BinaryType(),
    "decimal(10,3)": T.DecimalType(10, 3), "decimal(12,4)": T.DecimalType(12, 4), "decimal(18,4)": T.DecimalType(18, 4),
}


def _parse(fields: str) -> T.StructType:
    """``name type [not null], ...``; unlike ``StructType.fromDDL`` it needs no running session."""
    struct = T.StructType()
    for field in fields.split(", "):
        name, kind, *rest = field.strip().split(" ")
        struct.add(name, _TYPES[kind], nullable=not rest)
    return struct


BRONZE_CONSUMPTION = _parse(
    "source_file string, batch_id string, meter_id string, customer_id string, region_name string, "
    "reading_timestamp string, kwh string, ingestion_timestamp string"
)
BRONZE_WEATHER = _parse(
    "weather_timestamp string, region_name string, temperature_c string, humidity_percent string, "
    "wind_speed_kph string, precipitation_mm string, ingestion_timestamp string"
)
BRONZE_CUSTOMER = _parse(
    "customer_id string, customer_segment string, household_size string, dwelling_type string, "
    "region_name string, country string, postcode_area string, signup_date string, is_active string"
)
BRONZE_METER = _parse(
    "meter_id string, customer_id string, region_name string, meter_type string, "
    "installation_date string, is_active string"
)
BRONZE_TARIFF = _parse(
    "tariff_id string, tariff_name string, valid_from string, valid_to string, "
    "price_per_kwh string, standing_charge_daily string, is_active string"
)
EVENT = _parse(
    "event_id string, meter_id string, customer_id string, region_name string, event_timestamp string, "
    "kwh double, voltage double, event_type string, source_system string, producer_timestamp string"
)
ENVELOPE = _parse(
    "raw_event_payload string, ingestion_timestamp timestamp, source_system string, "
    "partition_id string, offset string, producer_metadata string"
)
KAFKA_RECORD = _parse(
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int"
)

# ---------------------------------------------------------------------------
# Serving contracts: names and types every serving view must return, with the
# columns that may not hold NULL.
# ---------------------------------------------------------------------------
VIEW_CONTRACTS = {
    "daily_region": _parse(
        "reading_date date not null, region_name string not null, total_kwh decimal(18,4) not null, "
        "average_kwh decimal(18,4) not null, reading_count bigint not null, unique_meter_count bigint not null"
    ),
    "monthly_region": _parse(
        "year_number int not null, month_number int not null, region_name string not null, "
        "total_kwh decimal(18,4) not null, average_daily_kwh decimal(18,4) not null, unique_meter_count bigint not null"
    ),
    "customer_usage": _parse(
        "customer_id string not null, customer_segment string not null, region_name string not null, "
        "total_kwh decimal(18,4) not null, average_daily_kwh decimal(18,4) not null, "
        "first_reading_timestamp timestamp, last_reading_timestamp timestamp"
    ),
    "latest_reading": _parse(
        "meter_id string not null, customer_id string not null, region_name string not null, "
        "event_timestamp timestamp not null, kwh decimal(12,4) not null, voltage decimal(10,3)"
    ),
    "anomaly_events": _parse(
        "anomaly_id string not null, meter_id string not null, region_name string not null, "
        "anomaly_type string not null, anomaly_score decimal(12,4), kwh decimal(12,4) not null, "
        "expected_kwh decimal(12,4), detected_at timestamp not null, source_system string"
    ),
    "quality_summary": _parse(
        "check_id string not null, pipeline_run_id string not null, check_name string not null, "
        "table_name string not null, status string not null, failed_count int not null, checked_at timestamp not null"
    ),
    "run_summary": _parse(
        "pipeline_run_id string not null, pipeline_name string not null, pipeline_type string not null, "
        "status string not null, started_at timestamp not null, finished_at timestamp, "
        "duration_seconds bigint not null, records_read int not null, records_written int not null, "
        "records_rejected int not null, error_message string"
    ),
    "kpis": _parse(
        "total_kwh decimal(18,4) not null, total_customers bigint not null, total_meters bigint not null, "
        "total_anomalies bigint not null, latest_reading_timestamp timestamp, "
        "failed_pipeline_runs bigint not null, failed_data_quality_checks bigint not null"
    ),
    "freshness": _parse("latest_reading_timestamp timestamp, hours_since_latest_reading bigint"),
}


def assert_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Return ``df`` when its column names and types equal the contract's, else raise.

    Only the analysed schema is looked at; no row is read. NOT NULL promises of a
    contract are data, see ``operators.quality.audit_contract``.
    """
    have = [(f.name, f.dataType.simpleString()) for f in df.schema]
    want = [(f.name, f.dataType.simpleString()) for f in contract]
    if have != want:
        raise ValueError(f"result does not meet its contract: has {have}, needs {want}")
    return df

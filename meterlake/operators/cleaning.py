"""Bronze to silver: type, validate, split into clean rows and rejects that keep payload and reasons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake import schemas
from meterlake.functions import (
    BATCH_SEPARATOR, STREAM_SEPARATOR, Rule, clean_text, consumption_rules, event_rules, event_timestamp,
    is_malformed_json, iso_z, json_payload, now, pad_id, record_hash, rejection_reason, weather_rules,
)
from meterlake.operators.aggregates import union_all
from meterlake.operators.windows import distinct_by, mark_duplicates, sequence_number

REASON = "rejection_reason"


def split_valid(df: DataFrame, reason: str = REASON) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) by the reason column; both share the plan below."""
    return df.where(F.col(reason) == ""), df.where(F.col(reason) != "")


def reject_records(
    rejected: DataFrame, source_system: str, reference: Sequence[Column], payload: str = "raw_payload",
    batch_id: str | None = "batch_id", as_of: str | None = None,
) -> DataFrame:
    """Dead-letter rows of a batch; ``reference`` parts are joined by ``:``."""
    return rejected.select(
        F.lit(source_system).alias("source_system"),
        F.concat_ws(":", *reference).alias("source_reference"),
        F.col(payload).alias("raw_payload"),
        REASON,
        now(as_of).alias("rejected_at"),
        (F.col(batch_id) if batch_id else F.lit(None).cast("string")).alias("batch_id"),
    )


def reject_events(
    rejected: DataFrame, source: str = "source_system", fallback: Column | None = None, as_of: str | None = None,
) -> DataFrame:
    """Dead-letter rows of a stream: the raw text, all reasons, and where it came from."""
    fallback = F.col("bronze_source_system") if fallback is None else fallback
    return rejected.select(
        "raw_event_payload", REASON, now(as_of).alias("rejected_at"),
        F.coalesce(F.col(source), fallback).alias("source_system"),
    )


def validate_consumption(raw: DataFrame, regions: Sequence[str] = schemas.REGIONS) -> DataFrame:
    """Typed bronze consumption with ``rejection_reason``, one output row per input row.

    Among rows of one meter and time the first by file, batch, validity and fields stays; the others
    are duplicates. A good row is therefore never lost to a bad one of the same file and batch. The payload's JSON is
    built for rejects alone, after the ranking.
    """
    corrupt = F.col(schemas.CORRUPT) if schemas.CORRUPT in raw.columns else F.lit(None).cast("string")
    fields = [c for c in raw.columns if c != schemas.CORRUPT]

    def typed(df: DataFrame) -> DataFrame:
        return df.withColumns({
            "meter_id": clean_text("meter_id"),
            "customer_id": clean_text("customer_id"),
            "region_name": clean_text("region_name"),
            "reading_timestamp": F.col("reading_timestamp").try_cast("timestamp"),
            "kwh": F.col("kwh").try_cast("double"),
            "ingestion_timestamp": F.col("ingestion_timestamp").try_cast("timestamp"),
        })

    malformed = F.col("raw_text").isNotNull()
    is_bad = rejection_reason(consumption_rules(regions, malformed=malformed)) != ""
    packed = raw.withColumns({"raw_fields": F.struct(*sorted(fields)), "raw_text": corrupt})
    # only the raw fields and the key are dealt out; the other typed columns are made again behind the ranking
    keyed = typed(packed).select("raw_fields", "raw_text", "meter_id", "reading_timestamp", is_bad.alias("__bad"))
    marked = mark_duplicates(
        keyed, ["meter_id", "reading_timestamp"],
        [F.asc_nulls_last("raw_fields.source_file"), F.asc_nulls_last("raw_fields.batch_id"), "__bad", *[F.asc_nulls_last(f"raw_fields.{c}") for c in sorted(fields)]],
    ).select(*[F.col("raw_fields")[c].alias(c) for c in fields], "raw_fields", "raw_text", F.col("raw_fields")["meter_id"].alias("raw_meter_id"), "is_duplicate")
    rules = consumption_rules(regions, duplicate=F.col("is_duplicate"), malformed=malformed)
    return typed(marked).withColumn(REASON, rejection_reason(rules, BATCH_SEPARATOR)).drop("is_duplicate")


def clean_consumption(validated: DataFrame, as_of: str | None = None) -> DataFrame:
    """Silver consumption. The key is unique already, so the record hash needs no second deduplication."""
    valid, _ = split_valid(validated)
    return valid.select(
        "batch_id", "meter_id", "customer_id", "region_name", "reading_timestamp",
        F.to_date("reading_timestamp").alias("reading_date"),
        F.hour("reading_timestamp").alias("reading_hour"),
        "kwh", "source_file", "ingestion_timestamp",
        record_hash("meter_id", "customer_id", F.date_format("reading_timestamp", "yyyy-MM-dd HH:mm:ss"),
                    F.col("kwh").cast("string")).alias("record_hash"),
        now(as_of).alias("processed_timestamp"),
    )


def rejected_consumption(validated: DataFrame, as_of: str | None = None) -> DataFrame:
    _, rejected = split_valid(validated)
    rejected = rejected.withColumn("raw_payload", F.coalesce("raw_text", F.to_json("raw_fields", {"ignoreNullFields": "false"})))
    reference = [F.coalesce("source_file", F.lit("unknown_file")), F.coalesce("raw_meter_id", F.lit("missing_meter"))]
    return reject_records(rejected, "bronze_historical_consumption", reference, as_of=as_of)


def transform_consumption(
    raw: DataFrame, regions: Sequence[str] = schemas.REGIONS, as_of: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    validated = validate_consumption(raw, regions)
    return clean_consumption(validated, as_of), rejected_consumption(validated, as_of)


def transform_weather(
    raw: DataFrame, regions: Sequence[str] = schemas.REGIONS, as_of: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    measures = ["temperature_c", "humidity_percent", "wind_speed_kph", "precipitation_mm"]
    corrupt = F.col(schemas.CORRUPT) if schemas.CORRUPT in raw.columns else F.lit(None).cast("string")
    typed = raw.withColumns({
        "raw_payload": F.coalesce(corrupt, json_payload([c for c in raw.columns if c != schemas.CORRUPT])),
        "malformed": corrupt.isNotNull(),
        "raw_region_name": F.col("region_name"),
        "region_name": clean_text("region_name"),
        "weather_timestamp": F.col("weather_timestamp").try_cast("timestamp"),
        "ingestion_timestamp": F.col("ingestion_timestamp").try_cast("timestamp"),
        **{m: F.col(m).try_cast("double") for m in measures},
    })
    valid, rejected = split_valid(typed.withColumn(REASON, rejection_reason([Rule(F.col("malformed"), "Malformed CSV row"), *weather_rules(regions)])))
    clean = valid.select(
        "region_name", "weather_timestamp", F.to_date("weather_timestamp").alias("weather_date"),
        F.hour("weather_timestamp").alias("weather_hour"), *measures, "ingestion_timestamp",
        now(as_of).alias("processed_timestamp"),
    )
    reference = [F.lit("weather"), F.coalesce("raw_region_name", F.lit("missing_region"))]
    return clean, reject_records(rejected, "bronze_weather", reference, batch_id=None, as_of=as_of)


def _clean_master(df: DataFrame, key: str, text: Sequence[str], kinds: dict[str, str], as_of: str | None) -> DataFrame:
    """Trim text, cast the rest, drop rows without key, keep one row per key."""
    columns = [clean_text(c).alias(c) if c in text else F.col(c).try_cast(kinds[c]).alias(c) for c in df.columns]
    keyed = df.select(*columns).where(F.col(key).isNotNull())
    return distinct_by(keyed, [key]).withColumn("processed_timestamp", now(as_of))


def transform_metadata(
    customers: DataFrame, meters: DataFrame, tariffs: DataFrame, as_of: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Silver customers, meters and tariffs."""
    return (
        _clean_master(
            customers.select(*schemas.BRONZE_CUSTOMER.names), "customer_id",
            ["customer_id", "customer_segment", "dwelling_type", "region_name", "country", "postcode_area"],
            {"household_size": "int", "signup_date": "date", "is_active": "boolean"}, as_of),
        _clean_master(
            meters.select(*schemas.BRONZE_METER.names), "meter_id",
            ["meter_id", "customer_id", "region_name", "meter_type"],
            {"installation_date": "date", "is_active": "boolean"}, as_of),
        _clean_master(
            tariffs.select(*schemas.BRONZE_TARIFF.names), "tariff_id", ["tariff_id", "tariff_name"],
            {"valid_from": "date", "valid_to": "date", "price_per_kwh": "double",
             "standing_charge_daily": "double", "is_active": "boolean"}, as_of),
    )


def rejected_metadata(customers: DataFrame, meters: DataFrame, tariffs: DataFrame, as_of: str | None = None) -> DataFrame:
    """What ``transform_metadata`` leaves out or cannot read, one record per row with its reasons.

    A row without its key, or one whose text does not fit its header, is missing from silver; a row with a value that does not parse is there
    with NULL in its place.
    """
    tables = {
        "customers": (customers, "customer_id", {"household_size": "int", "signup_date": "date", "is_active": "boolean"}),
        "meters": (meters, "meter_id", {"installation_date": "date", "is_active": "boolean"}),
        "tariffs": (tariffs, "tariff_id", {"valid_from": "date", "valid_to": "date", "price_per_kwh": "double", "standing_charge_daily": "double", "is_active": "boolean"}),
    }
    found = []
    for name, (df, key, kinds) in tables.items():
        corrupt = F.col(schemas.CORRUPT) if schemas.CORRUPT in df.columns else F.lit(None).cast("string")
        fields = [c for c in df.columns if c != schemas.CORRUPT]
        rules = [Rule(corrupt.isNotNull(), "Malformed CSV row"), Rule(clean_text(key).isNull(), f"Missing {key}")]
        rules += [Rule(clean_text(F.col(c).cast("string")).isNotNull() & F.col(c).try_cast(kind).isNull(), f"Invalid {c}") for c, kind in kinds.items()]
        checked = df.withColumns({REASON: rejection_reason(rules), "raw_payload": F.coalesce(corrupt, json_payload(fields))})
        _, bad = split_valid(checked)
        found.append(reject_records(bad, f"bronze_{name}", [F.lit(name), F.coalesce(clean_text(key), F.lit(f"missing_{key}"))], batch_id=None, as_of=as_of))
    return union_all(found)


# -- events ---------------------------------------------------------------------
_ENVELOPE = ("raw_event_payload", "ingestion_timestamp", "bronze_source_system", "partition_id", "offset", "producer_metadata")


def parse_events(envelope: DataFrame, schema=schemas.EVENT) -> DataFrame:
    """Flatten the JSON payload beside the envelope.

    A permissive parse yields a struct of NULLs for broken text, so whether the text was a JSON object
    is kept as its own column, ``is_malformed``; such a row has no fields.
    """
    return _parsed(envelope.withColumn("bronze_source_system", F.col("source_system")).select(*_ENVELOPE), schema)


def _parsed(envelope: DataFrame, schema=schemas.EVENT) -> DataFrame:
    return envelope.withColumn("is_malformed", is_malformed_json("raw_event_payload")).withColumn(
        "parsed", F.when(~F.col("is_malformed"), F.from_json("raw_event_payload", schema))
    ).select("*", "parsed.*").drop("parsed").withColumns({
        "event_ts": event_timestamp("event_timestamp"),
        "producer_ts": event_timestamp("producer_timestamp"),
    })


def validate_events(
    envelope: DataFrame, regions: Sequence[str] = schemas.REGIONS, trim: bool = False,
) -> DataFrame:
    """Parsed events with ``rejection_reason``; the first event per id by ingestion time, then payload, stays.

    Only the envelope and the id are dealt out and sorted; the fields are parsed again behind the ranking.
    """
    marked = mark_duplicates(
        parse_events(envelope).select(*_ENVELOPE, F.col("event_id").alias("__id")), ["__id"], [F.asc_nulls_last("ingestion_timestamp"), "raw_event_payload"])
    rules = event_rules(regions, duplicate=F.col("is_duplicate"), trim=trim)
    return _parsed(marked.drop("__id")).withColumn(REASON, rejection_reason(rules, STREAM_SEPARATOR)).drop("is_duplicate")


def clean_events(validated: DataFrame, as_of: str | None = None) -> DataFrame:
    valid, _ = split_valid(validated)
    return valid.select(
        "event_id", "meter_id", "customer_id", "region_name", F.col("event_ts").alias("event_timestamp"),
        "kwh", "voltage", "event_type",
        F.coalesce("source_system", "bronze_source_system").alias("source_system"),
        F.col("producer_ts").alias("producer_timestamp"), "ingestion_timestamp",
        record_hash("event_id", "meter_id", F.col("event_ts").cast("string")).alias("record_hash"),
        now(as_of).alias("processed_timestamp"),
    )


def detect_anomalies(
    clean: DataFrame, threshold: float = schemas.ANOMALY_KWH, as_of: str | None = None,
) -> DataFrame:
    """Events flagged by the producer or strictly above the threshold, labelled and scored."""
    flagged, high = F.col("event_type") == "anomaly", F.col("kwh") > threshold
    return clean.where(flagged | high).select(
        F.concat(F.lit("anom_"), "event_id").alias("anomaly_id"),
        "event_id", "meter_id", "customer_id", "region_name", "event_timestamp",
        F.when(flagged, "producer_flagged_anomaly").otherwise("high_kwh_threshold").alias("anomaly_type"),
        F.when(high, 0.95).otherwise(0.75).alias("anomaly_score"),
        "kwh", F.lit(None).cast("double").alias("expected_kwh"),
        now(as_of).alias("detected_at"), "source_system", now(as_of).alias("processed_timestamp"),
    )


def rows_to_events(
    rows: DataFrame, order_by: Sequence[str | Column], as_of: str | None = None, threshold: float = schemas.ANOMALY_KWH,
) -> DataFrame:
    """Replay batch rows as events, one JSON text ``value`` per row, numbered in ``order_by``.

    A kWh that is no number stays the raw text in the JSON, and a time that does not parse stays as it was.
    """
    number = F.col("kwh").try_cast("double")
    when = F.col("reading_timestamp").try_cast("timestamp")
    fields = {
        "event_id": pad_id("replay_evt_", "__n", 8),
        "meter_id": F.col("meter_id"), "customer_id": F.col("customer_id"), "region_name": F.col("region_name"),
        "event_timestamp": F.coalesce(iso_z(when), "reading_timestamp", iso_z(now(as_of))),
        "voltage": F.lit(schemas.DEFAULT_VOLTAGE),
        "event_type": F.when(number > threshold, "anomaly").otherwise("reading"),
        "source_system": F.lit("batch_replay_stream"),
        "producer_timestamp": iso_z(now(as_of)),
    }
    named = [column.alias(name) for name, column in fields.items()]
    as_json = {
        kind: F.to_json(F.struct(*named, kwh.alias("kwh")), {"ignoreNullFields": "false"})
        for kind, kwh in (("number", number), ("text", F.col("kwh").cast("string")))
    }
    return sequence_number(rows, order_by, "__n").select(
        F.when(number.isNotNull(), as_json["number"]).otherwise(as_json["text"]).alias("value"),
        fields["event_id"].alias("event_id"),
    )

"""Validation as data: a rule is a condition column and the reason it reports."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterlake import schemas
from meterlake.functions.expressions import as_column, event_timestamp

__all__ = [
    "BATCH_SEPARATOR", "STREAM_SEPARATOR", "Rule", "classify_event", "consumption_rules", "event_row_rules",
    "event_rules", "is_anomaly", "is_malformed_json", "not_in", "present", "rejection_reason", "weather_rules",
]

BATCH_SEPARATOR = "; "
STREAM_SEPARATOR = ";"


class Rule(NamedTuple):
    failed: Column
    reason: str | Column


def rejection_reason(rules: Sequence[Rule], separator: str = BATCH_SEPARATOR) -> Column:
    """Every failing rule's reason in rule order; the empty string means valid."""
    return F.concat_ws(
        separator,
        *[F.when(r.failed, F.lit(r.reason) if isinstance(r.reason, str) else r.reason) for r in rules],
    )


def present(col: str | Column) -> Column:
    """Neither NULL nor blank."""
    return F.length(F.trim(F.coalesce(as_column(col).cast("string"), F.lit("")))) > 0


def not_in(col: str | Column, domain: Sequence[str], trim: bool = False) -> Column:
    """True for NULL and for values outside the domain."""
    col = F.trim(as_column(col)) if trim else as_column(col)
    return ~F.coalesce(col.isin(*domain), F.lit(False))


def _unstorable(number: Column) -> Column:
    """Not a usable measure: NULL, NaN, an infinity, or a value the measure type of the facts cannot hold."""
    return number.try_cast(schemas.MEASURE).isNull()


def is_malformed_json(raw: str | Column) -> Column:
    """Not JSON at all, or JSON whose top level is not an object."""
    raw = as_column(raw)
    return F.try_parse_json(raw).isNull() | ~F.coalesce(F.ltrim(raw).startswith("{"), F.lit(False))


def consumption_rules(
    regions: Sequence[str] = schemas.REGIONS,
    meter: str = "meter_id", customer: str = "customer_id", ts: str = "reading_timestamp",
    kwh: str = "kwh", region: str = "region_name", duplicate: Column | None = None, style: str = "batch",
    malformed: Column | None = None,
) -> list[Rule]:
    """Rules for consumption rows.

    ``batch`` works on cleaned and typed columns (blank text already NULL);
    ``row`` works on the raw text and words the kWh reasons differently.
    """
    if style == "row":
        number = F.col(kwh).try_cast("double")
        return [
            Rule(~present(meter), "Missing meter_id"),
            Rule(~present(customer), "Missing customer_id"),
            Rule(F.trim(F.col(ts)).try_cast("timestamp").isNull(), "Invalid reading_timestamp"),
            Rule(~present(kwh), "Missing kwh"),
            Rule(present(kwh) & (_unstorable(number) | (number < 0)), "Negative or invalid kwh"),
            Rule(not_in(region, regions, trim=True), "Invalid region_name"),
        ]
    if style != "batch":
        raise ValueError(f"unknown rule style: {style}")
    rules = [
        Rule(F.col(meter).isNull(), "Missing meter_id"),
        Rule(F.col(customer).isNull(), "Missing customer_id"),
        Rule(F.col(ts).isNull(), "Invalid reading_timestamp"),
        Rule(_unstorable(F.col(kwh)), "Missing or invalid kwh"),
        Rule(F.col(kwh) < 0, "Negative kwh"),
        Rule(not_in(region, regions), "Invalid region_name"),
    ]
    if malformed is not None:
        rules.insert(0, Rule(malformed, "Malformed CSV row"))
    if duplicate is not None:
        rules.append(Rule(duplicate, "Duplicate meter_id and reading_timestamp"))
    return rules


def weather_rules(
    regions: Sequence[str] = schemas.REGIONS,
    ts: str = "weather_timestamp", temperature: str = "temperature_c", region: str = "region_name",
) -> list[Rule]:
    return [
        Rule(F.col(ts).isNull(), "Invalid weather_timestamp"),
        Rule(F.col(temperature).isNull(), "Missing or invalid temperature_c"),
        Rule(not_in(region, regions), "Invalid region_name"),
    ]


def event_rules(
    regions: Sequence[str] = schemas.REGIONS,
    event_types: Sequence[str] = schemas.EVENT_TYPES,
    malformed: str = "is_malformed", event_ts: str = "event_ts", producer_ts: str = "producer_ts",
    duplicate: Column | None = None, trim: bool = False,
) -> list[Rule]:
    """Rules for parsed stream events (typed columns). Regions are compared untrimmed by default."""
    rules = [
        Rule(F.col(malformed), "Malformed JSON"),
        *[Rule(~present(name), f"Missing {name}") for name in ("event_id", "meter_id", "customer_id")],
        Rule(not_in("region_name", regions, trim), "Invalid region_name"),
        Rule(F.col(event_ts).isNull(), "Invalid event_timestamp"),
        Rule(F.col(producer_ts).isNull(), "Invalid producer_timestamp"),
        Rule(_unstorable(F.col("kwh")), "Missing or invalid kwh"),
        Rule(F.col("kwh") < 0, "Negative kwh"),
        Rule(F.col("voltage") <= 0, "Invalid voltage"),
        Rule(not_in("event_type", event_types, trim), "Invalid event_type"),
    ]
    if duplicate is not None:
        rules.append(Rule(duplicate, "Duplicate event_id in micro-batch"))
    return rules


def event_row_rules(
    regions: Sequence[str] = schemas.REGIONS,
    event_types: Sequence[str] = schemas.EVENT_TYPES,
    required: Sequence[str] = schemas.REQUIRED_EVENT_FIELDS,
) -> list[Rule]:
    """Producer-side rules: one reason lists all missing fields; values are checked only where present."""
    missing = F.concat_ws(", ", *[F.when(~present(name), F.lit(name)) for name in required])
    kwh, voltage = F.col("kwh").try_cast("double"), F.col("voltage").try_cast("double")
    return [
        Rule(missing != "", F.concat(F.lit("Missing required fields: "), missing)),
        Rule(present("region_name") & not_in("region_name", regions, trim=True), "Invalid region_name"),
        Rule(present("event_timestamp") & event_timestamp("event_timestamp").isNull(), "Invalid event_timestamp"),
        Rule(present("kwh") & (_unstorable(kwh) | (kwh < 0)), "Negative or invalid kwh"),
        Rule(present("voltage") & ~F.coalesce(voltage > 0, F.lit(False)), "Invalid voltage"),
        Rule(present("event_type") & not_in("event_type", event_types, trim=True), "Invalid event_type"),
    ]


def is_anomaly(
    kwh: str | Column = "kwh", event_type: str | Column = "event_type", recent_average: str | Column | None = None,
    threshold: float = schemas.ANOMALY_KWH, factor: float = schemas.RECENT_AVERAGE_FACTOR,
) -> Column:
    """Flagged by the producer, above the threshold, or far above a positive recent average."""
    kwh, event_type = as_column(kwh), as_column(event_type)
    hit = (F.trim(event_type) == "anomaly") | (kwh > threshold)
    if recent_average is not None:
        recent = as_column(recent_average)
        hit = hit | ((recent > 0) & (kwh > recent * factor))
    return F.coalesce(hit, F.lit(False)) & F.coalesce(kwh >= 0, F.lit(False))


def classify_event(reason: str | Column, recent_average: str | Column | None = None) -> Column:
    """``invalid``, ``heartbeat``, ``anomaly`` or ``reading``, in this priority."""
    return (
        F.when(as_column(reason) != "", "invalid")
        .when(F.col("event_type") == "heartbeat", "heartbeat")
        .when(is_anomaly(F.col("kwh").try_cast("double"), "event_type", recent_average), "anomaly")
        .otherwise("reading")
    )

"""Star schema: dimensions, surrogate keys, facts, upserts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake import schemas
from meterlake.functions import (
    choose_tariff, date_id, date_parts, default_if_falsy, end_of_day, estimated_cost, json_payload, now,
)
from meterlake.operators.aggregates import union_all
from meterlake.operators.joins import insert_missing, lookup
from meterlake.operators.windows import distinct_by, first_per_key, sequence_number


def date_spine(spark: SparkSession, start: str, end: str, name: str = "full_date") -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).select(F.explode(days).alias(name))


def dim_date(dates: DataFrame, column: str, existing: DataFrame | None = None) -> DataFrame:
    """Calendar rows for every day in ``column``; with ``existing``, that table plus the missing days."""
    days = dates.select(F.to_date(column).alias("full_date")).where(F.col("full_date").isNotNull()).distinct()
    calendar = days.select(date_id("full_date").alias("date_id"), "full_date",
                           *[c.alias(n) for n, c in date_parts("full_date").items()])
    return calendar if existing is None else insert_missing(existing, calendar, ["date_id"])


def assign_keys(source: DataFrame, natural: str, existing: DataFrame | None, key: str) -> DataFrame:
    """Integer surrogate keys: known natural keys keep theirs, new ones follow the greatest in name order.

    Returns (natural, key) for every natural key of both sides.
    """
    names = source.select(natural).where(F.col(natural).isNotNull()).distinct()
    if existing is None:
        return sequence_number(names, [natural], key).select(natural, F.col(key).cast("int").alias(key))
    known = existing.select(natural, F.col(key).cast("int").alias(key))
    fresh = names.join(known.select(natural), natural, "left_anti")
    highest = known.agg(F.coalesce(F.max(key), F.lit(0)))
    numbered = sequence_number(fresh, [natural], "__n").select(
        natural, (F.col("__n") + highest.scalar()).cast("int").alias(key))
    return known.unionByName(numbered)


def dim_region(customers: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per region name found in the customers, with its surrogate key."""
    named = customers.where(F.col("region_name").isNotNull())
    rows = distinct_by(named.select("region_name", "country", "postcode_area"), ["region_name"])
    return assign_keys(rows, "region_name", existing, "region_id").join(rows, "region_name")


def one_per_key(source: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """The source with each key once: the first row in ``order_by``; without an order a repeated key fails the job."""
    if order_by is not None:
        return first_per_key(source, keys, order_by)
    rest = F.struct(*[c for c in source.columns if c not in keys]) if len(source.columns) > len(keys) else F.struct(F.lit(0).alias("__none"))
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    # the check decides which row is used, so no plan can leave it out
    row = F.when(F.col("__n") == 1, F.col("__row")).otherwise(F.raise_error(F.concat(F.lit("repeated source key: "), shown)))
    once = source.groupBy(*keys).agg(F.count("*").alias("__n"), F.any_value(rest).alias("__row"))
    return once.select(*keys, row.alias("__row")).select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in source.columns])


def row_changes(
    target: DataFrame, source: DataFrame, keys: Sequence[str], preserve: Sequence[str] = (), order_by: Sequence[str | Column] | None = None,
) -> DataFrame:
    """The source rows as the target would hold them, with ``change``: ``insert``, ``update`` or ``same``.

    A repeated source key is an error, or its first row in ``order_by`` counts. NULL keys are keys like others. ``preserve`` columns (a creation time, say) keep the target's value where there is one and don't make
    a change. Columns the source lacks keep the target's value.
    """
    new = one_per_key(source, keys, order_by)
    old = target.select(*[F.col(c).alias(f"__old_{c}") for c in target.columns], F.lit(True).alias("__in_target"))
    joined = new.join(old, [F.col(k).eqNullSafe(F.col(f"__old_{k}")) for k in keys], "left")

    def value(column: str) -> Column:
        before = F.col(f"__old_{column}")
        if column not in source.columns:
            return before
        return F.coalesce(before, F.col(column)) if column in preserve else F.col(column).cast(target.schema[column].dataType)

    compared = [c for c in target.columns if c not in keys and c not in preserve and c in source.columns]
    differs = reduce(lambda a, b: a | b, [~value(c).eqNullSafe(F.col(f"__old_{c}")) for c in compared], F.lit(False))
    change = F.when(F.col("__in_target").isNull(), "insert").when(differs, "update").otherwise("same")
    return joined.select(*[value(c).alias(c) for c in target.columns], change.alias("change"))


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], preserve: Sequence[str] = (), order_by: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Type-1 upsert: source rows replace target rows of their key, the others stay. See ``row_changes``.

    The result is a new table; write it to a new path, never over the one being read. ``sinks.replace_buckets`` with the changes that are not ``same`` writes only the buckets they touch.
    """
    changed = row_changes(target, source, keys, preserve, order_by).drop("change")
    own = source.select(*[F.col(k).alias(f"__key_{k}") for k in keys])
    return target.join(own, [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys], "left_anti").unionByName(changed)


def record_history(history: DataFrame, source: DataFrame, keys: Sequence[str], at: str | Column, order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """Type-2 history after ``source`` was seen at time ``at``: rows with ``valid_from`` and ``valid_to`` (NULL: still valid).

    A changed row closes the valid one of its key and opens another; a row that is the same leaves it; keys the source lacks stay valid. Seeing the same source again at the same or a later time changes nothing.
    """
    at = (F.lit(at) if isinstance(at, str) else at).cast("timestamp")
    spans = ["valid_from", "valid_to"]
    valid, closed = history.where(F.col("valid_to").isNull()), history.where(F.col("valid_to").isNotNull())
    changed = row_changes(valid.drop(*spans), source, keys, order_by=order_by).where(F.col("change") != "same")
    ended = changed.where(F.col("change") == "update").select(*[F.col(k).alias(f"__key_{k}") for k in keys], F.lit(True).alias("__ended"))
    current = valid.join(ended, [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys], "left").withColumn("valid_to", F.when(F.col("__ended"), at)).select(*history.columns)
    opened = changed.drop("change").withColumns({"valid_from": at, "valid_to": F.lit(None).cast("timestamp")}).select(*history.columns)
    return union_all([closed, current, opened])


def replace_batch(target: DataFrame, rows: DataFrame, batch_id: str, column: str = "batch_id") -> DataFrame:
    """The target without the batch, plus the batch's new rows. ``sinks.write_batch`` is its in-place form."""
    kept = target.where(~F.col(column).eqNullSafe(F.lit(batch_id)))
    return kept.unionByName(rows.withColumn(column, F.lit(batch_id)).select(*target.columns))


def build_consumption_fact(
    daily: DataFrame, customers: DataFrame, regions: DataFrame, tariffs: DataFrame, batch_id: str,
    source_system: str = "phase2_gold", on_missing: str = "error",
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Daily totals to warehouse facts: surrogate region, tariff by rule, cost, date key, end-of-day time.

    With ``on_missing="reject"`` also the daily rows that found no dimension row or whose total no fact can hold.
    """
    lost = []

    def found(df: DataFrame, dim: DataFrame, key: str, columns: list[str]) -> DataFrame:
        result = lookup(df, dim, key, columns, on_missing)
        if on_missing != "reject":
            return result
        lost.append(result[1].select(*daily.columns))
        return result[0]

    facts = found(daily, customers, "customer_id", ["customer_segment", "household_size"])
    facts = found(facts, regions, "region_name", ["region_id"])
    facts = facts.withColumn("tariff_id", choose_tariff("customer_segment", "household_size"))
    facts = found(facts, tariffs, "tariff_id", ["price_per_kwh", "standing_charge_daily"])
    fits = F.col("total_kwh").try_cast(schemas.MEASURE).isNotNull()
    if on_missing == "reject":
        lost.append(facts.where(~fits).select(*daily.columns))
        facts = facts.where(fits)
    rows = facts.select(
        "meter_id", "customer_id", "region_id", "tariff_id", date_id("reading_date").alias("date_id"),
        end_of_day("reading_date").alias("reading_timestamp"),
        F.col("total_kwh").cast("decimal(12,4)").alias("kwh"),
        estimated_cost("total_kwh", "price_per_kwh", "standing_charge_daily").alias("estimated_cost"),
        F.lit(source_system).alias("source_system"), F.lit(batch_id).alias("batch_id"),
    )
    return (rows, union_all(lost)) if on_missing == "reject" else rows


def lookup_rejects(rows: DataFrame, table: str, key: str, batch_id: str | None = None, as_of: str | None = None) -> DataFrame:
    """Rows that could not be loaded into ``table`` as dead-letter records."""
    return rows.select(
        F.lit(table).alias("source_system"), F.concat_ws(":", F.lit(table), F.coalesce(F.col(key).cast("string"), F.lit(f"missing_{key}"))).alias("source_reference"),
        json_payload(rows.columns).alias("raw_payload"), F.lit("No dimension row, or a total that cannot be stored").alias("rejection_reason"),
        now(as_of).alias("rejected_at"), F.lit(batch_id).cast("string").alias("batch_id"))


def reading_rows(events: DataFrame, regions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reading facts, events whose region is unknown) from clean events."""
    known, unknown = lookup(events, regions, "region_name", ["region_id"], "reject")
    rows = distinct_by(known.select(
        F.col("event_id").alias("reading_id"), "meter_id", "customer_id", "region_id",
        date_id("event_timestamp").alias("date_id"), "event_timestamp",
        F.col("kwh").cast("decimal(12,4)").alias("kwh"),
        default_if_falsy("voltage", schemas.DEFAULT_VOLTAGE).cast("decimal(10,3)").alias("voltage"),
        "source_system", "event_id",
    ), ["reading_id"])
    return rows, unknown


def anomaly_rows(anomalies: DataFrame, regions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(anomaly facts, anomalies whose region is unknown)."""
    known, unknown = lookup(anomalies, regions, "region_name", ["region_id"], "reject")
    rows = distinct_by(known.select(
        "anomaly_id", F.col("event_id").alias("reading_id"), "meter_id", "region_id",
        date_id("event_timestamp").alias("date_id"), "anomaly_type",
        *[F.col(c).cast("decimal(12,4)").alias(c) for c in ("anomaly_score", "kwh", "expected_kwh")],
        "detected_at", "source_system",
    ), ["anomaly_id"])
    return rows, unknown


def load_readings(target: DataFrame, events: DataFrame, regions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reading fact with the new events, events of unknown region). Loading twice adds nothing."""
    rows, unknown = reading_rows(events, regions)
    return insert_missing(target, rows, ["reading_id"]), unknown


def load_anomalies(target: DataFrame, anomalies: DataFrame, regions: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows, unknown = anomaly_rows(anomalies, regions)
    return insert_missing(target, rows, ["anomaly_id"]), unknown

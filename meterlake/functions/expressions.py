"""Column expressions. Everything here stays inside the JVM and code generation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake import schemas

__all__ = [
    "as_column", "boundary_diff", "choose_tariff", "clean_text", "date_id", "date_parts",
    "default_if_falsy", "end_of_day", "estimated_cost", "event_timestamp", "exact",
    "future_rows", "iso_z", "json_payload", "kwh_average", "kwh_total", "now",
    "optional_date_range", "optional_eq", "optional_ts_range", "pad_id", "prefixed_sha1",
    "record_hash", "safe_divide", "typed",
]


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def now(as_of: str | Column | None = None) -> Column:
    """Audit clock: ``as_of`` (timestamp text or column) when given, else the query's start time."""
    if as_of is None:
        return F.current_timestamp()
    return F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of


# -- text and typing --------------------------------------------------------
def clean_text(col: str | Column) -> Column:
    """Trim spaces; blank becomes NULL."""
    return F.nullif(F.trim(as_column(col)), F.lit(""))


def typed(df: DataFrame, types: Mapping[str, str], suffix: str = "") -> DataFrame:
    """Cast text columns; a value that does not parse becomes NULL, also under ANSI mode."""
    return df.withColumns({name + suffix: F.col(name).try_cast(kind) for name, kind in types.items()})


def pad_id(prefix: str, number: str | Column, width: int) -> Column:
    """``prefix`` plus a zero-padded number; a longer number keeps all its digits."""
    digits = as_column(number).cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0")))


def record_hash(*cols: str | Column) -> Column:
    """SHA-256 over the fields joined by ``||``; NULL fields are skipped."""
    return F.sha2(F.concat_ws("||", *map(as_column, cols)), 256)


def prefixed_sha1(prefix: str, digits: int, *parts: str | Column) -> Column:
    """Repeatable id: the prefix and the first hex digits of SHA-1 over ``a:b:...``."""
    return F.concat(F.lit(prefix), F.substring(F.sha1(F.concat_ws(":", *map(as_column, parts))), 1, digits))


def json_payload(columns: Sequence[str], keep_nulls: bool = True) -> Column:
    """The named columns as one JSON object with sorted keys, NULL fields kept by default."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": str(not keep_nulls).lower()})


# -- time -------------------------------------------------------------------
_EVENT_TIMES = ("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]", "yyyy-MM-dd'T'HH:mm:ss[.SSS][XXX]", "yyyy-MM-dd HH:mm:ss[.SSSSSS]", "yyyy-MM-dd HH:mm:ss[.SSS]", "yyyy-MM-dd")


def event_timestamp(col: str | Column) -> Column:
    """Parse ``2024-01-01T10:00:00Z``, with another offset or none, ``2024-01-01 10:00:00`` and plain days; NULL for anything else.

    Text without an offset is taken in the session's zone. A bare year is no time.
    """
    text = F.trim(as_column(col))
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(pattern)) for pattern in _EVENT_TIMES])


def iso_z(ts: str | Column) -> Column:
    return F.date_format(as_column(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def date_id(day: str | Column) -> Column:
    """Integer ``YYYYMMDD``."""
    day = as_column(day)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def date_parts(day: str | Column) -> dict[str, Column]:
    """The calendar columns of a date dimension."""
    day = as_column(day)
    return {
        "year_number": F.year(day),
        "quarter_number": F.quarter(day),
        "month_number": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "day_of_month": F.dayofmonth(day),
        "day_of_week_name": F.date_format(day, "EEEE"),
        "is_weekend": F.weekday(day) >= 5,
    }


def end_of_day(day: str | Column) -> Column:
    """23:59:59 of the day."""
    return as_column(day).cast("date").cast("timestamp") + F.make_dt_interval(
        F.lit(0), F.lit(23), F.lit(59), F.lit(59))


_UNIT_SECONDS = {"SECOND": 1, "MINUTE": 60, "HOUR": 3600, "DAY": 86400}


def boundary_diff(unit: str, start: str | Column, end: str | Column) -> Column:
    """Number of unit boundaries crossed: 00:59 to 01:01 is one HOUR."""
    seconds = _UNIT_SECONDS[unit.upper()]
    first, last = (F.unix_seconds(F.date_trunc(unit, as_column(c))) for c in (start, end))
    return ((last - first) / seconds).cast("bigint")


def future_rows(df: DataFrame, ts: str, as_of: str | Column | None = None) -> DataFrame:
    return df.where(F.col(ts) > now(as_of))


# -- exact sums -------------------------------------------------------------
def exact(col: str | Column, kind: str = "decimal(20,8)") -> Column:
    """Decimal form of a double measure.

    Decimal sums do not depend on the order of rows, so a rerun with other
    partitions returns the very same total.
    """
    return as_column(col).cast(kind)


def kwh_total(col: str | Column, kind: str = "decimal(20,8)") -> Column:
    return F.sum(exact(col, kind)).cast("decimal(18,4)")


def kwh_average(col: str | Column, kind: str = "decimal(20,8)") -> Column:
    return F.avg(exact(col, kind)).cast("decimal(18,4)")


def safe_divide(numerator: str | Column, denominator: str | Column, otherwise: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(as_column(numerator), as_column(denominator)), F.lit(otherwise))


def default_if_falsy(col: str | Column, default: float = schemas.DEFAULT_VOLTAGE) -> Column:
    """``default`` for NULL and for zero."""
    return F.coalesce(F.nullif(as_column(col), F.lit(0).cast("double")), F.lit(default))


# -- optional predicates ----------------------------------------------------
def optional_eq(df: DataFrame, col: str, value: object | None) -> DataFrame:
    """Filter only when a value is given, so that no dead predicate reaches the plan."""
    return df if value is None else df.where(F.col(col) == F.lit(value))


def optional_date_range(df: DataFrame, col: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Both ends inclusive. A bound that is no date matches no row."""
    if start is not None:
        df = df.where(F.col(col) >= F.lit(start).try_cast("date"))
    if end is not None:
        df = df.where(F.col(col) <= F.lit(end).try_cast("date"))
    return df


def optional_ts_range(df: DataFrame, col: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """From ``start`` to one day past ``end``, so that a date as end covers that whole day."""
    if start is not None:
        df = df.where(F.col(col) >= F.lit(start).try_cast("timestamp"))
    if end is not None:
        df = df.where(F.col(col) < F.lit(end).try_cast("timestamp") + F.expr("INTERVAL 1 DAY"))
    return df


# -- business rules ---------------------------------------------------------
def choose_tariff(segment: str | Column, household_size: str | Column) -> Column:
    return (
        F.when(as_column(segment) == "Small Business", schemas.TARIFF_BUSINESS)
        .when(as_column(household_size) <= 2, schemas.TARIFF_ECO)
        .otherwise(schemas.TARIFF_STANDARD)
    )


def estimated_cost(kwh: str | Column, price: str | Column, standing: str | Column) -> Column:
    """``kwh * price + standing charge`` in decimals, half up to four places."""
    energy = as_column(kwh).cast("decimal(12,4)") * as_column(price).cast("decimal(10,4)")
    return F.round(energy + as_column(standing).cast("decimal(10,4)"), 4).cast("decimal(12,4)")

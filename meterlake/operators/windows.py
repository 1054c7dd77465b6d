"""Ordered operators that keep working when one key holds a large share of the rows.

Three forms are used:

* *first row per key*: ``row_number() = 1``. Spark cuts every map task to one row
  per key before the shuffle (WindowGroupLimit), so a hot key sends at most one row
  per input split.
* *flag all but the first*: ranked twice, first inside (key, input split), then
  among the winners of the splits. No group outgrows one split.
* *row numbers, running and sliding values*: the order (key, order) is cut at quantiles into
  slices, so a hot key lies in many; one summary row per slice and key carries counts and
  sums from slice to slice, and a window works inside its (key, slice) only.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions import as_column

_SPLIT, _RANK = "__split", "__rank"
_SLICE, _GROUP = "__slice", "__group"
_DRAWN, _SEED = 40, 7  # rows drawn for each slice
_DECIMAL_DIGITS = 38


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in ``order_by``, which should be a total order."""
    ranked = df.withColumn(_RANK, F.row_number().over(W.partitionBy(*keys).orderBy(*order_by)))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def distinct_by(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """One row per key; without ``order_by`` the smallest row over all columns wins, so reruns agree."""
    order_by = order_by or [F.col(c).asc_nulls_last() for c in df.columns if c not in keys] or list(keys)
    return first_per_key(df, keys, order_by)


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str, tie_break: Sequence[str]) -> DataFrame:
    """The row with the greatest time per key; among equal times the greatest ``tie_break``."""
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in (ts, *tie_break)])


def mark_duplicates(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column], flag: str = "is_duplicate",
) -> DataFrame:
    """Add ``flag``: true for every row of a key but the first. A NULL key is never a duplicate.

    The split number, not a random salt, separates the groups of the first pass: it is the same
    when a task is run again after an executor was lost, and it also spreads exact copies.
    """
    keyed = F.lit(True)
    for key in keys:
        keyed = keyed & F.col(key).isNotNull()
    order_by = [as_column(c) for c in order_by]
    in_split = W.partitionBy(*keys, _SPLIT).orderBy(*order_by)
    losers_apart = F.when((F.col(_RANK) == 1) & keyed, F.lit(-1)).otherwise(F.col(_SPLIT))
    overall = W.partitionBy(*keys, losers_apart).orderBy(*order_by)
    return (
        df.withColumn(_SPLIT, F.spark_partition_id())
        .withColumn(_RANK, F.row_number().over(in_split))
        .withColumn(flag, keyed & ((F.col(_RANK) > 1) | (F.row_number().over(overall) > 1)))
        .drop(_SPLIT, _RANK)
    )


# -- slices: one global order, cut at quantiles ------------------------------------------
class Order(NamedTuple):
    """One term of an order: ascending with nulls first, or descending with nulls last, as Spark sorts them."""

    column: str | Column
    descending: bool = False

    def sort_key(self) -> Column:
        column = as_column(self.column)
        return column.desc() if self.descending else column.asc()


def descending(column: str | Column) -> Order:
    return Order(column, True)


def _terms(order_by: Sequence[str | Column | Order]) -> list[Order]:
    return [o if isinstance(o, Order) else Order(o) for o in order_by]


def _comparable(term: Order, kind: T.DataType) -> Column:
    """The term as a value whose text can be turned back into it exactly, in the same order."""
    column = as_column(term.column)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        return F.unix_micros(column.cast("timestamp_ntz").cast("timestamp"))
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    if isinstance(kind, T.BooleanType):
        return column.cast("int")
    return column


def _at_or_after(names: Sequence[str], descending: Sequence[bool], bounds: Sequence[Column], place: Column) -> Column:
    """True if the row does not stand before the bound at ``place`` in the order; ``bounds`` has an array for each name."""
    condition = F.lit(True)
    for name, down, values in list(zip(names, descending, bounds, strict=True))[::-1]:
        own, other = F.col(name), F.get(values, place)
        # nulls are the least value: first when ascending, last when descending
        beyond = F.coalesce(own < other, own.isNull() & other.isNotNull()) if down else F.coalesce(own > other, own.isNotNull() & other.isNull())
        condition = beyond | (own.eqNullSafe(other) & condition)
    return condition


def _place(names: Sequence[str], descending: Sequence[bool], cuts: Sequence[Sequence[str | None]], kinds: Sequence[str]) -> Column:
    """How many of the ``cuts`` (in order, values as text) a row stands at or after, by halving.

    The cuts are constant arrays that one short expression looks into, so generated code does not grow with their number and a plan holds each of them a few times only.
    """
    if not cuts:
        return F.lit(0)
    bounds = [F.from_json(F.lit(json.dumps(values)), "array<string>").cast(f"array<{kind}>") for values, kind in zip(zip(*cuts), kinds, strict=True)]
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])

    def ahead(at: Column, step: Column) -> Column:
        there = (at + step <= len(cuts)) & _at_or_after(names, descending, bounds, at + step - 1)
        return F.when(there, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), ahead)


def _sliced(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column | Order], slices: int | None = None) -> DataFrame:
    """``df`` with the number of the slice each row lies in, in the order (keys, order_by).

    Slices are cut at quantiles of a random draw of rows, _DRAWN for each slice, which decide how even the slices are and nothing else; a hot key is cut like any other range. Only columns of
    the order are read for the draw, and a slice follows from a row's own values, so a task that is run again puts its rows where they were. Rows equal in the whole order share a slice.
    ``slices`` is the session's number of shuffle partitions unless given.
    """
    spark = df.sparkSession
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    terms = _terms([*keys, *order_by])
    names = [f"__o{i}" for i in range(len(terms))]
    kinds = df.select(*[as_column(t.column).alias(n) for t, n in zip(terms, names)]).schema
    placed = df.withColumns({n: _comparable(t, kinds[n].dataType) for t, n in zip(terms, names)})
    types = [placed.schema[n].dataType.simpleString() for n in names]
    down = [t.descending for t in terms]
    drawn = placed.select(*names).orderBy(F.rand(_SEED)).limit(_DRAWN * slices)
    ordered = drawn.orderBy(*[Order(n, d).sort_key() for n, d in zip(names, down)]).select(*[F.col(n).cast("string") for n in names]).collect()  # _DRAWN * slices short rows
    cuts = list(dict.fromkeys(tuple(ordered[len(ordered) * i // slices]) for i in range(1, slices))) if ordered else []
    return placed.withColumn(_SLICE, _place(names, down, cuts, types)).drop(*names)


def _groups(sliced: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """With ``__group``, a hash of the keys without nulls, so that a join and a window on (slice, group) share one shuffle."""
    return sliced.withColumn(_GROUP, F.xxhash64(*keys) if keys else F.lit(0).cast("bigint")), [_SLICE, _GROUP, *keys]


def _with_earlier_slices(sliced: DataFrame, keys: Sequence[str], totals: dict[str, Column]) -> tuple[DataFrame, list[str]]:
    """Every row with its key's ``totals`` over the earlier slices, and the columns that name a row's group.

    One row per (key, slice) is summed over the slices of a key; without keys these are as many rows as there are slices.
    """
    rows, group = _groups(sliced, keys)
    per_slice = rows.groupBy(*group).agg(*[c.alias(name) for name, c in totals.items()])
    earlier = W.partitionBy(_GROUP, *keys) if keys else W.partitionBy()
    earlier = earlier.orderBy(_SLICE).rowsBetween(W.unboundedPreceding, -1)
    summary = per_slice.select(
        F.col(_SLICE).alias("__s"), F.col(_GROUP).alias("__g"), *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *[F.sum(name).over(earlier).alias(name) for name in totals])
    match = (F.col(_SLICE) == F.col("__s")) & (F.col(_GROUP) == F.col("__g"))
    for i, key in enumerate(keys):
        match = match & F.col(key).eqNullSafe(F.col(f"__k{i}"))
    return rows.join(summary, match).drop("__s", "__g", *[f"__k{i}" for i in range(len(keys))]), group


def row_number_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column | Order], name: str = "row_number", slices: int | None = None,
) -> DataFrame:
    """``row_number`` over (keys, order) whose work is spread evenly, however the keys are distributed.

    With no keys this numbers the whole table without a single-task sort.
    """
    placed, group = _with_earlier_slices(_sliced(df, keys, order_by, slices), keys, {"__before": F.count("*")})
    here = W.partitionBy(*group).orderBy(*[t.sort_key() for t in _terms(order_by)])
    number = F.coalesce(F.col("__before"), F.lit(0)) + F.row_number().over(here)
    return placed.select(*df.columns, number.alias(name))


def sequence_number(df: DataFrame, order_by: Sequence[str | Column | Order], name: str = "sequence_number") -> DataFrame:
    """Number all rows 1, 2, 3, ... in ``order_by``."""
    return row_number_per_key(df, [], order_by, name)


def running_sum(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str | Column | Order], value: str, name: str = "running_total", slices: int | None = None,
) -> DataFrame:
    """Sum of ``value`` from the first row of the key up to and including this one."""
    placed, group = _with_earlier_slices(_sliced(df, partition_by, order_by, slices), partition_by, {"__before": F.sum(value)})
    here = W.partitionBy(*group).orderBy(*[t.sort_key() for t in _terms(order_by)]).rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = F.sum(value).over(here)
    total = F.coalesce(F.col("__before") + inside, inside, F.col("__before"))
    return placed.select(*df.columns, total.alias(name))


def _over_recent(
    df: DataFrame, key: str, ts: str, value: str, n: int, tie_break: Sequence[str], aggregates: dict[str, Column], slices: int | None = None,
) -> DataFrame:
    """``aggregates`` of ``value`` over the ``n`` rows of the key before each one.

    A slice borrows the last ``n`` rows of its key that lie in earlier slices; no window needs more than its own group.
    """
    order = [ts, *tie_break]
    rows, group = _groups(_sliced(df, [key], order, slices), [key])
    last = W.partitionBy(*group).orderBy(*[Order(c, True).sort_key() for c in order])
    ends = rows.select(*group, value, *[c for c in order if c not in (value, *group)]).withColumn("__back", F.row_number().over(last)).where(F.col("__back") <= n)
    # the values in order; a key has at least one row in each slice listed, so the n slices before hold all that can matter
    tail = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("__back")).alias("at"), F.col(value).alias("v")))), lambda r: r["v"])
    tails = ends.groupBy(*group).agg(tail.alias("__tail"))
    before = W.partitionBy(_GROUP, key).orderBy(_SLICE).rowsBetween(-n, -1)
    lent = F.flatten(F.collect_list("__tail").over(before))
    lent = tails.withColumn("__lent", F.slice(lent, F.greatest(F.size(lent) - n + 1, F.lit(1)), n)).select(*group, F.posexplode("__lent").alias("__at", value))
    both = rows.withColumn("__at", F.lit(None).cast("int")).unionByName(lent, allowMissingColumns=True)
    own = F.col("__at").isNull()
    previous = W.partitionBy(*group).orderBy(own, "__at", *order).rowsBetween(-n, -1)
    return both.withColumns({new: made.over(previous) for new, made in aggregates.items()}).where(own).select(*df.columns, *aggregates)


def recent_average(
    df: DataFrame, key: str, ts: str, value: str, n: int, tie_break: Sequence[str] = (),
    name: str = "recent_average", slices: int | None = None,
) -> DataFrame:
    """Average of ``value`` over the ``n`` rows of the key before this one; NULL for the first row."""
    return _over_recent(df, key, ts, value, n, tie_break, {name: F.avg(value)}, slices)


def recent_avg_anomaly(
    df: DataFrame, key: str, ts: str, value: str, n: int, factor: float = 3, tie_break: Sequence[str] = (),
    name: str = "recent_average",
) -> DataFrame:
    """Rows whose value exceeds ``factor`` times the positive average of the key's ``n`` rows before.

    The average of decimals is rounded, so decimals are compared as ``value * rows > factor * sum``, where that fits a decimal.
    """
    total, rows = "__recent_total", "__recent_rows"
    seen = _over_recent(df, key, ts, value, n, tie_break, {name: F.avg(value), total: F.sum(value), rows: F.count(value)})
    above = F.col(value) > F.col(name) * factor
    kind, times = df.schema[value].dataType, Decimal(str(factor))
    width = max(len(times.as_tuple().digits), -times.as_tuple().exponent)
    if isinstance(kind, T.DecimalType) and times.as_tuple().exponent <= 0 and kind.precision + 11 + width <= _DECIMAL_DIGITS:
        above = F.col(value) * F.col(rows).cast(T.DecimalType(10, 0)) > F.col(total) * F.lit(times)
    return seen.where((F.col(name) > 0) & above).drop(total, rows)


# -- limits --------------------------------------------------------------------
def top_k(df: DataFrame, by: str, k: int = 5, tie_break: Sequence[str] = ()) -> DataFrame:
    """The ``k`` greatest rows, for a report: every task keeps ``k`` and one task merges those, so ``k`` should fit in memory."""
    return df.orderBy(F.col(by).desc(), *tie_break).limit(k)


def top_latest(readings: DataFrame, k: int, meter: str = "meter_id", ts: str = "event_timestamp",
               value: str = "kwh", tie_break: Sequence[str] = ("event_id",)) -> DataFrame:
    """The meters with the highest latest reading."""
    return top_k(latest_per_key(readings, [meter], ts, tie_break), value, k, [meter])


def newest(df: DataFrame, ts: str, n: int = 100, tie_break: Sequence[str] = ()) -> DataFrame:
    return top_k(df, ts, n, tie_break)

"""Joins. Equi-joins only; Spark broadcasts a side when its measured size allows and AQE splits skewed keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.session import scratch_path


def weather_features(consumption: DataFrame, weather: DataFrame, as_of: str | None = None) -> DataFrame:
    """Every consumption row with the weather of its region, date and hour, if there is any."""
    from meterlake.functions import now

    measures = ["temperature_c", "humidity_percent", "wind_speed_kph", "precipitation_mm"]
    hourly = weather.select(
        "region_name", F.col("weather_date").alias("reading_date"), F.col("weather_hour").alias("reading_hour"), *measures)
    return consumption.join(hourly, ["region_name", "reading_date", "reading_hour"], "left").select(
        "reading_timestamp", "reading_date", "reading_hour", "region_name", "meter_id", "customer_id",
        F.round("kwh", 4).alias("kwh"), *measures, now(as_of).alias("processed_timestamp"),
    )


def star_join(fact: DataFrame, dims: Mapping[str, DataFrame], keys: Mapping[str, str], how: str = "inner") -> DataFrame:
    """Join a fact with dimensions; ``keys[name]`` is the key column both sides share.

    A dimension column the fact already has is left out, so the fact's own value stays unambiguous.
    """
    for name, dim in dims.items():
        key = keys[name]
        fresh = [c for c in dim.columns if c == key or c not in fact.columns]
        fact = fact.join(dim.select(*fresh), key, how)
    return fact


def orphans(fact: DataFrame, dim: DataFrame, fk: str, pk: str, skip_null: bool = False) -> DataFrame:
    """Fact rows whose key is not in the dimension; NULL keys too unless ``skip_null``.

    Distinct keys are matched first, so the fact is never shuffled on a skewed key: repeated keys
    collapse before the shuffle, and the few unmatched ones go back to the rows.
    """
    keys = fact.select(F.col(fk).alias("__fk")).distinct()
    if skip_null:
        keys = keys.where(F.col("__fk").isNotNull())
    unmatched = keys.join(dim.select(F.col(pk).alias("__pk")), F.col("__fk") == F.col("__pk"), "left_anti")
    return fact.join(unmatched, F.col(fk).eqNullSafe(F.col("__fk")), "left_semi")


def orphan_count(fact: DataFrame, dim: DataFrame, fk: str, pk: str, skip_null: bool = False) -> DataFrame:
    """One row, ``failed_count``: fact rows without a dimension row. Counts per key, then matches keys."""
    counts = fact.groupBy(F.col(fk).alias("__fk")).agg(F.count("*").alias("__n"))
    if skip_null:
        counts = counts.where(F.col("__fk").isNotNull())
    missing = counts.join(dim.select(F.col(pk).alias("__pk")), F.col("__fk") == F.col("__pk"), "left_anti")
    return missing.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("failed_count"))


class ForeignKey(NamedTuple):
    """A relationship: column ``fk`` of table ``fact`` refers to ``pk`` of ``dim``.

    ``record_id`` names a fact row in reports; with ``skip_null`` a NULL reference is no finding.
    """

    issue: str
    fact: str
    record_id: str
    fk: str
    dim: str
    pk: str
    skip_null: bool = False


_MISSING = "missing_key"


def _kind(kind: T.DataType) -> str:
    """Key types that compare with each other share a column; no key becomes text to be matched."""
    return "bigint" if isinstance(kind, T.IntegralType) else kind.simpleString()


class _Keys:
    """Keys of all relationships as rows (``__no``, one column for each type of key, the others NULL)."""

    def __init__(self, tables: Mapping[str, DataFrame], relationships: Sequence[ForeignKey]):
        self.tables, self.relationships = tables, relationships
        self.kinds = [_kind(tables[r.fact].schema[r.fk].dataType) for r in relationships]
        names = list(dict.fromkeys(self.kinds))
        self.column = {kind: f"__key{i}" for i, kind in enumerate(names)}
        self.columns = list(self.column.values())

    def entry(self, number: int, column: str, *more: Column) -> Column:
        keys = [F.col(column).cast(kind).alias(name) if kind == self.kinds[number] else F.lit(None).cast(kind).alias(name) for kind, name in self.column.items()]
        return F.struct(F.lit(number).alias("__no"), *keys, *more)

    def used(self, with_record: bool = False) -> DataFrame:
        """References of the facts; each fact is read once. NULL references only where they are a finding."""
        from meterlake.operators.aggregates import union_all

        def record(r: ForeignKey) -> list[Column]:
            return [F.col(r.record_id).cast("string").alias("record_id"), F.col(r.fk).cast("string").alias(_MISSING)] if with_record else []

        frames = []
        for fact in dict.fromkeys(r.fact for r in self.relationships):
            entries = [self.entry(i, r.fk, *record(r)) for i, r in enumerate(self.relationships) if r.fact == fact]
            frames.append(self.tables[fact].select(F.inline(F.array(*entries))))
        skipping = [i for i, r in enumerate(self.relationships) if r.skip_null]
        rows = union_all(frames)
        return rows.where(self._given() | ~F.col("__no").isin(*skipping)) if skipping else rows

    def _given(self) -> Column:
        return reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in self.columns])

    def known(self) -> DataFrame:
        """Keys of the dimensions, for every relationship that asks for them; each dimension is read once."""
        from meterlake.operators.aggregates import union_all

        frames = []
        for dim, pk in dict.fromkeys((r.dim, r.pk) for r in self.relationships):
            keys = self.tables[dim].select(pk).where(F.col(pk).isNotNull())
            frames.append(keys.select(F.inline(F.array(*[self.entry(i, pk) for i, r in enumerate(self.relationships) if (r.dim, r.pk) == (dim, pk)]))))
        return union_all(frames)

    def counts(self) -> DataFrame:
        """Per relationship and key: how many rows refer to it (``__n``) and whether the dimension has it (``__known``).

        References and known keys meet in one aggregation with partial sums, so neither a hot key nor a long fact matters, and no join is needed.
        """
        facts = self.used().select("*", F.lit(1).cast("bigint").alias("__one"), F.lit(False).alias("__there"))
        dims = self.known().select("*", F.lit(0).cast("bigint").alias("__one"), F.lit(True).alias("__there"))
        return facts.unionByName(dims).groupBy("__no", *self.columns).agg(F.sum("__one").alias("__n"), F.bool_or("__there").alias("__known"))


def _by_number(values: Sequence[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), F.col("__no") + 1)


def referential_report(tables: Mapping[str, DataFrame], relationships: Sequence[ForeignKey]) -> DataFrame:
    """All orphans of all relationships: issue_name, record_id, missing_key (both as text).

    Two passes over each fact, however many keys it has: the first finds the unknown keys and stores them, so that the second is planned by their measured size: few of them travel to the rows, else the rows are shuffled once.
    """
    keys = _Keys(tables, relationships)
    unknown = keys.counts().where(~F.col("__known") & (F.col("__n") > 0)).select(F.col("__no").alias("__u"), *[F.col(c).alias(f"__u{c}") for c in keys.columns])
    spark = unknown.sparkSession
    path = scratch_path(spark, "unknown_keys")
    unknown.write.parquet(path)
    unknown = spark.read.schema(unknown.schema).parquet(path)
    match = F.col("__no") == F.col("__u")
    for c in keys.columns:
        match = match & F.col(c).eqNullSafe(F.col(f"__u{c}"))
    issue = _by_number([r.issue for r in relationships]).alias("issue_name")
    return keys.used(with_record=True).join(unknown, match, "left_semi").select(issue, "record_id", _MISSING)


def referential_counts(tables: Mapping[str, DataFrame], relationships: Sequence[ForeignKey]) -> DataFrame:
    """Orphans per relationship, zero included: constraint_name, failed_count. One pass over each fact and dimension."""
    found = _Keys(tables, relationships).counts().groupBy("__no").agg(F.sum(F.when(F.col("__known"), 0).otherwise(F.col("__n"))).alias("n"))
    every = found.sparkSession.range(len(relationships)).select(F.col("id").cast("int").alias("__no"))
    return every.join(found, "__no", "left").select(
        _by_number([r.issue for r in relationships]).alias("constraint_name"), F.coalesce("n", F.lit(0)).alias("failed_count"))


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str], within: str | None = None) -> DataFrame:
    """The target plus the source rows whose key it does not hold yet.

    Where a key always lies in the same ``within`` (its day, say), only that part of the target which the source touches is looked through.
    """
    near = target if within is None else target.join(source.select(within).distinct(), within, "left_semi")
    fresh = source.join(near.select(*keys).distinct(), list(keys), "left_anti")
    return target.unionByName(fresh)


def lookup(
    df: DataFrame, dim: DataFrame, key: str, columns: Sequence[str], on_missing: str = "error",
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Add dimension columns by natural key.

    ``error`` fails the job on a key without a dimension row, ``drop`` skips such rows,
    ``reject`` returns (matched, unmatched).
    """
    found = dim.select(key, *columns).withColumn("__found", F.lit(True))
    joined = df.join(found, key, "inner" if on_missing == "drop" else "left")
    matched = F.coalesce("__found", F.lit(False))
    if on_missing == "drop":
        return joined.drop("__found")
    if on_missing == "reject":
        return joined.where(matched).drop("__found"), joined.where(~matched).select(*df.columns)
    if on_missing != "error":
        raise ValueError(f"unknown on_missing: {on_missing}")
    message = F.concat(F.lit(f"no dimension row for {key} "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
    checked = {
        name: F.when(matched, F.col(name)).otherwise(F.raise_error(message).cast(dim.schema[name].dataType))
        for name in columns
    }
    return joined.withColumns(checked).drop("__found")


def range_join(left: DataFrame, right: DataFrame, day: str, low: str | Column, high: str | Column) -> DataFrame:
    """Rows of ``left`` with each row of ``right`` whose date ``day`` lies between low and high (inclusive).

    A left row is expanded to the days of its own range that lie between the other side's first and last day, and equi-joined, so
    no row pair is tested in vain and a range of centuries makes no more days than the other side spans. A NULL high is an
    open end; a NULL low or a reversed range matches nothing.
    """
    low, high = ((F.col(c) if isinstance(c, str) else c).cast("date") for c in (low, high))
    first, last = (right.agg(f(day)).scalar() for f in (F.min, F.max))
    start, end = F.greatest(low, first), F.least(F.coalesce(high, last), last)
    days = F.explode(F.when(low.isNotNull() & (start <= end), F.sequence(start, end)))
    return left.select("*", days.alias(day)).join(right, day)


_WIDEST = 62  # an interval without an end


def range_join_times(
    intervals: DataFrame, points: DataFrame, at: str, low: str, high: str, keys: Sequence[str] = (), fineness: int = 3,
) -> DataFrame:
    """Rows of ``intervals`` with each row of ``points`` whose time ``at`` lies between low and high (inclusive) and whose ``keys`` are equal.

    An interval lies in blocks of a width that fits its length: 2 ** k microseconds, with at most 2 ** fineness + 1 blocks, whether it spans seconds or centuries. A point is given the block it lies in for each
    width that intervals have, a few dozen at most. Interval and point meet in one block of an equi-join and are then compared exactly. Timestamps and dates work, not days alone. A NULL high is an open end; a NULL low
    or a reversed interval matches nothing. Columns both sides have must be among ``keys``.
    """
    start, end, point = (F.unix_micros(F.col(c).cast("timestamp")) for c in (low, high, at))
    length = F.length(F.bin(end - start))  # 2 ** length is more than the distance
    level = F.when(F.col(high).isNull(), _WIDEST - fineness).otherwise(F.greatest(length - fineness, F.lit(0)))
    shift = F.col("__level").cast("int")
    placed = intervals.where(F.col(low).isNotNull() & (F.col(high).isNull() | (F.col(low) <= F.col(high)))).withColumns({"__level": level.cast("int"), "__start": start})
    widths = placed.agg(F.collect_set("__level").alias("w")).select(F.coalesce("w", F.array().cast("array<int>")).alias("w")).scalar()  # at most 63 numbers
    last = F.coalesce(end, F.lit((1 << _WIDEST) - 1))
    blocks = F.sequence(F.call_function("shiftright", "__start", shift), F.call_function("shiftright", last, shift))
    placed = placed.withColumn("__block", F.explode(blocks)).withColumn("__end", last)
    seen = points.withColumn("__at", point).where(F.col("__at").isNotNull()).withColumn("__level", F.explode(widths))
    seen = seen.withColumn("__block", F.call_function("shiftright", "__at", shift))
    # the block comes first: rows are sorted by the keys in turn, and a number that tells most of them apart is compared at once
    met = placed.join(seen, ["__block", "__level", *keys]).where(F.col("__at").between(F.col("__start"), F.col("__end")))
    return met.drop("__level", "__block", "__start", "__end", "__at")


def with_slots(df: DataFrame, slots: int, name: str = "slot_number") -> DataFrame:
    """Every row once per slot 1..n: a cross join with a constant list, written as an expansion."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(1), F.lit(slots))))


def active_child_inactive_parent(child: DataFrame, parent: DataFrame, key: str, active: str = "is_active") -> DataFrame:
    """Active child rows (meters) whose parent (customer) is inactive."""
    actives = child.where(F.col(active)).select("*", F.col(active).alias("child_is_active")).drop(active)
    inactives = parent.where(~F.col(active)).select(key, F.col(active).alias("parent_is_active"))
    return actives.join(inactives, key)

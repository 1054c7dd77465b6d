"""Data quality: row-level findings, constraint audits and a gate over declarative checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions import future_rows, now, prefixed_sha1
from meterlake.operators.aggregates import duplicate_keys, tagged_union, union_all
from meterlake.operators.joins import ForeignKey, orphan_count, referential_counts

# -- findings -------------------------------------------------------------------
Sources = Mapping[str, tuple[DataFrame, str]]  # table name -> (rows, id column)


def predicate_check(tables: Sources, column: str, failed: Column, extra: str | None = None) -> DataFrame:
    """Rows of all tables for which ``failed`` holds: table_name, record_id and the column."""
    hits = {name: (df.where(failed), id_col) for name, (df, id_col) in tables.items()}
    return tagged_union(hits, dict.fromkeys(tables, column), extra or column)


def null_check(tables: Sources, column: str) -> DataFrame:
    return predicate_check(tables, column, F.col(column).isNull())


def negative_check(tables: Sources, column: str = "kwh") -> DataFrame:
    return predicate_check(tables, column, F.col(column) < 0)


def future_check(tables: Mapping[str, tuple[DataFrame, str, str]], as_of: str | None = None) -> DataFrame:
    """Rows dated after ``as_of``; each table names its own time column."""
    hits = {name: (future_rows(df, ts, as_of), id_col) for name, (df, id_col, ts) in tables.items()}
    return tagged_union(hits, {name: ts for name, (_, _, ts) in tables.items()}, "timestamp_value")


# -- constraint audits ------------------------------------------------------------
def _stack(row: DataFrame, names: Sequence[str], label: str) -> DataFrame:
    """One row of counts to one row per count."""
    pairs = F.array(*[F.struct(F.lit(n).alias(label), F.col(f"c{i}").alias("failed_count")) for i, n in enumerate(names)])
    return row.select(F.inline(pairs))


def audit_checks(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Violations per CHECK constraint in one pass. NULL passes, as in SQL; only FALSE counts."""
    counts = [F.count_if(F.coalesce(~ok, F.lit(False))).alias(f"c{i}") for i, ok in enumerate(checks.values())]
    return _stack(df.agg(*counts), list(checks), "check_name")


def audit_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column in one pass."""
    counts = [F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(columns)]
    return _stack(df.agg(*counts), list(columns), "column_name")


def audit_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """NULLs in the columns a result contract declares NOT NULL."""
    return audit_not_null(df, [f.name for f in contract if not f.nullable])


def audit_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row counts."""
    return duplicate_keys(df, keys)


def audit_fk(tables: Mapping[str, DataFrame], constraints: Sequence[tuple[str, str, str, str, str]]) -> DataFrame:
    """Violations per foreign key (name, child, column, parent, key). A NULL reference is allowed, as in SQL."""
    return referential_counts(tables, [
        ForeignKey(name, child, fk, fk, parent, pk, skip_null=True) for name, child, fk, parent, pk in constraints])


def with_defaults(df: DataFrame, defaults: Mapping[str, object | Column]) -> DataFrame:
    """Column defaults: fill NULLs, and add a column that is missing altogether."""
    def filled(name: str, default: object | Column) -> Column:
        default = default if isinstance(default, Column) else F.lit(default)
        return F.coalesce(F.col(name), default) if name in df.columns else default

    return df.withColumns({name: filled(name, value) for name, value in defaults.items()})


# -- check suite --------------------------------------------------------------------
class Check(NamedTuple):
    """``failures`` is an aggregate over ``table`` that is 0 when the check passes."""

    name: str
    table: str
    failures: Column


class QueryCheck(NamedTuple):
    """A check no single aggregate can state; ``failures`` has one row with ``failed_count``."""

    name: str
    table: str
    failures: DataFrame


class ReferenceChecks(NamedTuple):
    """One check for each relationship (its ``issue`` is the name): the rows of ``table`` without a parent, all from one pass over it."""

    table: str
    failures: DataFrame


def no_orphans_of(table: str, tables: Mapping[str, DataFrame], relationships: Sequence[ForeignKey]) -> ReferenceChecks:
    return ReferenceChecks(table, referential_counts(tables, relationships))


def has_rows(name: str, table: str) -> Check:
    return Check(name, table, F.when(F.count("*") > 0, 0).otherwise(1))


def no_row_where(name: str, table: str, bad: Column) -> Check:
    return Check(name, table, F.count_if(bad))


def any_value(name: str, table: str, column: str) -> Check:
    return Check(name, table, F.when(F.max(column).isNotNull(), 0).otherwise(1))


def no_duplicates(name: str, table: str, df: DataFrame, keys: Sequence[str]) -> QueryCheck:
    return QueryCheck(name, table, duplicate_keys(df, keys).agg(F.count("*").alias("failed_count")))


def no_orphans(name: str, table: str, fact: DataFrame, dim: DataFrame, fk: str, pk: str, skip_null: bool = False) -> QueryCheck:
    return QueryCheck(name, table, orphan_count(fact, dim, fk, pk, skip_null))


def run_checks(
    tables: Mapping[str, DataFrame], checks: Sequence[Check | QueryCheck | ReferenceChecks], run_id: str, as_of: str | None = None,
) -> DataFrame:
    """One result row per check. All aggregate checks of a table share a single pass over it."""
    results = []
    by_table: dict[str, list[Check]] = {}
    for check in checks:
        if isinstance(check, Check):
            by_table.setdefault(check.table, []).append(check)
        elif isinstance(check, ReferenceChecks):
            results.append(check.failures.select(F.col("constraint_name").alias("check_name"), F.lit(check.table).alias("table_name"), F.col("failed_count").cast("bigint").alias("failed_count")))
        else:
            results.append(check.failures.select(
                F.lit(check.name).alias("check_name"), F.lit(check.table).alias("table_name"),
                F.col("failed_count").cast("bigint").alias("failed_count")))
    for table, group in by_table.items():
        counts = tables[table].agg(*[c.failures.cast("bigint").alias(f"c{i}") for i, c in enumerate(group)])
        results.append(_stack(counts, [c.name for c in group], "check_name")
                       .select("check_name", F.lit(table).alias("table_name"), "failed_count"))
    return union_all(results).select(
        prefixed_sha1("AF-DQ-", 18, F.lit(run_id), "check_name").alias("check_id"),
        F.lit(run_id).alias("pipeline_run_id"), "check_name", "table_name",
        F.when(F.col("failed_count") == 0, "passed").otherwise("failed").alias("status"),
        "failed_count", now(as_of).alias("checked_at"),
    )


class QualityGateError(ValueError):
    pass


def gate(results: DataFrame) -> None:
    """Raise when any check failed. Results hold one row per check, so what is read here is small."""
    failed = results.where(F.col("status") == "failed").select("check_name", "failed_count").sort("check_name").collect()
    if failed:
        raise QualityGateError("data-quality checks failed: " + ", ".join(f"{r[0]} ({r[1]})" for r in failed))

"""The batch pipeline: bronze CSV to silver, gold, warehouse facts and the quality gate.

Each layer is written once and read back by the next, so no layer is computed twice and a lost executor
costs at most one stage. Rows are counted while they are written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake import schemas
from meterlake.operators import aggregates as agg
from meterlake.operators import cleaning, dimensions, quality
from meterlake.operators.joins import ForeignKey, lookup, weather_features
from meterlake.operators.windows import sequence_number
from meterlake.plans import runlog
from meterlake.plans.runlog import observe_counts
from meterlake.sources.readers import exists, read_csv_file, read_csv_tree
from meterlake.sources.sinks import arranged, together, write_batch, write_table


class Result(NamedTuple):
    tables: dict[str, DataFrame]  # silver, gold and warehouse tables by name, read back from storage
    counts: dict[str, int]  # rows written per table
    checks: DataFrame
    log: DataFrame | None = None  # last state of every run recorded in the log folder
    history: DataFrame | None = None  # check results of all runs


class _Store:
    """Writes tables under a root and remembers how many rows each got."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.counts = spark, root.rstrip("/"), {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, name: str, df: DataFrame, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> DataFrame:
        # counted behind the last shuffle: range partitioning samples its input, which would count rows twice
        observed, seen = observe_counts(arranged(df, partition_by, sort_by), name.replace("/", "_"))
        write_table(observed, self.path(name), partition_by)
        self.counts[name] = seen.get["rows"]
        return self.load(name, df.schema)

    def save_all(self, layer: str, tables: dict[str, tuple]) -> dict[str, DataFrame]:
        """Save tables that do not depend on each other; values are (frame, partition columns, sort columns)."""
        names = list(tables)
        saved = together([partial(self.save, f"{layer}/{name}", *tables[name]) for name in names])
        return dict(zip(names, saved, strict=True))

    def load(self, name: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(name))


def bronze_to_silver(
    spark: SparkSession, bronze: str, store: _Store, regions: Sequence[str], as_of: str | None,
) -> dict[str, DataFrame]:
    consumption = cleaning.validate_consumption(
        read_csv_tree(spark, f"{bronze}/historical_consumption", schemas.BRONZE_CONSUMPTION), regions)
    # both outputs come from one validated table: stored once, so the deduplication runs once
    validated = store.save("staging/consumption", consumption)
    weather, weather_rejects = cleaning.transform_weather(
        read_csv_tree(spark, f"{bronze}/weather", schemas.BRONZE_WEATHER), regions, as_of)
    raw = [read_csv_file(spark, f"{bronze}/{name}.csv", schema) for name, schema in (
        ("customers", schemas.BRONZE_CUSTOMER), ("meters", schemas.BRONZE_METER), ("tariffs", schemas.BRONZE_TARIFF))]
    customers, meters, tariffs = cleaning.transform_metadata(*raw, as_of)
    rejects = agg.union_all([cleaning.rejected_consumption(validated, as_of), weather_rejects, cleaning.rejected_metadata(*raw, as_of)])
    valid, _ = cleaning.split_valid(validated)
    # the hash, most of a row's bytes, is made behind the shuffle that lays the rows out
    laid_out = arranged(valid.withColumn("reading_date", F.to_date("reading_timestamp")), ["reading_date"], ["meter_id"])
    return store.save_all("silver", {
        "clean_consumption": (cleaning.clean_consumption(laid_out, as_of), ["reading_date"]),
        "clean_weather": (weather, ["weather_date"], ["region_name"]),
        "clean_customer": (customers,),
        "clean_meter": (meters,),
        "clean_tariff": (tariffs,),
        "rejected_records": (rejects,),
    })


def silver_to_gold(silver: dict[str, DataFrame], store: _Store, as_of: str | None) -> dict[str, DataFrame]:
    consumption = silver["clean_consumption"]
    gold = store.save_all("gold", {
        "daily_region_consumption": (agg.daily_region(consumption),),
        "daily_customer_consumption": (agg.daily_customer(consumption),),
        "customer_usage_summary": (agg.customer_usage(consumption),),
        "consumption_weather_features": (
            weather_features(consumption, silver["clean_weather"], as_of), ["reading_date"], ["region_name", "meter_id"]),
    })
    return gold | store.save_all("gold", {"monthly_region_consumption": (agg.monthly_region(gold["daily_region_consumption"]),)})


def load_warehouse(
    silver: dict[str, DataFrame], gold: dict[str, DataFrame], store: _Store, batch_id: str, facts: str,
    previous: Mapping[str, DataFrame], as_of: str | None = None,
) -> dict[str, DataFrame]:
    """Dimensions as a new version under the store's root, this batch's facts into the shared folder ``facts``."""
    customers = silver["clean_customer"]
    daily = gold["daily_customer_consumption"]

    def merged(name: str, fresh: DataFrame, key: str) -> tuple[DataFrame]:
        """Rows of an earlier run that this one does not replace stay."""
        known = previous.get(name)
        return (fresh if known is None else dimensions.upsert(known.select(*fresh.columns), fresh, [key]),)

    regions = store.save("warehouse/dim_region", *merged(
        "dim_region", dimensions.dim_region(customers, previous.get("dim_region")), "region_name"))
    located = regions.select("region_name", "region_id")
    prices = {c: F.col(c).cast("decimal(10,4)") for c in ("price_per_kwh", "standing_charge_daily")}
    known_customers, lost_customers = lookup(customers, located, "region_name", ["region_id"], "reject")
    known_meters, lost_meters = lookup(silver["clean_meter"], located, "region_name", ["region_id"], "reject")
    dims = {"dim_region": regions} | store.save_all("warehouse", {
        "dim_tariff": merged("dim_tariff", silver["clean_tariff"].withColumns(prices), "tariff_id"),
        "dim_customer": merged("dim_customer", known_customers, "customer_id"),
        "dim_meter": merged("dim_meter", known_meters, "meter_id"),
        "dim_date": (dimensions.dim_date(daily, "reading_date", previous.get("dim_date")),),
    })
    fact, lost_facts = dimensions.build_consumption_fact(daily, customers, regions, dims["dim_tariff"], batch_id, on_missing="reject")
    lost = {"dim_customer": (lost_customers, "customer_id"), "dim_meter": (lost_meters, "meter_id"), "fact_consumption": (lost_facts, "customer_id")}
    dims["rejected_rows"] = store.save("warehouse/rejected_rows", agg.union_all([dimensions.lookup_rejects(df, name, key, batch_id, as_of) for name, (df, key) in lost.items()]))
    numbered = sequence_number(fact, ["meter_id", "date_id", "customer_id", "region_id"], "consumption_id").withColumn(
        "consumption_id", F.col("consumption_id") + _highest_id(store.spark, facts, batch_id))
    # a folder per day lets a date filter on the dimension prune the fact (dynamic partition pruning)
    observed, seen = observe_counts(arranged(numbered, ["date_id"], ["meter_id"]), "fact_consumption")
    write_batch(observed, facts, batch_id, partition_by=["date_id"])
    store.counts["warehouse/fact_consumption"] = rows = seen.get["rows"]
    write_batch(store.spark.range(1).select((F.lit(rows) + _highest_id(store.spark, facts, batch_id)).cast("bigint").alias("highest")), _ids(facts), batch_id)
    return {**dims, "fact_consumption": store.spark.read.schema(numbered.schema).parquet(facts)}


def _ids(facts: str) -> str:
    """Where each batch leaves the highest id it gave."""
    return f"{facts.rstrip('/')}_ids"


def _highest_id(spark: SparkSession, facts: str, batch_id: str) -> Column:
    """The greatest fact id of all other batches, 0 when there are none: one number for each batch is read, no fact."""
    if not exists(spark, _ids(facts)):
        return F.lit(0)
    # the schema is given, so that a batch id such as 00042 is not read back as a number
    others = spark.read.schema("highest bigint, batch_id string").parquet(_ids(facts)).where(F.col("batch_id") != batch_id)
    return others.agg(F.coalesce(F.max("highest"), F.lit(0))).scalar()


def warehouse_checks(tables: dict[str, DataFrame], run: Column | None = None) -> list:
    """The gate's checks; with the log among the tables, also that it holds the record of this very run (``pipeline_run_id``)."""
    name = "fact_energy_consumption"
    recorded = F.when(F.count_if(F.col("pipeline_run_id") == run) > 0, 0).otherwise(1) if run is not None else F.when(F.count("*") > 0, 0).otherwise(1)
    return [
        quality.has_rows(f"{name}_has_rows", "fact_consumption"),
        quality.no_row_where(f"{name}_no_negative_kwh", "fact_consumption", F.col("kwh") < 0),
        quality.no_row_where(f"{name}_no_null_meter_id", "fact_consumption", F.col("meter_id").isNull()),
        quality.any_value(f"{name}_latest_timestamp_present", "fact_consumption", "reading_timestamp"),
        quality.no_orphans_of("fact_consumption", tables, [
            ForeignKey(f"{name}_no_missing_{d}_reference", "fact_consumption", f"{d}_id", f"{d}_id", f"dim_{d}", f"{d}_id") for d in ("region", "customer", "meter", "tariff", "date")]),
        *([quality.no_duplicates("fact_meter_reading_no_duplicate_reading_id", "fact_reading", tables["fact_reading"], ["reading_id"])] if "fact_reading" in tables else []),
        *([quality.Check("monitoring_pipeline_run_record_exists", "pipeline_run", recorded)] if "pipeline_run" in tables else []),
    ]


def run_batch(
    spark: SparkSession, bronze: str, root: str, batch_id: str, regions: Sequence[str] = schemas.REGIONS,
    as_of: str | None = None, gated: bool = True, facts: str | None = None, previous: Mapping[str, DataFrame] | None = None,
    log: str | None = None, pipeline: str = "batch_pipeline",
) -> Result:
    """Run all layers. ``bronze`` holds ``historical_consumption/``, ``weather/`` and three metadata CSVs.

    ``root`` is a new folder for this run. To add to an earlier run give its tables as ``previous``, so that dimension rows and
    surrogate keys live on, and one folder for all runs as ``facts``; the batch replaces itself there and nothing else.

    With a folder ``log`` the run records its start, its end with counts or its failure, and its check results there; each state has
    a folder of its own, so a run that is repeated replaces its records. Later runs and the monitoring views read them.
    """
    if log is None:
        return _run_layers(spark, bronze, root, batch_id, regions, as_of, gated, facts, previous)
    _record(runlog.run_started(spark, pipeline, batch_id, as_of), log, f"{batch_id}-running")
    try:
        result = _run_layers(spark, bronze, root, batch_id, regions, as_of, False, facts, previous, log, pipeline)
        write_batch(result.checks.drop("batch_id"), f"{log}/quality_check", batch_id)
        if gated:
            quality.gate(result.checks)
    except Exception as error:
        _record(runlog.run_failed(spark, pipeline, batch_id, str(error), as_of), log, f"{batch_id}-failed")
        raise
    counts = {"read": result.counts["staging/consumption"], "written": result.counts["warehouse/fact_consumption"], "rejected": result.counts["silver/rejected_records"]}
    _record(runlog.run_succeeded(spark, pipeline, batch_id, counts, as_of), log, f"{batch_id}-succeeded")
    states = spark.read.schema(_log_schema(spark)).parquet(f"{log}/pipeline_run")
    history = spark.read.schema(T.StructType([*result.checks.schema, T.StructField("batch_id", T.StringType())])).parquet(f"{log}/quality_check")
    return result._replace(log=runlog.current_runs(states.drop("state")), history=history)


def _log_schema(spark: SparkSession) -> T.StructType:
    return T.StructType([*runlog.run_started(spark, "", "").schema, T.StructField("state", T.StringType())])


def _record(state: DataFrame, log: str, name: str) -> None:
    write_batch(state, f"{log}/pipeline_run", name, "state")


def _run_layers(
    spark: SparkSession, bronze: str, root: str, batch_id: str, regions: Sequence[str], as_of: str | None, gated: bool,
    facts: str | None, previous: Mapping[str, DataFrame] | None, log: str | None = None, pipeline: str = "",
) -> Result:
    store = _Store(spark, root)
    silver = bronze_to_silver(spark, bronze.rstrip("/"), store, regions, as_of)
    gold = silver_to_gold(silver, store, as_of)
    warehouse = load_warehouse(silver, gold, store, batch_id, facts or store.path("warehouse/fact_consumption"), previous or {}, as_of)
    logged = {"pipeline_run": spark.read.schema(_log_schema(spark)).parquet(f"{log}/pipeline_run")} if log else {}
    checked = {**warehouse, **logged}
    checks = store.save("warehouse/quality_check", quality.run_checks(checked, warehouse_checks(checked, runlog.run_id(pipeline, batch_id)), batch_id, as_of))
    if gated:
        quality.gate(checks)
    return Result({**silver, **gold, **warehouse}, store.counts, checks)

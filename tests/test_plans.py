"""Plans are what they should be at scale: pruned, pushed down, combined before the shuffle, no row pairs."""

import pytest
from pyspark.sql import functions as F

from meterlake.operators import aggregates, joins, windows
from meterlake.plans import registry, tables, warehouse


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    yield
    spark.conf.unset(key)


def test_first_row_per_key_is_cut_before_the_shuffle(spark, sf_dir):
    text = plan(windows.latest_per_key(tables.readings(spark, sf_dir).select("meter_id", "event_timestamp", "event_id"), ["meter_id"], "event_timestamp", ["event_id"]))
    final, partial = text.index("WindowGroupLimit"), text.rindex("WindowGroupLimit")
    assert "Final" in text[final:final + 200] and "Partial" in text[partial:partial + 200]
    assert "Exchange hashpartitioning(meter_id" in text[final:partial]


def test_filter_on_the_key_goes_below_the_window(spark, sf_dir):
    latest = warehouse.view_latest_reading(tables.star(spark, sf_dir)).where(F.col("meter_id") == "MTR-000007")
    text = plan(latest)
    assert text.rindex("MTR-000007") > text.rindex("Window ")


def test_top_k_keeps_k_rows_per_task(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(warehouse.top_meters(tables.star(spark, sf_dir)))


def test_scans_read_only_what_is_used(spark, sf_dir):
    text = plan(aggregates.daily_region(tables.silver_readings(spark, sf_dir)))
    assert "FileScan parquet [ts#" in text and "props" not in text and "c_acctbal" not in text


def test_facts_are_summed_before_they_meet_dimensions(spark, sf_dir):
    fact = spark.range(10).selectExpr("id as date_id", "id as region_id", "cast(id as decimal(12,4)) as kwh", "cast(id as decimal(12,4)) as estimated_cost")
    text = plan(warehouse.daily_by_region({**tables.star(spark, sf_dir), "fact_consumption": fact}))
    assert text.rindex("partial_sum(kwh") > text.rindex("Join")


@pytest.mark.parametrize("name", ["range_join", "range_join_times", "running_sum", "event_numbers", "recent_avg_anomaly", "dim_history", "meter_slots", "kpis", "orphan_report", "audit_fk", "weather_features", "upsert_dim", "view_customer",
                                  "lookup_rejects", "anomaly_readings", "p_regions", "measure_anomaly_rate", "consumption_fact", "readings_fact"])
def test_no_row_pairs_even_without_broadcast(spark, sf_dir, no_broadcast, name):
    text = plan(registry.QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_orphans_use_key_joins(spark, sf_dir, no_broadcast):
    fact, dim = tables.fact_consumption(spark, sf_dir), tables.dim_customer(spark, sf_dir)
    text = plan(joins.orphans(fact, dim, "customer_id", "customer_id"))
    assert "LeftAnti" in text and "LeftSemi" in text and "NestedLoop" not in text


def test_references_meet_typed_in_one_aggregation(spark, sf_dir, no_broadcast):
    text = plan(registry.QUERIES["audit_fk"](spark, sf_dir))
    keys = text[: text.index("Generate")]  # above the facts' own columns
    assert "as string" not in keys and "SortMergeJoin" not in keys[keys.index("__known"):]


def test_large_sides_are_not_forced_into_a_broadcast():
    from pathlib import Path

    root = Path(registry.__file__).resolve().parents[1]
    code = "".join(p.read_text() for p in root.rglob("*.py") if p.relative_to(root).parts[0] != "llm")  # that package has its own test of what it broadcasts
    assert "broadcast(" not in code and "localCheckpoint" not in code and ".crossJoin(" not in code and "udf" not in code.lower()


def test_an_unset_filter_leaves_no_trace(spark, sf_dir):
    from meterlake.plans import serving

    views = {"daily_region": warehouse.view_daily_region(tables.star(spark, sf_dir))}
    assert "try_cast" not in plan(serving.daily(views)) and "ASIA" in plan(serving.daily(views, "ASIA"))


def test_a_date_filter_prunes_the_partitioned_fact(spark, sf_dir, tmp_path):
    from meterlake.plans import serving
    from meterlake.sources import sinks

    star = tables.star(spark, sf_dir)
    stored = dict(star)
    for name, parts in (("fact_consumption", ["date_id"]), ("dim_date", []), ("dim_region", [])):
        sinks.write_table(star[name], str(tmp_path / name), parts)
        stored[name] = spark.read.parquet(str(tmp_path / name))
    january = {"start_date": "1996-01-01", "end_date": "1996-01-31"}
    pruned = serving.daily({"daily_region": warehouse.view_daily_region(stored)}, "ASIA", **january)
    assert "dynamicpruning" in plan(pruned)
    assert pruned.collect() == serving.daily({"daily_region": warehouse.view_daily_region(star)}, "ASIA", **january).collect()


def test_no_plan_deals_rows_out_round_robin(spark, sf_dir):
    for name in ("p_daily", "clean_consumption", "star_daily", "clean_events", "quality_suite"):
        assert "RoundRobin" not in plan(registry.QUERIES[name](spark, sf_dir)), name


def test_payload_text_is_built_for_rejects_only(spark, sf_dir):
    text = plan(registry.QUERIES["clean_consumption"](spark, sf_dir))
    assert "tojson" not in text.replace("_", "").lower()
    text = plan(registry.QUERIES["rejected_consumption"](spark, sf_dir)).replace("_", "").lower()
    assert "tojson" in text[: text.index("exchange")] and "tojson" not in text[text.index("exchange") :]


def test_serving_filters_cut_the_fact_before_it_is_summed(spark, sf_dir):
    for name in ("p_daily", "p_monthly"):
        text = plan(registry.QUERIES[name](spark, sf_dir))
        assert text.rindex("LeftSemi") > text.rindex("partial_sum(kwh"), name  # further down the tree

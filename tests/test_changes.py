"""Merges by change set, loads of new batches only, joins on times, the gate's own-run check."""

from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meterlake.operators import dimensions, joins, quality
from meterlake.plans import batch, runlog, stream_load
from meterlake.sources import sinks
from meterlake.streaming.micro_batch import Sinks

ROW = "k string, v int, made string"


def table(spark, rows):
    return spark.createDataFrame(rows, ROW)


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


OLD = [("a", 1, "old"), ("b", 2, "old"), (None, 3, "old"), ("d", None, "old")]
NEW = [("a", 1, "new"), ("b", 5, "new"), (None, 4, "new"), ("d", None, "new"), ("e", 6, "new")]


# -- change sets ---------------------------------------------------------------------
def test_rows_are_inserts_updates_or_the_same(spark):
    found = dimensions.row_changes(table(spark, OLD), table(spark, NEW), ["k"], ["made"])
    assert {r["k"]: r["change"] for r in found.collect()} == {"a": "same", "b": "update", None: "update", "d": "same", "e": "insert"}


def test_a_repeated_source_key_is_an_error_or_resolved_by_an_order(spark):
    twice = table(spark, [("a", 7, "x"), ("a", 9, "y")])
    with pytest.raises(Exception, match="repeated source key: a"):
        dimensions.upsert(table(spark, OLD), twice, ["k"]).collect()
    with pytest.raises(Exception, match="repeated source key: NULL"):
        dimensions.upsert(table(spark, OLD), table(spark, [(None, 1, "x"), (None, 1, "x")]), ["k"]).collect()
    out = dimensions.upsert(table(spark, OLD), twice, ["k"], order_by=[F.desc("v")])
    assert [r for r in content(out) if r[0] == "a"] == [("a", 9, "y")] and out.count() == len(OLD)


def test_null_keys_are_not_appended_again(spark):
    once = dimensions.upsert(table(spark, OLD), table(spark, NEW), ["k"], ["made"])
    assert content(dimensions.upsert(once, table(spark, NEW), ["k"], ["made"])) == content(once)
    assert [r for r in content(once) if r[0] is None] == [(None, 4, "old")]


def test_only_touched_buckets_are_written(spark, tmp_path):
    path = str(tmp_path / "dim")
    rows = table(spark, [(f"k{i}", i, "old") for i in range(200)] + [(None, 0, "old")])
    sinks.replace_buckets(rows, path, ["k"], 32)
    before = set(Path(path).rglob("*.parquet"))
    changed = dimensions.row_changes(sinks.read_buckets(spark, path), table(spark, [("k7", 70, "new"), ("k8", 8, "new"), (None, 1, "new")]), ["k"], ["made"]).where("change != 'same'").drop("change")
    sinks.replace_buckets(changed, path, ["k"], 32)
    new = set(Path(path).rglob("*.parquet")) - before
    assert 1 <= len({p.parent for p in new}) <= 2
    want = {f"k{i}": i for i in range(200)} | {"k7": 70, None: 1}
    assert {r["k"]: r["v"] for r in sinks.read_buckets(spark, path).collect()} == want
    assert sinks.read_buckets(spark, path).count() == 201


def test_history_closes_and_opens(spark):
    start = table(spark, OLD).drop("made").withColumns({"valid_from": F.lit("2024-01-01").cast("timestamp"), "valid_to": F.lit(None).cast("timestamp")})
    source = table(spark, NEW).drop("made")
    once = dimensions.record_history(start, source, ["k"], "2024-02-01")
    got = sorted(((r["k"], r["v"], r["valid_from"].month, r["valid_to"] and r["valid_to"].month) for r in once.collect()), key=str)
    assert got == sorted([("a", 1, 1, None), ("b", 2, 1, 2), ("b", 5, 2, None), (None, 3, 1, 2), (None, 4, 2, None), ("d", None, 1, None), ("e", 6, 2, None)], key=str)
    assert content(dimensions.record_history(once, source, ["k"], "2024-03-01")) == content(once)


def test_missing_keys_are_looked_for_within_touched_days(spark):
    target = spark.createDataFrame([(1, "x"), (2, "y")], "id int, day string")
    source = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x")], "id int, day string")
    assert content(joins.insert_missing(target, source, ["id"])) == [(1, "x"), (2, "y"), (3, "x")]
    assert content(joins.insert_missing(target, source, ["id", "day"], within="day")) == [(1, "x"), (2, "x"), (2, "y"), (3, "x")]


# -- loads of new batches ------------------------------------------------------------------
EVENT = "event_id string, meter_id string, customer_id string, region_name string, event_timestamp timestamp, kwh double, voltage double, event_type string, source_system string, record_hash string"
FOUND = "anomaly_id string, event_id string, meter_id string, customer_id string, region_name string, event_timestamp timestamp, anomaly_type string, anomaly_score double, kwh double, expected_kwh double, detected_at timestamp, source_system string"


def silver(spark, out, number, events, metrics=True):
    at = lambda day: datetime(2024, 1, day, 12)
    sinks.write_batch(spark.createDataFrame([(e, "m", "c", "A", at(d), 1.0, 230.0, "reading", "s", e) for e, d in events], EVENT), out.clean, number)
    sinks.write_batch(spark.createDataFrame([(f"x{e}", e, "m", "c", "A", at(d), "t", 0.9, 1.0, None, at(d), "s") for e, d in events], FOUND), out.anomalies, number)
    if metrics:
        sinks.write_batch(spark.createDataFrame([(len(events),)], "total_events bigint"), out.metrics, number)


def test_a_load_opens_new_batches_only(spark, tmp_path):
    out, regions = Sinks.under(str(tmp_path / "silver")), spark.createDataFrame([("A", 1)], "region_name string, region_id int")
    places = [str(tmp_path / x) for x in ("readings", "anomalies", "processed")]

    def load(name):
        loaded = stream_load.load_new(spark, out, regions, *places, name)
        return None if loaded is None else sorted((r["reading_id"], r["load_id"]) for r in loaded.readings.collect())

    silver(spark, out, 0, [("e1", 1), ("e2", 2)])
    silver(spark, out, 1, [("e2", 2), ("e3", 9)], metrics=False)  # not complete yet
    assert load("one") == [("e1", "one"), ("e2", "one")]
    silver(spark, out, 1, [("e2", 2), ("e3", 9)])
    silver(spark, out, 2, [("e4", 9)])
    for file in [*Path(out.clean, "batch_id=0").glob("*.parquet"), *Path(out.anomalies, "batch_id=0").glob("*.parquet"), *Path(places[0], "load_id=one", "date_id=20240101").glob("*.parquet")]:
        file.write_bytes(b"no one should open this")
    loaded = stream_load.load_new(spark, out, regions, *places, "two")
    assert sorted(r["reading_id"] for r in loaded.readings.where("load_id = 'two'").collect()) == ["e3", "e4"]
    assert load("three") is None
    again = stream_load.load_new(spark, out, regions, *places, "two")  # run again: the same batches, the same rows
    assert sorted(r["reading_id"] for r in again.readings.where("load_id = 'two'").collect()) == ["e3", "e4"]


# -- joins on times ---------------------------------------------------------------------------
def test_intervals_meet_times_as_by_brute_force(spark):
    at = datetime(2024, 1, 1)
    points = [(i, "ab"[i % 2], at + timedelta(seconds=i * i * 37 % 90_000, microseconds=i % 3)) for i in range(300)] + [(300, "a", None), (301, None, at), (302, "a", datetime(1931, 5, 1))]
    intervals = [(i, "ab"[i % 2], at + timedelta(seconds=i * 701 % 80_000), at + timedelta(seconds=i * 701 % 80_000 + [0, 1, 59, 3_600, 86_400, -5][i % 6])) for i in range(60)]
    intervals += [(90, "a", at, None), (91, "b", None, at), (92, "a", datetime(1, 1, 1), datetime(9999, 12, 31)), (93, "a", at, at), (94, None, at, None)]
    left = spark.createDataFrame(intervals, "i int, g string, low timestamp, high timestamp")
    right = spark.createDataFrame(points, "p int, g string, at timestamp")
    want = sorted((i, p) for i, g, low, high in intervals for p, h, t in points if g is not None and g == h and t and low and low <= t and (high is None or t <= high))
    for fineness in (0, 3, 6):
        got = joins.range_join_times(left, right, "at", "low", "high", ["g"], fineness)
        assert sorted((r["i"], r["p"]) for r in got.select("i", "p").collect()) == want and set(got.columns) == {"g", "i", "low", "high", "p", "at"}


def test_centuries_make_few_rows(spark):
    left = spark.createDataFrame([(1, date(1, 1, 1), date(9999, 12, 31)), (2, date(1990, 1, 1), None)], "i int, low date, high date")
    seen = joins.range_join_times(left, spark.createDataFrame([(date(2024, 1, 1),)], "day date"), "day", "low", "high")
    assert seen.count() == 2
    plan = seen._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" in plan
    length = (date(9999, 12, 31) - date(1, 1, 1)).days * 86_400_000_000
    assert (length >> (length.bit_length() - 3)) + 2 < 100


def test_a_time_becomes_text_once_for_each_reading_not_for_each_pair(spark, tmp_path):
    from meterlake.plans import registry

    at = datetime(2024, 1, 1)
    events = [(i, at + timedelta(seconds=i * 37 % 7_200) if i % 19 else None, i % 4, "signup" if i % 3 == 0 else "view", 1.0, None) for i in range(120)]
    tables = {
        "events": spark.createDataFrame(events, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string").withColumn("ts", F.col("ts").cast("timestamp_ntz")),
        "customer": spark.createDataFrame([(k, f"c{k}", k % 2, 1.0, "BUILDING") for k in range(3)], "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "nation": spark.createDataFrame([(0, "N", 0), (1, "M", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": spark.createDataFrame([(0, "ASIA"), (1, "EUROPE")], "r_regionkey int, r_name string"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    seen = registry.QUERIES["range_join_times"](spark, str(tmp_path))
    known = [e for e in events if e[1] and e[2] < 3]
    want = [(f"evt_{h[0]:08}", f"evt_{r[0]:08}", f"{r[1]:%Y-%m-%d %H:%M:%S}") for h in known for r in known
            if h[3] == "signup" and r[3] != "signup" and h[2] % 2 == r[2] % 2 and h[1] <= r[1] <= h[1] + timedelta(minutes=h[0] % 7 * 10)]
    assert sorted(map(tuple, seen.select("heartbeat_id", "event_id", "event_timestamp").collect())) == sorted(want) and len(want) > 100
    above, below = seen._jdf.queryExecution().optimizedPlan().toString().split("Join ", 1)
    assert "date_format" in below and "date_format" not in above


def test_rows_of_a_time_join_are_sorted_by_block_first(spark):
    """Nearly all rows differ in the block, a number; sorted by the keys first they would be told apart by a whole comparison each."""
    left = spark.createDataFrame([(1, "a", datetime(2024, 1, 1), datetime(2024, 1, 2))], "i int, g string, low timestamp, high timestamp")
    seen = joins.range_join_times(left.hint("merge"), spark.createDataFrame([("a", datetime(2024, 1, 1))], "g string, at timestamp"), "at", "low", "high", ["g"])
    assert seen.count() == 1 and seen.columns == ["g", "i", "low", "high", "at"]
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [__block" in plan


# -- own-run check -------------------------------------------------------------------------------
def test_the_gate_wants_the_record_of_its_own_run(spark):
    fact = spark.createDataFrame([(1.0, "m", datetime(2024, 1, 1), 1, "c", "t", 1)], "kwh double, meter_id string, reading_timestamp timestamp, region_id int, customer_id string, tariff_id string, date_id int")
    dims = {f"dim_{d}": fact.select(f"{d}_id") for d in ("region", "customer", "meter", "tariff", "date")}

    def status(run):
        log = spark.range(1).select(runlog.run_id("p", "other").alias("pipeline_run_id"))
        tables = {"fact_consumption": fact, **dims, "pipeline_run": log}
        checks = quality.run_checks(tables, batch.warehouse_checks(tables, runlog.run_id("p", run)), run).collect()
        return {r["check_name"]: r["status"] for r in checks}["monitoring_pipeline_run_record_exists"]

    assert status("other") == "passed" and status("mine") == "failed"

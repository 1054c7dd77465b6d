"""Stream tables that do not grow with history: mergeable hours, versions, compacted days, latest rows with expiry."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meterlake.operators.aggregates import hourly_region
from meterlake.sources import sinks, versions
from meterlake.streaming import partials, stateful

AT = datetime(2024, 1, 5, 10, 0)
CLEAN = "event_id string, meter_id string, region_name string, event_timestamp timestamp, kwh double, event_type string, record_hash string"


def events(spark, rows):
    """(event, meter, region, minutes, kwh[, type])"""
    return spark.createDataFrame([(e, m, r, AT + timedelta(minutes=t), k, *(more or ["reading"]), e) for e, m, r, t, k, *more in rows], CLEAN)


def plain(rows):
    return sorted(tuple(r)[:6] for r in rows.select("window_start", "window_end", "region_name", "total_kwh", "event_count", "unique_meter_count").collect())


BATCHES = [
    [("e1", "m1", "A", 0, 1.0), ("e2", "m2", "A", 5, 2.0), ("e3", "m1", "B", 70, 0.5), ("e4", "m9", "A", 6, 4.0), ("e5", "m1", "A", 1, 9.0, "heartbeat")],
    [("e1", "m1", "A", 0, 1.0), ("e6", "m1", "A", 30, 1.5), ("e7", "m3", "A", 31, 0.25), ("e8", "m9", "A", 32, 1.0), ("e9", None, "A", 33, 1.0)],
    [("e7", "m3", "A", 31, 0.25), ("e6", "m1", "A", 30, 1.5), ("e10", "m40000", "B", 75, 3.0)],
]


@pytest.fixture()
def numbers(spark):
    return spark.createDataFrame([("m1", 1), ("m2", 2), ("m3", 32_768), ("m40000", 40_000)], "meter_id string, meter_number int")  # m9 has none


def test_parts_of_batches_merge_exactly(spark, tmp_path, numbers):
    where = partials.HourParts.under(str(tmp_path))
    for n, rows in enumerate(BATCHES):
        partials.add_hours(events(spark, rows), n, where, numbers)
    once = events(spark, [r for rows in BATCHES for r in rows]).dropDuplicates(["event_id"])
    assert plain(partials.merged_hours(spark, where)) == plain(hourly_region(once))
    partials.add_hours(events(spark, BATCHES[1]), 1, where, numbers)  # a retry makes the same part
    assert plain(partials.merged_hours(spark, where)) == plain(hourly_region(once))


def test_a_batch_of_hours_is_worked_out_once(spark, tmp_path):
    """Days, ids and parts come from one pass over the batch, not from one each."""
    passes = spark.sparkContext.accumulator(0)

    def counted(value):
        passes.add(1)
        return value

    numbers = partials.meter_numbers(spark.createDataFrame([("m1",), ("m2",)], "meter_id string"))
    where = partials.HourParts.under(str(tmp_path))
    for n, rows in enumerate(BATCHES[:2]):
        before = passes.value
        batch = events(spark, rows)
        partials.add_hours(batch.withColumn("event_id", F.udf(counted, "string")("event_id")), n, where, numbers)
        assert passes.value - before == len(rows)


def test_merged_hours_read_the_parts_only(spark, tmp_path, numbers):
    where = partials.HourParts.under(str(tmp_path))
    partials.add_hours(events(spark, BATCHES[0]), 0, where, numbers)
    assert {Path(f).parts[-3] for f in partials.merged_hours(spark, where).inputFiles()} == {"parts"}


def test_new_meters_keep_old_numbers(spark):
    first = partials.meter_numbers(spark.createDataFrame([("b",), ("a",)], "meter_id string"))
    second = partials.meter_numbers(spark.createDataFrame([("c",), ("aa",), ("a",)], "meter_id string"), first)
    assert {r["meter_id"]: r["meter_number"] for r in second.collect()} == {"a": 1, "b": 2, "aa": 3, "c": 4}


# -- versions ------------------------------------------------------------------------
@pytest.fixture()
def table(spark):
    name = f"versioned_{datetime.now():%H%M%S%f}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_reader_during_an_overwrite_keeps_its_version(spark, tmp_path, table):
    versions.publish(spark.range(10).withColumn("day", F.lit("x")), table, str(tmp_path), ["day"])
    reading = spark.table(table)
    assert reading.count() == 10
    versions.publish(spark.range(3).withColumn("day", F.lit("y")), table, str(tmp_path), ["day"])
    assert reading.count() == 10 and spark.table(table).count() == 3
    assert [r["day"] for r in spark.table(table).select("day").distinct().collect()] == ["y"]
    assert len(versions.remove_versions(spark, table, str(tmp_path))) == 1
    assert spark.table(table).count() == 3 and len(list(tmp_path.iterdir())) == 1


def test_a_writer_that_dies_changes_nothing(spark, tmp_path, table):
    versions.publish(spark.range(10), table, str(tmp_path))
    broken = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        versions.publish(broken, table, str(tmp_path))
    assert spark.table(table).count() == 10
    with pytest.raises(ValueError, match="columns"):
        versions.publish(spark.range(3).withColumnRenamed("id", "other"), table, str(tmp_path))
    assert spark.table(table).count() == 10


# -- day tables -------------------------------------------------------------------------
DAYS = "id bigint, day date, batch_id string"


def day_rows(spark, ids, days=3):
    return spark.createDataFrame([(i,) for i in ids], "id bigint").withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % days).cast("int")))


def content(spark, path):
    return sorted(map(tuple, versions.read_days(spark, path, DAYS).select("id", F.col("day").cast("string"), "batch_id").collect()))


def files(path, day):
    return len(list(Path(path, f"day={day}").glob("*.parquet")))


def test_compaction_changes_no_row_and_leaves_open_days(spark, tmp_path):
    path = str(tmp_path / "days")
    for n in range(4):
        versions.append_batch(day_rows(spark, range(n * 30, n * 30 + 30)), path, n, "day")
    before, open_day = content(spark, path), files(path, "2024-01-03")
    done = versions.compact(spark, path, DAYS, "day", "2024-01-03")
    assert content(spark, path) == before and len(before) == 120
    assert sorted(str(r["day"]) for r in done.collect()) == ["2024-01-01", "2024-01-02"]
    assert files(path, "2024-01-01") == files(path, "2024-01-02") == 1 and files(path, "2024-01-03") == open_day > 1
    assert versions.compact(spark, path, DAYS, "day", "2024-01-03").isEmpty()


def test_a_batch_delivered_again_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "days")
    versions.append_batch(day_rows(spark, range(9)), path, "a", "day")
    versions.append_batch(day_rows(spark, [2, 5], days=3), path, "b", "day")
    versions.append_batch(day_rows(spark, [100], days=1), path, "b", "day")  # other rows on another day
    assert [r for r in content(spark, path) if r[2] == "b"] == [(100, "2024-01-01", "b")]
    assert len([r for r in content(spark, path) if r[2] == "a"]) == 9
    versions.append_batch(day_rows(spark, []), path, "a", "day")
    assert content(spark, path) == [(100, "2024-01-01", "b")]


# -- latest with expiry --------------------------------------------------------------------
READINGS = "meter_id string, event_id string, event_timestamp timestamp, event_type string, kwh double"


def land(spark, folder, rows):
    spark.createDataFrame([(m, e, AT + timedelta(minutes=t), "reading", k) for m, e, t, k in rows], READINGS).coalesce(1).write.mode("append").parquet(folder)


def test_latest_rows_expire_and_only_touched_buckets_are_written(spark, tmp_path):
    landing, path, check = (str(tmp_path / x) for x in ("landing", "latest", "check"))

    def trigger():
        stateful.keep_latest(spark.readStream.schema(READINGS).parquet(landing), path, check, "10 minutes", 3_600, buckets=16)
        return {r["meter_id"]: r["event_id"] for r in sinks.read_buckets(spark, path).collect()}

    land(spark, landing, [(f"m{i}", f"e{i}", i % 3, 1.0) for i in range(12)] + [("m0", "e0b", 2, 1.0)])
    assert trigger() == {f"m{i}": f"e{i}" for i in range(1, 12)} | {"m0": "e0b"}
    stamps = {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    land(spark, landing, [("m3", "e3b", 40, 1.0), ("m4", "late", 0, 1.0)])  # m4's is older than what it has
    latest = trigger()
    assert latest["m3"] == "e3b" and latest["m4"] == "e4"
    now = set(Path(path).rglob("*.parquet"))
    touched = {p.parent for p in now - set(stamps)}
    assert len(touched) == 1 and all(p in now and p.stat().st_mtime_ns == t for p, t in stamps.items() if p.parent not in touched)
    land(spark, landing, [("m5", "e5b", 100, 1.0)])  # the watermark passes an hour after all but m3 and m5
    assert trigger() == {"m3": "e3b", "m5": "e5b"}
    land(spark, landing, [("m1", "back", 101, 1.0)])
    assert trigger() == {"m1": "back", "m3": "e3b", "m5": "e5b"}


def test_an_idle_meter_leaves_the_state(spark, tmp_path):
    landing, path, check = (str(tmp_path / x) for x in ("landing", "latest", "check"))
    for rows in ([("m1", "a", 0, 1.0), ("m2", "b", 0, 1.0)], [("m2", "c", 200, 1.0)], [("m2", "d", 400, 1.0)]):
        land(spark, landing, rows)
        stateful.keep_latest(spark.readStream.schema(READINGS).parquet(landing), path, check, "1 minute", 3_600, buckets=4)
    assert {r["meter_id"] for r in sinks.read_buckets(spark, path).collect()} == {"m2"}
    kept = spark.read.format("statestore").option("path", check).option("stateVarName", "latest").load()
    assert [r["key"]["meter_id"] for r in kept.collect()] == ["m2"]


@pytest.mark.parametrize("name", ["stream_hourly_merged", "stream_fact_incremental"])
def test_landed_events_are_written_by_many_tasks(spark, tmp_path, monkeypatch, name):
    from meterlake.plans import registry

    class Landed(Exception):
        pass

    def write_events(rows, path):
        assert rows.rdd.getNumPartitions() >= 16
        raise Landed

    monkeypatch.setattr(registry.sinks, "write_events", write_events)
    monkeypatch.setattr(registry.tables, "event_payloads", lambda s, d: s.createDataFrame([(str(i),) for i in range(99)], "raw_event_payload string"))
    monkeypatch.setattr(registry.tables, "dim_meter", lambda s, d: s.createDataFrame([("m1",)], "meter_id string"))
    monkeypatch.setattr(registry.tables, "dim_region", lambda s, d: s.createDataFrame([("ASIA",)], "region_name string"))
    with pytest.raises(Landed):
        registry.QUERIES[name](spark, str(tmp_path))

"""Streams over files: restart, replay, repeats, late rows, and equality with the batch operators."""

import time
import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meterlake import schemas
from meterlake.operators import aggregates
from meterlake.sources import readers, sinks
from meterlake.streaming import micro_batch, stateful

AS_OF = "2026-02-01 00:00:00"
START = datetime(2026, 1, 14)


def event(n, minute=None, **changes):
    base = dict(event_id=f"e{n:04d}", meter_id=f"MTR-{n % 7}", customer_id=f"C-{n % 7}", region_name=schemas.REGIONS[n % 5],
                event_timestamp=(START + timedelta(minutes=n * 5 if minute is None else minute)).isoformat() + "Z", kwh=(n % 13) + 0.25, voltage=230.0,
                event_type=("reading", "reading", "anomaly", "heartbeat")[n % 4], source_system="meters",
                producer_timestamp=START.isoformat() + "Z")
    return json.dumps({**base, **changes})


def land(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def table(spark, path):
    return micro_batch.read_batches(spark, path)


@pytest.fixture
def medallion(spark, tmp_path):
    out = micro_batch.Sinks.under(str(tmp_path / "lake"))

    def run(**options):
        stream = readers.event_stream(spark, "json_landing", str(tmp_path / "landing"), as_of=AS_OF, **options)
        return micro_batch.run_medallion(stream, out, str(tmp_path / "checkpoint"), as_of=AS_OF)

    return out, tmp_path / "landing", run


def test_restart_reads_only_new_files(spark, medallion):
    out, landing, run = medallion
    land(landing, "1.json", [event(n) for n in range(40)] + ["{broken", event(1)])
    run()
    land(landing, "2.json", [event(n) for n in range(40, 60)] + [event(60, region_name="Mars")])
    run()
    run()
    metrics = {r["batch_id"]: (r["total_events"], r["valid_events"], r["rejected_events"]) for r in table(spark, out.metrics).collect()}
    assert metrics == {0: (42, 40, 2), 1: (21, 20, 1)}
    assert table(spark, out.clean).count() == 60
    assert {r["rejection_reason"].split(";")[0] for r in table(spark, out.rejected).collect()} == {
        "Malformed JSON", "Duplicate event_id in micro-batch", "Invalid region_name"}


def test_one_file_per_batch_equals_batch_result(spark, medallion):
    out, landing, run = medallion
    for part in range(4):  # event 3 comes again in every file
        land(landing, f"{part}.json", [event(n) for n in range(part * 25, part * 25 + 25)] + ([event(3)] if part else []))
    run(max_files=1)
    clean = table(spark, out.clean)
    assert clean.select("batch_id").distinct().count() == 4
    assert clean.count() == 103  # copies in other batches pass the in-batch rule ...
    unique = micro_batch.unique_events(clean)
    assert unique.count() == 100  # ... and are dropped by the finaliser, which keeps the first
    assert unique.where("event_id = 'e0003'").first()["batch_id"] == 0

    hourly = micro_batch.merge_hourly(clean, AS_OF).collect()
    everything = spark.createDataFrame([(event(n),) for n in range(100)], "raw_event_payload string").select(
        "raw_event_payload", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.ENVELOPE.fields[1:]])
    direct = aggregates.hourly_region(stateful.typed_event_stream(everything), as_of=AS_OF).collect()
    assert sorted(map(str, hourly)) == sorted(map(str, direct))
    latest = {r["meter_id"]: r["event_id"] for r in micro_batch.merge_latest(table(spark, out.latest)).collect()}
    assert latest == {f"MTR-{m}": max(f"e{n:04d}" for n in range(100) if n % 7 == m and n % 4 != 3) for m in range(7)}
    flagged = {f"anom_e{n:04d}" for n in range(100) if n % 4 == 2 or n % 13 + 0.25 > 10}
    assert {r["anomaly_id"] for r in table(spark, out.anomalies).collect()} == flagged


def test_replayed_batch_leaves_one_copy(spark, medallion, tmp_path):
    out, _, _ = medallion
    batch = spark.createDataFrame([(event(n),) for n in range(10)], "raw_event_payload string").select(
        "raw_event_payload", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.ENVELOPE.fields[1:]])
    micro_batch.process_batch(batch, 5, out, as_of=AS_OF)
    micro_batch.process_batch(batch.limit(4), 6, out, as_of=AS_OF)
    micro_batch.process_batch(batch.where("false"), 7, out, as_of=AS_OF)  # writes nothing
    before = {name: sorted(map(str, table(spark, path).collect())) for name, path in out._asdict().items()}
    micro_batch.process_batch(batch, 5, out, as_of=AS_OF)
    assert {name: sorted(map(str, table(spark, path).collect())) for name, path in out._asdict().items()} == before
    assert sorted(r["batch_id"] for r in table(spark, out.metrics).collect()) == [5, 6]


def test_capture_then_bronze_source(spark, tmp_path):
    land(tmp_path / "in", "a.json", [event(n) for n in range(20)])
    bronze, mark = str(tmp_path / "bronze"), str(tmp_path / "mark")
    for _ in range(2):  # a second run finds nothing new
        sinks.capture_bronze(readers.text_event_stream(spark, str(tmp_path / "in")), bronze, mark).awaitTermination()
    captured = spark.read.schema(schemas.ENVELOPE).parquet(bronze)
    assert captured.count() == 20
    assert captured.where(F.col("producer_metadata").endswith("a.json")).count() == 20
    out = micro_batch.Sinks.under(str(tmp_path / "lake"))
    micro_batch.run_medallion(readers.event_stream(spark, "bronze_parquet", bronze), out, str(tmp_path / "mark2"))
    assert table(spark, out.clean).count() == 20


def stream_of(spark, folder):
    return stateful.typed_event_stream(readers.text_event_stream(spark, str(folder), max_files=1))


def test_repeats_in_later_batches_are_dropped_by_state(spark, tmp_path):
    land(tmp_path / "in", "1.json", [event(n) for n in range(10)])
    land(tmp_path / "in", "2.json", [event(n) for n in range(5, 15)])
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    unique = stateful.dedup_events(stream_of(spark, tmp_path / "in"), "2 hours")
    stateful.to_table(unique, out, mark)
    land(tmp_path / "in", "3.json", [event(n) for n in range(12, 18)])
    stateful.to_table(stateful.dedup_events(stream_of(spark, tmp_path / "in"), "2 hours"), out, mark)  # state survives the restart
    assert sorted(r["event_id"] for r in spark.read.parquet(out).collect()) == [f"e{n:04d}" for n in range(18)]


def test_closed_hours_count_distinct_meters_and_drop_late_rows(spark, tmp_path):
    land(tmp_path / "in", "1.json", [event(0, m, meter_id=f"M{m % 3}", region_name="North London", event_type="reading", kwh=1.0) for m in range(0, 60, 5)])
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")

    def run():
        late = stateful.LateRows()
        spark.streams.addListener(late)
        query = stateful.to_table(stateful.hourly_stream(stream_of(spark, tmp_path / "in"), "1 hour"), out, mark)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        time.sleep(1)
        spark.streams.removeListener(late)
        return late.dropped[str(query.id)]

    run()
    land(tmp_path / "in", "2.json", [event(1, 60 * 10, event_type="reading")])  # moves the watermark to hour 9
    run()
    hours = spark.read.parquet(out)
    row = hours.where("region_name = 'North London'").first()
    assert (row["total_kwh"], row["event_count"], row["unique_meter_count"]) == (12.0, 12, 3)
    land(tmp_path / "in", "3.json", [event(2, 30, event_type="reading")])
    assert run() == 1
    assert hours.count() == spark.read.parquet(out).count()


def test_late_rows_of_silver(spark):
    rows = [(0, START), (0, START + timedelta(hours=5)), (1, START + timedelta(hours=1)), (1, START + timedelta(hours=4)), (2, START + timedelta(hours=9))]
    silver = spark.createDataFrame(rows, "batch_id bigint, event_timestamp timestamp")
    late = micro_batch.late_rows(silver, "2 HOURS").collect()
    assert [(r["batch_id"], r["event_timestamp"]) for r in late] == [(1, START + timedelta(hours=1))]


def test_running_query_stops_after_its_duration(spark, tmp_path):
    land(tmp_path / "in", "1.json", [event(1)])
    seen = []
    query = micro_batch.run_stream(readers.text_event_stream(spark, str(tmp_path / "in")), lambda df, n: seen.append(df.count()),
                                   str(tmp_path / "mark"), trigger={"processingTime": "1 second"}, duration=8)
    assert not query.isActive and sum(seen) == 1


def test_latest_state_equals_batch(spark, tmp_path):
    land(tmp_path / "in", "1.json", [event(n) for n in range(30)])
    land(tmp_path / "in", "2.json", [event(n) for n in range(30, 50)])
    latest = stateful.latest_stream(stream_of(spark, tmp_path / "in"))
    query = latest.writeStream.outputMode("complete").format("memory").queryName("latest").option(
        "checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = {r["meter_id"]: r["event_id"] for r in spark.table("latest").collect()}
    assert got == {f"MTR-{m}": max(f"e{n:04d}" for n in range(50) if n % 7 == m and n % 4 != 3) for m in range(7)}


def test_a_batch_that_failed_half_way_is_invisible(spark, tmp_path):
    sinks = micro_batch.Sinks.under(str(tmp_path))
    batch = spark.createDataFrame([(event(n), START, "s", None, None, None) for n in range(3)], schemas.ENVELOPE)
    micro_batch.process_batch(batch, 0, sinks, schemas.REGIONS)
    micro_batch.write_batch(micro_batch.read_batches(spark, sinks.clean).drop("batch_id"), sinks.clean, 1)  # no metrics follow
    assert micro_batch.read_batches(spark, sinks.clean).count() == 6
    assert micro_batch.read_batches(spark, sinks.clean, sinks.metrics).count() == 3


def test_absurd_values_become_rejects(spark, tmp_path):
    sinks = micro_batch.Sinks.under(str(tmp_path))
    batch = spark.createDataFrame([(event(n, kwh=k), START, "s", None, None, None) for n, k in enumerate([1.0, 1e300, 1e12, 99_999_999.5])], schemas.ENVELOPE)
    micro_batch.process_batch(batch, 0, sinks, schemas.REGIONS)
    assert micro_batch.read_batches(spark, sinks.clean).count() == 2 and micro_batch.read_batches(spark, sinks.rejected).count() == 2


def test_only_what_the_tables_need_is_dealt_out_and_kept(spark):
    """The ranking of repeats carries the raw text and the id, no parsed field and no metadata; a valid row's text is not cached."""
    lines = [event(1), event(1), event(2, kwh=-1), "{broken"]
    envelope = spark.createDataFrame([(line, "folder/file", AS_OF) for line in lines], "raw_event_payload string, producer_metadata string, at string").selectExpr(
        "raw_event_payload", "timestamp(at) AS ingestion_timestamp", "'landing' AS source_system", "'0' AS partition_id", "'7' AS offset", "producer_metadata")
    validated = micro_batch._needed(micro_batch.validate_events(envelope))
    below = validated._jdf.queryExecution().optimizedPlan().toString().split("Window [")[-1]
    assert "kwh" not in below and "producer_metadata AS" not in below
    rows = {(r["event_id"], r["rejection_reason"]): r["raw_event_payload"] for r in validated.collect()}
    assert rows == {("e0001", ""): None, ("e0001", "Duplicate event_id in micro-batch"): lines[0], ("e0002", "Negative kwh"): lines[2], (None, next(k for i, k in rows if i is None)): lines[3]}
    whole = micro_batch.validate_events(envelope)
    assert {(r["producer_metadata"], r["partition_id"], r["offset"], r["bronze_source_system"]) for r in whole.collect()} == {("folder/file", "0", "7", "landing")}


def test_an_event_is_parsed_once(spark):
    """filters on parsed fields do not parse the text again for each field they use."""
    lines = [event(1), event(2, kwh=-1), event(3, event_timestamp="never"), "{broken", None]
    envelopes = spark.createDataFrame([(line, START, "landing", None, None, None) for line in lines], schemas.ENVELOPE)
    typed = stateful.typed_event_stream(envelopes).where(F.col("event_timestamp").isNotNull() & (F.col("kwh") >= 0) & (F.col("event_type") != "heartbeat"))
    valid, invalid = stateful.valid_event_stream(envelopes), stateful.invalid_event_stream(envelopes, as_of=AS_OF)
    for frame in (typed, valid, invalid):
        assert frame._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert [r["event_id"] for r in typed.collect()] == [r["event_id"] for r in valid.collect()] == ["e0001"]
    assert {(r["raw_event_payload"], r["source_system"]) for r in invalid.collect()} == {(lines[1], "meters"), (lines[2], "meters"), (lines[3], "landing"), (None, "landing")}
    assert valid.columns == typed.columns and valid.columns[-1] == "ingestion_timestamp"

"""Star schema, quality and bookkeeping on the seed of ten meters over fourteen days."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from meterlake import schemas
from meterlake.operators import aggregates, dimensions, joins, quality
from meterlake.plans import runlog, serving, warehouse

AS_OF = "2026-01-15 00:00:00"
DAYS = [date(2026, 1, 1) + timedelta(days=i) for i in range(14)]


@pytest.fixture(scope="module")
def seed(spark):
    segments = ["Residential", "Residential", "Small Business", "Public Sector", "Residential"]
    regions = spark.createDataFrame([(i + 1, r, "UK", r[0]) for i, r in enumerate(schemas.REGIONS)], "region_id int, region_name string, country string, postcode_area string")
    customers = spark.createDataFrame([(f"C{i}", segments[i % 5], i % 4 + 1, i % 5 + 1, i != 4) for i in range(10)],
                                      "customer_id string, customer_segment string, household_size int, region_id int, is_active boolean")
    meters = spark.createDataFrame([(f"M{i}", f"C{i}", i % 5 + 1, True) for i in range(10)], "meter_id string, customer_id string, region_id int, is_active boolean")
    tariffs = spark.createDataFrame([(t, n, Decimal(p), Decimal(s)) for t, n, p, s in schemas.TARIFFS],
                                    "tariff_id string, tariff_name string, price_per_kwh decimal(10,4), standing_charge_daily decimal(10,4)")
    daily = spark.createDataFrame([(d, f"C{i}", f"M{i}", schemas.REGIONS[i % 5], Decimal(i + d.day)) for i in range(10) for d in DAYS],
                                  "reading_date date, customer_id string, meter_id string, region_name string, total_kwh decimal(18,4)")
    fact = dimensions.build_consumption_fact(daily, customers, regions, tariffs, "seed")
    readings = spark.createDataFrame(
        [(f"R{i}-{s}", f"M{i}", f"C{i}", i % 5 + 1, 20260114, datetime(2026, 1, 14, s * 4), Decimal(i + s), Decimal("230.000"), "seed", f"R{i}-{s}")
         for i in range(10) for s in range(6)],
        "reading_id string, meter_id string, customer_id string, region_id int, date_id int, event_timestamp timestamp, kwh decimal(12,4), voltage decimal(10,3), source_system string, event_id string")
    anomalies = readings.where("kwh > 12").select(
        F.concat(F.lit("A"), "reading_id").alias("anomaly_id"), "reading_id", "meter_id", "region_id", "date_id", F.lit("spike").alias("anomaly_type"),
        F.lit(0.9).cast("decimal(12,4)").alias("anomaly_score"), "kwh", F.lit(4).cast("decimal(12,4)").alias("expected_kwh"), F.col("event_timestamp").alias("detected_at"), "source_system")
    runs = spark.createDataFrame(
        [("P1", "load", "batch", "succeeded", datetime(2026, 1, 14, 1), datetime(2026, 1, 14, 1, 4), 143, 140, 3, None),
         ("P2", "stream", "streaming", "running", datetime(2026, 1, 14, 23), None, 62, 60, 2, None),
         ("P3", "checks", "quality", "failed", datetime(2026, 1, 14, 2), datetime(2026, 1, 14, 2, 1), 12, 11, 1, "review")],
        "pipeline_run_id string, pipeline_name string, pipeline_type string, status string, started_at timestamp, finished_at timestamp, "
        "records_read int, records_written int, records_rejected int, error_message string")
    checks = spark.createDataFrame([("Q1", "P3", "a", "t", "passed", 0, datetime(2026, 1, 14)), ("Q2", "P3", "b", "t", "failed", 4, datetime(2026, 1, 14))],
                                   "check_id string, pipeline_run_id string, check_name string, table_name string, status string, failed_count int, checked_at timestamp")
    return {"dim_region": regions, "dim_customer": customers, "dim_meter": meters, "dim_tariff": tariffs, "dim_date": dimensions.dim_date(daily, "reading_date"),
            "fact_consumption": fact.withColumn("consumption_id", F.monotonically_increasing_id()), "fact_reading": readings, "fact_anomaly": anomalies,
            "pipeline_run": runs, "quality_check": checks}


def test_seed_counts(seed):
    counts = {r["table_name"]: r["row_count"] for r in aggregates.table_counts(seed).collect()}
    assert (counts["fact_consumption"], counts["fact_reading"], counts["fact_anomaly"], counts["dim_date"]) == (140, 60, 3, 14)


def test_views_meet_their_contracts(seed):
    views = warehouse.serving_views(seed, AS_OF)
    assert set(views) == set(schemas.VIEW_CONTRACTS) - {"freshness"}
    for name, df in views.items():
        assert {r["failed_count"] for r in quality.audit_contract(df, schemas.VIEW_CONTRACTS[name]).collect()} == {0}, name
    with pytest.raises(ValueError, match="contract"):
        schemas.assert_contract(views["kpis"], schemas.VIEW_CONTRACTS["daily_region"])


def test_daily_view_values(seed):
    row = warehouse.view_daily_region(seed).where("region_name = 'North London' and reading_date = '2026-01-02'").first()
    assert (row["total_kwh"], row["average_kwh"], row["reading_count"], row["unique_meter_count"]) == (Decimal("9.0000"), Decimal("4.5000"), 2, 2)


def test_kpis_freshness_and_run_durations(seed):
    views = warehouse.serving_views(seed, AS_OF)
    kpis = views["kpis"].first()
    assert (kpis["total_customers"], kpis["total_anomalies"], kpis["failed_pipeline_runs"], kpis["failed_data_quality_checks"]) == (10, 3, 1, 1)
    assert kpis["latest_reading_timestamp"] == datetime(2026, 1, 14, 23, 59, 59)
    assert serving.freshness(views, AS_OF).first()["hours_since_latest_reading"] == 1  # one boundary crossed
    assert {r["pipeline_run_id"]: r["duration_seconds"] for r in views["run_summary"].collect()} == {"P1": 240, "P2": 3600, "P3": 60}
    assert serving.anomaly_rate(views).first()[0] == pytest.approx(0.3)
    assert serving.customer(views, "nobody").count() == 0


def test_empty_warehouse(seed):
    empty = {name: df.where("false") for name, df in seed.items()}
    views = warehouse.serving_views(empty, AS_OF)
    assert views["kpis"].first()["total_kwh"] == 0
    assert serving.anomaly_rate(views).first()[0] == 0.0
    assert {r["failed_count"] for r in quality.audit_fk(empty, [("c", "dim_meter", "customer_id", "dim_customer", "customer_id")]).collect()} == {0}


def test_facts_carry_tariff_cost_and_keys(seed):
    row = seed["fact_consumption"].where("meter_id = 'M2' and date_id = 20260101").first()
    assert (row["tariff_id"], row["kwh"], row["estimated_cost"]) == ("T-BIZ-2026", Decimal("3.0000"), Decimal("1.6650"))
    assert row["reading_timestamp"] == datetime(2026, 1, 1, 23, 59, 59)


def test_strict_lookup_fails_and_lenient_ones_do_not(spark, seed):
    df = spark.createDataFrame([("C1", 1), ("nobody", 2), (None, 3)], "customer_id string, n int")
    with pytest.raises(PySparkException, match="no dimension row for customer_id"):
        joins.lookup(df, seed["dim_customer"], "customer_id", ["customer_segment"]).collect()
    assert [r["n"] for r in joins.lookup(df, seed["dim_customer"], "customer_id", ["region_id"], "drop").collect()] == [1]
    matched, unmatched = joins.lookup(df, seed["dim_customer"], "customer_id", ["region_id"], "reject")
    assert [r["n"] for r in matched.collect()] == [1] and sorted(r["n"] for r in unmatched.collect()) == [2, 3]


def test_loading_readings_twice_adds_nothing(spark, seed):
    events = spark.createDataFrame(
        [("e1", "M1", "C1", "North London", datetime(2026, 1, 14), 1.5, None, "s"), ("e2", "M1", "C1", "North London", datetime(2026, 1, 14), 2.5, 0.0, "s"),
         ("e2", "M1", "C1", "North London", datetime(2026, 1, 14), 2.5, 0.0, "s"), ("e3", "M1", "C1", "Mars", datetime(2026, 1, 14), 2.5, 231.0, "s")],
        "event_id string, meter_id string, customer_id string, region_name string, event_timestamp timestamp, kwh double, voltage double, source_system string")
    loaded, unknown = dimensions.load_readings(seed["fact_reading"].where("false"), events, seed["dim_region"])
    assert sorted((r["reading_id"], r["voltage"]) for r in loaded.collect()) == [("e1", Decimal("230.000")), ("e2", Decimal("230.000"))]
    assert [r["event_id"] for r in unknown.collect()] == ["e3"]
    again, _ = dimensions.load_readings(loaded, events, seed["dim_region"])
    assert again.count() == 2


def test_upsert_updates_inserts_and_preserves(spark):
    target = spark.createDataFrame([(1, "old", 10), (2, "keep", 20)], "id int, name string, created int")
    source = spark.createDataFrame([(1, None, 99), (3, "new", 30)], "id int, name string, created int")
    assert sorted(map(tuple, dimensions.upsert(target, source, ["id"], preserve=["created"]).collect()), key=str) == [(1, None, 10), (2, "keep", 20), (3, "new", 30)]


def test_surrogate_keys_continue(spark):
    names = spark.createDataFrame([("d",), ("a",), ("c",), ("a",), (None,)], "name string")
    first = dimensions.assign_keys(names.where("name in ('a', 'd')"), "name", None, "id")
    assert dict(map(tuple, first.collect())) == {"a": 1, "d": 2}
    assert dict(map(tuple, dimensions.assign_keys(names, "name", first, "id").collect())) == {"a": 1, "d": 2, "c": 3}


def test_dim_date_adds_missing_days_only(spark, seed):
    more = spark.createDataFrame([(datetime(2026, 1, 14, 5),), (datetime(2026, 1, 18, 5),), (None,)], "t timestamp")
    grown = dimensions.dim_date(more, "t", existing=seed["dim_date"])
    assert grown.count() == 15
    assert tuple(grown.where("date_id = 20260118").first()) == (20260118, date(2026, 1, 18), 2026, 1, 1, "January", 18, "Sunday", True)
    assert dimensions.date_spine(spark, "2026-01-01", "2026-01-14").count() == 14


def test_range_join_matches_the_inequality(spark, seed):
    left = spark.createDataFrame([(1, date(2025, 12, 30), date(2026, 1, 2)), (2, date(2026, 1, 5), date(2026, 1, 4)), (3, None, date(2026, 1, 4)), (4, date(2026, 1, 13), None), (5, date(1900, 1, 1), date(2025, 1, 1))], "id int, a date, b date")
    got = joins.range_join(left, seed["dim_date"].select("full_date", "date_id"), "full_date", "a", "b")
    assert sorted((r["id"], r["date_id"]) for r in got.collect()) == [(1, 20260101), (1, 20260102), (4, 20260113), (4, 20260114)]


def test_orphans_with_and_without_null(spark, seed):
    fact = spark.createDataFrame([("a", 1), ("b", 99), ("c", 99), ("d", None)], "id string, region_id int")
    for skip, want in ((False, ["b", "c", "d"]), (True, ["b", "c"])):
        assert sorted(r["id"] for r in joins.orphans(fact, seed["dim_region"], "region_id", "region_id", skip).collect()) == want
        assert joins.orphan_count(fact, seed["dim_region"], "region_id", "region_id", skip).first()[0] == len(want)
    specs = [joins.ForeignKey("fact_missing_region", "fact", "id", "region_id", "dim", "region_id")]
    assert sorted(map(tuple, joins.referential_report({"fact": fact, "dim": seed["dim_region"]}, specs).collect()), key=str) == [
        ("fact_missing_region", "b", "99"), ("fact_missing_region", "c", "99"), ("fact_missing_region", "d", None)]


def test_inactive_parent(seed):
    assert [r["meter_id"] for r in joins.active_child_inactive_parent(seed["dim_meter"], seed["dim_customer"].select("customer_id", "is_active"), "customer_id").collect()] == ["M4"]


def test_check_constraint_passes_on_null(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "kwh int")
    assert [tuple(r) for r in quality.audit_checks(df, {"positive": F.col("kwh") >= 0, "small": F.col("kwh") < 5}).collect()] == [("positive", 1), ("small", 0)]
    assert [tuple(r) for r in quality.audit_not_null(df, ["kwh"]).collect()] == [("kwh", 1)]


def test_gate_raises_only_when_a_check_failed(spark, seed):
    good = [quality.has_rows("has_rows", "fact_consumption"), quality.no_row_where("no_negative", "fact_consumption", F.col("kwh") < 0)]
    results = quality.run_checks(seed, good, "R1", AS_OF)
    quality.gate(results)
    bad = [*good, quality.has_rows("gone_has_rows", "gone"), quality.any_value("gone_latest", "gone", "kwh")]
    results = quality.run_checks({**seed, "gone": seed["fact_consumption"].where("false")}, bad, "R1", AS_OF)
    assert results.count() == 4
    with pytest.raises(quality.QualityGateError, match=r"gone_has_rows \(1\), gone_latest \(1\)"):
        quality.gate(results)


def test_defaults(spark):
    df = spark.createDataFrame([(None, 1), ("x", None)], "status string, n int")
    got = quality.with_defaults(df, {"status": "received", "n": 0, "added": F.lit(True)})
    assert sorted(map(tuple, got.collect())) == [("received", 1, True), ("x", 0, True)]


def test_run_log_keeps_the_last_state(spark):
    log = aggregates.union_all([
        runlog.run_started(spark, "p", "r1", "2026-01-01 00:00:00"), runlog.run_started(spark, "p", "r1", "2026-01-01 00:05:00"),
        runlog.run_failed(spark, "p", "r1", "x" * 5000, "2026-01-01 01:00:00"), runlog.run_succeeded(spark, "p", "r1", {"read": 7}, "2026-01-01 02:00:00"),
        runlog.run_started(spark, "p", "r2", "2026-01-02 00:00:00"), runlog.run_failed(spark, "p", "r3", "x" * 5000, "2026-01-03 00:00:00")])
    runs = {r["started_at"].day: r for r in runlog.current_runs(log).collect()}
    assert [runs[d]["status"] for d in (1, 2, 3)] == ["succeeded", "running", "failed"]
    assert runs[1]["started_at"] == datetime(2026, 1, 1) and runs[1]["records_read"] == 7 and runs[1]["error_message"] is None
    assert len(runs[3]["error_message"]) == 5000
    assert runs[1]["pipeline_run_id"].startswith("AF-") and len(runs[1]["pipeline_run_id"]) == 23


def test_counts_are_observed_during_the_write(spark, tmp_path):
    df, seen = runlog.observe_counts(spark.range(10), "w", even=F.col("id") % 2 == 0)
    df.write.parquet(str(tmp_path / "x"))
    assert seen.get == {"rows": 10, "even": 5}


def test_pipeline_counts_match_the_files(spark, sf_dir):
    from meterlake.plans import registry

    result = registry._pipeline(spark, sf_dir)
    for name in ("clean_consumption", "rejected_records", "consumption_weather_features", "fact_consumption"):
        layer = next(k for k in result.counts if k.endswith("/" + name))
        assert result.counts[layer] == result.tables[name].count(), name


def test_a_second_run_adds_to_the_first(spark, tmp_path):
    """Two days by two runs, then the second again: keys live on, ids stay unique, a rerun replaces itself."""
    from meterlake.plans.batch import run_batch

    def bronze(name, day, customers):
        folder = tmp_path / name
        for sub in ("historical_consumption", "weather"):
            (folder / sub).mkdir(parents=True)
        lines = [f"f,{name},M-{c},C-{c},{r},2026-01-{day} {h:02d}:30:00,1.5,2026-02-01 00:00:00" for c, r in customers for h in range(4)]
        (folder / "historical_consumption" / "a.csv").write_text("\n".join([",".join(schemas.BRONZE_CONSUMPTION.names), *lines, lines[0], "f,x,,C-1,Mars,never,-1,now"]) + "\n")
        (folder / "weather" / "w.csv").write_text(",".join(schemas.BRONZE_WEATHER.names) + f"\n2026-01-{day} 00:00:00,{customers[0][1]},7.5,80,10,0.0,2026-02-01 00:00:00\n")
        (folder / "customers.csv").write_text("\n".join([",".join(schemas.BRONZE_CUSTOMER.names), *[f"C-{c},Residential,2,flat,{r},UK,N,2020-01-01,true" for c, r in customers]]) + "\n")
        (folder / "meters.csv").write_text("\n".join([",".join(schemas.BRONZE_METER.names), *[f"M-{c},C-{c},{r},smart,2020-01-01,true" for c, r in customers]]) + "\n")
        (folder / "tariffs.csv").write_text(",".join(schemas.BRONZE_TARIFF.names) + "\n" + "\n".join(f"{t},{n},2026-01-01,,{p},{s},true" for t, n, p, s in schemas.TARIFFS) + "\n")
        return str(folder)

    facts = str(tmp_path / "facts")
    first = run_batch(spark, bronze("b1", 14, [(1, "South London"), (2, "West London")]), str(tmp_path / "r1"), "b1", as_of=AS_OF, facts=facts)
    assert first.counts["silver/rejected_records"] == 2 and first.counts["warehouse/fact_consumption"] == 2
    matched = first.tables["consumption_weather_features"].where("temperature_c is not null").collect()
    assert [(r["region_name"], r["reading_hour"]) for r in matched] == [("South London", 0)]
    source = bronze("b2", 15, [(1, "South London"), (3, "East London")])
    for attempt in ("r2", "r3"):
        second = run_batch(spark, source, str(tmp_path / attempt), "b2", as_of=AS_OF, facts=facts, previous=first.tables)
        tables = second.tables
        assert {r["region_name"]: r["region_id"] for r in tables["dim_region"].collect()} == {"South London": 1, "West London": 2, "East London": 3}
        assert (tables["dim_customer"].count(), tables["dim_meter"].count(), tables["dim_date"].count()) == (3, 3, 2)
        rows = tables["fact_consumption"].collect()
        assert sorted(r["consumption_id"] for r in rows) == [1, 2, 3, 4]
        assert sorted((r["batch_id"], r["customer_id"], float(r["kwh"])) for r in rows) == [("b1", "C-1", 6.0), ("b1", "C-2", 6.0), ("b2", "C-1", 6.0), ("b2", "C-3", 6.0)]


def test_the_record_hash_is_made_behind_the_shuffle(spark, tmp_path):
    """rows are dealt out for their layout without the hash, and still lie in its order."""
    from meterlake.plans import batch

    class Kept:
        def save(self, name, df):
            return df

        def save_all(self, layer, tables):
            return tables

    rows = [f"f,b,M-{m},C-1,South London,2026-01-{d} 01:30:00,1.5,2026-02-01 00:00:00" for m in (2, 1) for d in (15, 14)]
    for path, schema, lines in (("historical_consumption/a.csv", schemas.BRONZE_CONSUMPTION, rows), ("weather/w.csv", schemas.BRONZE_WEATHER, []), ("customers.csv", schemas.BRONZE_CUSTOMER, []),
                                ("meters.csv", schemas.BRONZE_METER, []), ("tariffs.csv", schemas.BRONZE_TARIFF, [])):
        (tmp_path / path).parent.mkdir(exist_ok=True)
        (tmp_path / path).write_text("\n".join([",".join(schema.names), *lines]) + "\n")
    frame, days, *order = batch.bronze_to_silver(spark, str(tmp_path), Kept(), schemas.REGIONS, AS_OF)["clean_consumption"]
    plan = batch.arranged(frame, days, *order)._jdf.queryExecution().optimizedPlan().toString()
    above, _, below = plan.partition("RepartitionByExpression")
    assert below and "sha2" in above and "sha2" not in below and "raw_text" not in below.split("Window")[0].split("Project")[0]
    got = [(str(r["reading_date"]), r["meter_id"], len(r["record_hash"])) for r in frame.coalesce(1).collect()]
    assert sorted(got) == [(f"2026-01-{d}", f"M-{m}", 64) for d in (14, 15) for m in (1, 2)]

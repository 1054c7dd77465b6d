"""Decisions on typing and validation, on literal rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from meterlake import functions as fn
from meterlake import schemas
from meterlake.operators import cleaning

AS_OF = "2026-01-15 00:00:00"


def bronze(spark, *rows):
    base = dict(source_file="f.csv", batch_id="b", meter_id="MTR-LON-001", customer_id="CUST-LON-001", region_name="North London",
                reading_timestamp="2026-01-14T12:00:00", kwh="0.5", ingestion_timestamp="2026-01-15T00:00:00+00:00")
    return spark.createDataFrame([tuple({**base, **r}[c] for c in schemas.BRONZE_CONSUMPTION.names) for r in rows], schemas.BRONZE_CONSUMPTION)


def reasons(spark, **row):
    return cleaning.validate_consumption(bronze(spark, row)).first()["rejection_reason"]


@pytest.mark.parametrize("row, reason", [
    ({}, ""),
    ({"meter_id": "  "}, "Missing meter_id"),
    ({"meter_id": None}, "Missing meter_id"),
    ({"customer_id": ""}, "Missing customer_id"),
    ({"reading_timestamp": "not-a-timestamp"}, "Invalid reading_timestamp"),
    ({"kwh": "abc"}, "Missing or invalid kwh"),
    ({"kwh": "NaN"}, "Missing or invalid kwh"),
    ({"kwh": "-1.2500"}, "Negative kwh"),
    ({"kwh": "0"}, ""),
    ({"region_name": " North London "}, ""),
    ({"region_name": "Unknown London"}, "Invalid region_name"),
    ({"meter_id": "", "kwh": "-1", "region_name": None}, "Missing meter_id; Negative kwh; Invalid region_name"),
])
def test_batch_rules(spark, row, reason):
    assert reasons(spark, **row) == reason


@pytest.mark.parametrize("kwh, reason", [("", "Missing kwh"), ("-1", "Negative or invalid kwh"), ("x", "Negative or invalid kwh"), ("nan", "Negative or invalid kwh")])
def test_row_rules_word_kwh_differently(spark, kwh, reason):
    df = bronze(spark, {"kwh": kwh}).select(fn.rejection_reason(fn.consumption_rules(style="row")).alias("r"))
    assert df.first()["r"] == reason


def test_good_row_survives_a_bad_one_of_the_same_key_and_file(spark):
    raw = bronze(spark, {"kwh": "-1.25"}, {"kwh": "0.5"}, {"kwh": "0.5"}, {"region_name": "Unknown London"})
    clean, rejects = cleaning.transform_consumption(raw, as_of=AS_OF)
    assert [r["kwh"] for r in clean.collect()] == [0.5]
    assert sorted(r["rejection_reason"] for r in rejects.collect()) == [
        "Duplicate meter_id and reading_timestamp",
        "Invalid region_name; Duplicate meter_id and reading_timestamp",
        "Negative kwh; Duplicate meter_id and reading_timestamp",
    ]


def test_first_file_wins_and_null_file_comes_last(spark):
    raw = bronze(spark, {"source_file": None, "kwh": "1"}, {"source_file": "b.csv", "kwh": "2"}, {"source_file": "c.csv", "kwh": "3"})
    clean, _ = cleaning.transform_consumption(raw, as_of=AS_OF)
    assert [r["kwh"] for r in clean.collect()] == [2.0]


def test_rejects_keep_payload_with_nulls_and_sorted_keys(spark):
    _, rejects = cleaning.transform_consumption(bronze(spark, {"meter_id": None, "source_file": None}), as_of=AS_OF)
    row = rejects.first()
    assert row["source_reference"] == "unknown_file:missing_meter"
    assert row["raw_payload"].startswith('{"batch_id":"b","customer_id":') and '"meter_id":null' in row["raw_payload"]
    assert row["rejected_at"] == datetime(2026, 1, 15)


def envelope(spark, *payloads):
    rows = [(p, datetime(2026, 1, 15), "bronze", None, None, None) for p in payloads]
    return spark.createDataFrame(rows, schemas.ENVELOPE)


EVENT = ('{"event_id":"e1","meter_id":"m","customer_id":"c","region_name":"North London","event_timestamp":"2026-01-14T12:00:00Z",'
         '"kwh":%s,"voltage":%s,"event_type":"%s","source_system":"s","producer_timestamp":"2026-01-14T12:00:01Z"}')


@pytest.mark.parametrize("payload, reason", [
    (EVENT % ("1.5", "230.1", "reading"), ""),
    (EVENT % ("1.5", "null", "heartbeat"), ""),
    (EVENT % ("1.5", "0", "reading"), "Invalid voltage"),
    (EVENT % ("-1.5", "230", "reading"), "Negative kwh"),
    (EVENT % ("null", "230", "reading"), "Missing or invalid kwh"),
    (EVENT % ('"x"', "230", "reading"), "Missing or invalid kwh"),
    (EVENT % ("1", "230", "boom"), "Invalid event_type"),
    ((EVENT % ("1", "230", "reading")).replace("North London", " North London"), "Invalid region_name"),
    ((EVENT % ("1", "230", "reading")).replace("2026-01-14T12:00:01Z", "soon"), "Invalid producer_timestamp"),
])
def test_event_rules(spark, payload, reason):
    assert cleaning.validate_events(envelope(spark, payload)).first()["rejection_reason"] == reason


@pytest.mark.parametrize("payload", ['{"event_id":"malformed_event","meter_id":', "", None, "[1, 2]", '"text"', "17", "no json"])
def test_text_that_is_no_json_object_is_malformed(spark, payload):
    row = cleaning.validate_events(envelope(spark, payload)).first()
    assert row["rejection_reason"].startswith("Malformed JSON;Missing event_id;Missing meter_id")
    assert row["raw_event_payload"] == payload


def test_duplicate_events_in_a_batch_keep_the_first(spark):
    event = EVENT % ("1.5", "230", "reading")
    later = event.replace("12:00:01Z", "12:00:02Z")
    rows = cleaning.validate_events(envelope(spark, later, event, event)).collect()
    assert sorted((r["raw_event_payload"] == event, r["rejection_reason"]) for r in rows) == [
        (False, "Duplicate event_id in micro-batch"), (True, ""), (True, "Duplicate event_id in micro-batch")]


def test_producer_rules_list_missing_fields_once(spark):
    row = spark.createDataFrame([(None, " ", "c", "Mars", "x", "-1", "0", None, None, "2026-01-14T12:00:01Z")],
                                ", ".join(f"{c} string" for c in schemas.EVENT.names))
    assert row.select(fn.rejection_reason(fn.event_row_rules()).alias("r")).first()["r"] == (
        "Missing required fields: event_id, meter_id, event_type, source_system; Invalid region_name; Invalid event_timestamp; "
        "Negative or invalid kwh; Invalid voltage")


@pytest.mark.parametrize("kwh, kind, recent, expected", [
    (15.0, "reading", None, "anomaly"), (0.75, "anomaly", None, "anomaly"), (0.75, "reading", None, "reading"),
    (10.0, "reading", None, "reading"), (3.1, "reading", 1.0, "anomaly"), (3.0, "reading", 1.0, "reading"),
    (3.0, "reading", 0.0, "reading"), (50.0, "heartbeat", None, "heartbeat"),
])
def test_classification(spark, kwh, kind, recent, expected):
    df = spark.createDataFrame([(kwh, kind, recent, "")], "kwh double, event_type string, recent double, reason string")
    assert df.select(fn.classify_event("reason", "recent").alias("c")).first()["c"] == expected


def test_anomaly_scores(spark):
    df = cleaning.clean_events(cleaning.validate_events(envelope(
        spark, EVENT % ("15", "230", "reading"), (EVENT % ("1", "230", "anomaly")).replace('"e1"', '"e2"'),
        (EVENT % ("10", "230", "reading")).replace('"e1"', '"e3"'))))
    found = {r["anomaly_id"]: (r["anomaly_type"], r["anomaly_score"]) for r in cleaning.detect_anomalies(df).collect()}
    assert found == {"anom_e1": ("high_kwh_threshold", 0.95), "anom_e2": ("producer_flagged_anomaly", 0.75)}


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_expressions(spark):
    ts = F.lit("2026-01-14 00:59:30").cast("timestamp")
    later = F.lit("2026-01-14 01:01:00").cast("timestamp")
    assert one(spark, fn.boundary_diff("HOUR", ts, later), fn.boundary_diff("SECOND", ts, later)) == (1, 90)
    assert one(spark, fn.date_id(F.lit("2026-01-04").cast("date")), fn.iso_z(ts)) == (20260104, "2026-01-14T00:59:30Z")
    assert one(spark, fn.end_of_day(F.lit("2026-01-04").cast("date")).cast("string")) == ("2026-01-04 23:59:59",)
    assert one(spark, fn.pad_id("evt_", F.lit(7), 8), fn.pad_id("evt_", F.lit(123456789), 8)) == ("evt_00000007", "evt_123456789")
    assert one(spark, fn.safe_divide(F.lit(1), F.lit(0)), fn.safe_divide(F.lit(3), F.lit(2))) == (0.0, 1.5)
    assert one(spark, *[fn.default_if_falsy(F.lit(v).cast("double")) for v in (None, 0.0, 231.5)]) == (230.0, 230.0, 231.5)
    assert one(spark, fn.event_timestamp(F.lit("2026-01-14T10:00:00Z")).cast("string"), fn.event_timestamp(F.lit("x"))) == ("2026-01-14 10:00:00", None)
    assert one(spark, fn.prefixed_sha1("AF-", 20, F.lit("dag"), F.lit("run")))[0].startswith("AF-")
    parts = fn.date_parts(F.lit("2026-01-17").cast("date"))
    assert one(spark, *parts.values()) == (2026, 1, 1, "January", 17, "Saturday", True)


def test_tariff_and_cost(spark):
    picks = [fn.choose_tariff(F.lit(s), F.lit(n)) for s, n in (("Small Business", 1), ("Residential", 2), ("Residential", 3))]
    assert one(spark, *picks) == ("T-BIZ-2026", "T-ECO-2026", "T-STD-2026")
    assert float(one(spark, fn.estimated_cost(F.lit("10.0000"), F.lit("0.2860"), F.lit("0.5300")))[0]) == 3.39
    assert str(one(spark, fn.estimated_cost(F.lit("0.0050"), F.lit("0.0100"), F.lit("0")))[0]) == "0.0001"  # half up


def test_event_times(spark):
    good = {"2026-01-14T10:00:00Z": "10:00:00", "2026-01-14 10:00:00": "10:00:00", "2026-01-14T10:00:00": "10:00:00", "2026-01-14T12:00:00+02:00": "10:00:00", " 2026-01-14T10:00:00.250Z ": "10:00:00.25", "2026-01-14": "00:00:00"}
    for text, time in good.items():
        assert one(spark, fn.event_timestamp(F.lit(text)).cast("string")) == (f"2026-01-14 {time}",)
    for text in ("2026", "Tuesday", "", "2026-01-14TZ10:00:00", "2026-13-01T00:00:00Z", None):
        assert one(spark, fn.event_timestamp(F.lit(text).cast("string"))) == (None,)


def test_optional_filters(spark):
    df = spark.createDataFrame([(date(2026, 1, d), datetime(2026, 1, d, 12)) for d in (1, 2, 3)], "d date, t timestamp")
    assert fn.optional_eq(df, "d", None) is df
    assert fn.optional_date_range(df, "d", "2026-01-02", "2026-01-03").count() == 2
    assert fn.optional_date_range(df, "d", end="never").count() == 0
    assert fn.optional_ts_range(df, "t", end="2026-01-02").count() == 2
    assert fn.future_rows(df, "t", "2026-01-02 12:00:00").count() == 1

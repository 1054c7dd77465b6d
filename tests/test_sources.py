"""Sources and sinks."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from meterlake import schemas, session
from meterlake.plans import serving
from meterlake.sources import readers, sinks


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_csv_tree_reads_all_folders_without_folder_columns(spark, tmp_path):
    for day in ("01", "02"):
        folder = tmp_path / "c" / "year=2026" / "month=01" / f"day={day}"
        folder.mkdir(parents=True)
        (folder / f"x_{day}.csv").write_text("customer_id,customer_segment,household_size,dwelling_type,region_name,country,postcode_area,signup_date,is_active\n"
                                             f"C{day},Residential,two,flat,R,UK,N,2020-01-01,true\n")
        (folder / "notes.txt").write_text("not a table\n")
    df = readers.read_csv_tree(spark, str(tmp_path / "c"), schemas.BRONZE_CUSTOMER)
    assert df.columns == [*schemas.BRONZE_CUSTOMER.names, schemas.CORRUPT]
    assert [(r["customer_id"], r["household_size"], r["is_active"]) for r in df.sort("customer_id").collect()] == [("C01", "two", "true"), ("C02", "two", "true")]


def test_csv_fields_go_by_the_header_of_their_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("meter_id,customer_id,region_name,meter_type,installation_date,is_active\nM1,C1,R,smart,2020-01-01,true\nM2,C2,R,smart,2020-01-01,true,more\nM3,C3\n")
    (tmp_path / "b.csv").write_text("is_active,note,customer_id,meter_id\nfalse,\"a, b\",C4,M4\n")
    rows_ = {r["meter_id"]: r for r in readers.read_csv_tree(spark, str(tmp_path), schemas.BRONZE_METER).collect()}
    assert (rows_["M1"]["customer_id"], rows_["M1"]["is_active"], rows_["M1"][schemas.CORRUPT]) == ("C1", "true", None)
    assert (rows_["M4"]["customer_id"], rows_["M4"]["is_active"], rows_["M4"]["region_name"]) == ("C4", "false", None)
    bad = [r for r in readers.read_csv_tree(spark, str(tmp_path), schemas.BRONZE_METER).collect() if r[schemas.CORRUPT]]
    assert sorted(r[schemas.CORRUPT] for r in bad) == ["M2,C2,R,smart,2020-01-01,true,more", "M3,C3"]
    assert all(r[c] is None for r in bad for c in schemas.BRONZE_METER.names)  # no values shifted into other columns


def test_csv_quotes_in_header_and_line_breaks_in_fields(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\ufeff"meter_id","customer_id" ,"unasked, for"\n"M1","C1","x"\nmeter_id,customer_id,unasked\n')
    (tmp_path / "b.csv").write_text('customer_id,meter_id\n"C,\n2",M2\n')
    (tmp_path / "c.csv").write_text("nothing,of,it\n1,2,3\n")
    (tmp_path / "d.csv").write_text("")
    rows = readers.read_csv_tree(spark, str(tmp_path), schemas.BRONZE_METER, multi_line=True).collect()
    assert sorted((r["meter_id"], r["customer_id"]) for r in rows if not r[schemas.CORRUPT]) == [("M1", "C1"), ("M2", "C,\n2"), ("meter_id", "customer_id")]  # a line like the header is data
    assert {r[schemas.CORRUPT] for r in rows} == {None, "nothing,of,it", "1,2,3"}
    one = readers.read_csv_file(spark, str(tmp_path / "a.csv"), schemas.BRONZE_METER)
    assert one.select(schemas.CORRUPT).distinct().collect()[0][0] is None


def test_each_header_is_one_scan_by_the_engine(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.csv").write_text("meter_id,customer_id\nM,C\n" if i % 2 else "customer_id,meter_id\nC,M\n")
    df = readers.read_csv_tree(spark, str(tmp_path), schemas.BRONZE_METER)
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 2


def test_missing_inputs_are_errors(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for call in (lambda: readers.read_csv_tree(spark, str(tmp_path / "empty"), schemas.BRONZE_METER),
                 lambda: readers.read_csv_tree(spark, str(tmp_path / "none"), schemas.BRONZE_METER),
                 lambda: readers.read_csv_file(spark, str(tmp_path / "none.csv"), schemas.BRONZE_METER)):
        with pytest.raises(FileNotFoundError):
            call()


def test_partitioned_table_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).select(F.col("id"), (F.col("id") % 4).cast("int").alias("day"))
    sinks.write_table(df, path, ["day"], sort_by=["id"])
    back = readers.read_table(spark, path)
    assert rows(back) == rows(df)
    plan = back.where("day = 2 and id > 50").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: [IsNotNull(id), GreaterThan(id,50)]" in plan


def test_a_retried_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch, n in ((1, 5), (2, 3), (1, 2)):
        sinks.write_batch(spark.range(n), path, batch)
    assert {r["batch_id"]: r["count"] for r in spark.read.parquet(path).groupBy("batch_id").count().collect()} == {1: 2, 2: 3}


def test_events_as_json_lines(spark, tmp_path):
    df = spark.createDataFrame([("e1", None, 1.5)], "event_id string, voltage double, kwh double")
    sinks.write_events(df, str(tmp_path / "e"))
    assert spark.read.text(str(tmp_path / "e")).first()[0] == '{"event_id":"e1","kwh":1.5,"voltage":null}'
    with pytest.raises(ValueError):
        sinks.write_events(df)


def test_jdbc_options():
    assert sinks.jdbc_options("jdbc:x", "t", batch_size=5, connections=2, user="u") == {
        "url": "jdbc:x", "dbtable": "t", "batchsize": "5", "numPartitions": "2", "user": "u"}


def test_kafka_records_become_envelopes(spark):
    record = spark.createDataFrame([(None, bytearray(b'{"a":1}'), "t", 3, 42, datetime(2026, 1, 1), 0)], schemas.KAFKA_RECORD)
    row = readers.kafka_to_envelope(record, as_of="2026-01-02 00:00:00").first()
    assert (row["raw_event_payload"], row["partition_id"], row["offset"]) == ('{"a":1}', "3", "42")
    assert row["producer_metadata"] == '{"topic":"t","kafka_timestamp":"2026-01-01 00:00:00","timestamp_type":0}'
    options = readers.kafka_options("host:9092", "t", "secret", "earliest")
    assert options["startingOffsets"] == "earliest" and 'password="secret"' in options["kafka.sasl.jaas.config"]
    assert "kafka.sasl.mechanism" not in readers.kafka_options("host:9092", "t")


def test_unknown_stream_format(spark):
    with pytest.raises(ValueError, match="unknown stream format"):
        readers.event_stream(spark, "carrier_pigeon", "x")


def test_constant_rows_and_views(spark):
    readers.values_table(spark, [(1, "a")], "id int, name string").createOrReplaceTempView("serving_test")
    assert ("serving_test",) in rows(readers.list_views(spark, "serving_"))
    assert serving.query(spark, "  select name FROM serving_test WHERE (:id IS NULL OR id = :id)", {"id": 1}).first()["name"] == "a"
    assert serving.query(spark, "WITH x AS (SELECT 1 AS a) SELECT a FROM x").count() == 1
    for statement in ("DROP VIEW serving_test", "INSERT INTO x VALUES (1)", ""):
        with pytest.raises(ValueError, match="only SELECT"):
            serving.query(spark, statement)


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_dir(spark) and session.scratch_path(spark, "x") != session.scratch_path(spark, "x")
    assert spark.sparkContext.getConf().get("spark.checkpoint.dir").rstrip("/") in session.shared_dir(spark)


def test_a_page_is_what_the_caller_asks_for(spark):
    views = {"latest_reading": spark.range(1500).select(F.concat(F.lit("M"), "id").alias("meter_id"), F.lit("2026-01-01").cast("timestamp").alias("event_timestamp"))}
    assert serving.latest(views, limit=5000).count() == serving.latest(views).count() == 1500
    assert serving.latest(views, limit=7).count() == 7
    with pytest.raises(ValueError):
        serving.latest(views, limit=0)


def test_batch_ids_with_odd_characters(spark, tmp_path):
    df = spark.range(3).withColumn("batch_id", F.lit("a/b:c=1 %"))
    sinks.write_batch(df, str(tmp_path / "t"), "a/b:c=1 %")
    sinks.write_batch(df.limit(2), str(tmp_path / "t"), "00042")
    back = spark.read.schema("id bigint, batch_id string").parquet(str(tmp_path / "t"))
    assert sorted({r["batch_id"] for r in back.collect()}) == ["00042", "a/b:c=1 %"] and back.count() == 5

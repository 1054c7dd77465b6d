"""Stream to warehouse: complete silver batches become reading and anomaly facts."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.operators import dimensions
from meterlake.operators.aggregates import tagged_union
from meterlake.sources.readers import exists
from meterlake.sources.sinks import write_batch
from meterlake.streaming.micro_batch import Sinks, read_batches, unique_events


class Loaded(NamedTuple):
    readings: DataFrame
    anomalies: DataFrame
    unknown: DataFrame  # table_name, record_id, region_name of rows whose region has no dimension row


_PROCESSED = "batch_id bigint, load_id string"


def new_batches(spark: SparkSession, sinks: Sinks, processed: str, load_id: str) -> list[int]:
    """Complete batches no other load has taken: as many numbers as batches came in since."""
    if not exists(spark, sinks.metrics):
        return []
    complete = spark.read.parquet(sinks.metrics).select(F.col("batch_id").cast("bigint").alias("batch_id")).distinct()
    if exists(spark, processed):
        complete = complete.join(spark.read.schema(_PROCESSED).parquet(processed).where(F.col("load_id") != load_id), "batch_id", "left_anti")
    return sorted(r[0] for r in complete.collect())


def _of_batches(spark: SparkSession, path: str, batches: list[int]) -> DataFrame:
    """The rows of these batches; folders of other batches are not even listed."""
    rows = spark.read.option("basePath", path).parquet(*[f"{path}/batch_id={b}" for b in batches])
    return rows.withColumn("batch_id", F.col("batch_id").cast("bigint"))


def load_new(spark: SparkSession, sinks: Sinks, regions: DataFrame, readings: str, anomalies: str, processed: str, load_id: str) -> Loaded | None:
    """``load_stream`` for the batches that came in since the last load; None if there are none.

    What a load has taken is written to ``processed`` when its facts are; a load that failed, or is run again under its id, takes its batches again and replaces its own rows. Silver of earlier batches is not opened, and the facts are
    looked through only in the days the new rows touch. An event that comes again counts once if its day is the same.
    """
    batches = new_batches(spark, sinks, processed, load_id)
    if not batches:
        return None
    silver = unique_events(_of_batches(spark, sinks.clean, batches)).drop("batch_id")
    found = _of_batches(spark, sinks.anomalies, batches).drop("batch_id")
    out = _load(spark, silver, found, regions, readings, anomalies, load_id, by_day=True)
    write_batch(spark.createDataFrame([(b,) for b in batches], "batch_id bigint"), processed, load_id, "load_id")
    return out


def _add(spark: SparkSession, rows: DataFrame, path: str, key: str, load_id: str, by_day: bool = False) -> DataFrame:
    """Append the rows whose key the fact does not hold yet, and return the fact.

    Only the days these rows touch are looked through, and a load that is run again replaces its own rows. With ``by_day`` the days are listed first, so that no file of another day is opened.
    """
    new = rows
    schema = T.StructType([*rows.drop("date_id").schema, T.StructField("load_id", T.StringType()), T.StructField("date_id", T.IntegerType())])
    if exists(spark, path):
        there = spark.read.schema(schema).parquet(path).where(F.col("load_id") != load_id)
        days = rows.select("date_id").distinct()
        if by_day:
            there = there.where(F.col("date_id").isin([r[0] for r in days.collect()]))  # as many as days in the new batches
        new = rows.join(there.join(days, "date_id", "left_semi").select(key), key, "left_anti")
    write_batch(new, path, load_id, "load_id", ["date_id"])
    return spark.read.schema(schema).parquet(path)


def load_stream(spark: SparkSession, sinks: Sinks, regions: DataFrame, readings: str, anomalies: str, load_id: str) -> Loaded:
    """Facts out of the batches that are complete; loading the same batches twice adds nothing.

    ``readings`` and ``anomalies`` are the facts' folders, kept by load and day.
    """
    silver = unique_events(read_batches(spark, sinks.clean, sinks.metrics)).drop("batch_id")
    found = read_batches(spark, sinks.anomalies, sinks.metrics).drop("batch_id")
    return _load(spark, silver, found, regions, readings, anomalies, load_id)


def _load(spark: SparkSession, silver: DataFrame, found: DataFrame, regions: DataFrame, readings: str, anomalies: str, load_id: str, by_day: bool = False) -> Loaded:
    reading_rows, lost_readings = dimensions.reading_rows(silver, regions)
    anomaly_rows, lost_anomalies = dimensions.anomaly_rows(found, regions)
    unknown = tagged_union({"fact_reading": (lost_readings, "event_id"), "fact_anomaly": (lost_anomalies, "anomaly_id")}, dict.fromkeys(("fact_reading", "fact_anomaly"), "region_name"), "region_name")
    return Loaded(_add(spark, reading_rows, readings, "reading_id", load_id, by_day), _add(spark, anomaly_rows, anomalies, "anomaly_id", load_id, by_day), unknown)

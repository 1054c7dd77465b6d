"""Sinks: Parquet tables, replay-safe batches, JSON events, JDBC."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterlake.functions import json_payload
from meterlake.sources.readers import exists


def together(writes: Sequence[Callable[[], object]]) -> list:
    """Run independent writes at the same time and return their results; the first failure is raised.

    Each is a Spark job of its own; side by side, a small one does not leave the executors idle.
    """
    session = SparkSession.getActiveSession()
    # the jobs belong to the caller's job group, so stopping a stream cancels them too
    own = (lambda write: inheritable_thread_target(session)(write)) if session else (lambda write: write)
    with ThreadPoolExecutor(max_workers=max(1, min(len(writes), 8))) as pool:
        return [future.result() for future in [pool.submit(own(write)) for write in writes]]


def arranged(df: DataFrame, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> DataFrame:
    """Rows range-partitioned and sorted by (partition columns, sort columns), ready to be written.

    That gives each day about as many files as it has data, ordered so that row-group statistics
    prune on the sort columns, and it splits a heavy day over several tasks.
    """
    if not sort_by:
        return df
    order = [*partition_by, *sort_by]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
                sort_by: Sequence[str] = ()) -> None:
    """Write Parquet, laid out by ``arranged`` when ``sort_by`` is given."""
    arranged(df, partition_by, sort_by).write.mode(mode).partitionBy(*partition_by).parquet(path)


def _escaped(value: str) -> str:
    """A partition value as Spark writes it into a folder name."""
    return "".join(c if c not in '"#%\'*/:=?\\{[]^\x7f' and c >= " " else f"%{ord(c):02X}" for c in value) or "__HIVE_DEFAULT_PARTITION__"


def write_batch(df: DataFrame, path: str, batch_id: object, column: str = "batch_id",
                partition_by: Sequence[str] = ()) -> None:
    """Replace exactly one batch of a table partitioned by ``column``; a retry leaves no duplicates.

    The batch's folder is overwritten even when there are no rows, so a rerun that yields
    fewer rows removes the old ones. Other batches are not touched.
    """
    folder = f"{path.rstrip('/')}/{column}={_escaped(str(batch_id))}"
    df.drop(column).write.mode("overwrite").partitionBy(*partition_by).parquet(folder)


_BUCKET, _MARK = "bucket", "__mark"


def replace_buckets(changes: DataFrame, path: str, keys: Sequence[str], buckets: int = 64, gone: str | None = None) -> None:
    """Apply one batch of changed rows to a table kept in hash buckets of its ``keys``; only touched buckets are written.

    Rows replace those of their key; rows whose column ``gone`` is true take their key out. ``changes`` holds each key once. A bucket is replaced as a whole, so applying a batch again changes nothing. Each touched bucket also gets a
    mark, so that it is replaced when nothing else is left in it; ``read_buckets`` leaves marks out.
    """
    spark = changes.sparkSession
    placed = changes.withColumn(_BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).withColumn(_MARK, F.lit(False)).persist()
    try:
        touched = placed.select(_BUCKET).distinct()
        rows = placed if gone is None else placed.where(~F.col(gone)).drop(gone)
        if exists(spark, path):
            there = spark.read.schema(rows.schema).parquet(path).where(~F.col(_MARK)).join(touched, _BUCKET, "left_semi")
            new = placed.select(*[F.col(k).alias(f"__new_{k}") for k in keys])
            match = [F.col(k).eqNullSafe(F.col(f"__new_{k}")) for k in keys]
            rows = there.join(new, match, "left_anti").unionByName(rows)
        fixed = {_BUCKET: F.col(_BUCKET), _MARK: F.lit(True)}
        mark = touched.select(*[fixed.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in rows.schema])
        out = rows.unionByName(mark).repartition(_BUCKET)
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_BUCKET).parquet(path)
    finally:
        placed.unpersist()


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where(~F.col(_MARK)).drop(_BUCKET, _MARK)


def capture_bronze(stream: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Append a stream to Parquet; the checkpoint lets a restart continue where it stopped."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start(path)


def jdbc_options(url: str, table: str, batch_size: int = 10_000, connections: int = 8, **extra: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(batch_size), "numPartitions": str(connections), **extra}


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options) -> None:
    """Bulk insert over JDBC. ``numPartitions`` bounds the connections opened at the same time."""
    df.write.format("jdbc").options(**jdbc_options(url, table, **options)).mode(mode).save()


def event_values(events: DataFrame) -> DataFrame:
    """Each row as one JSON text, column ``value``, keys sorted and NULLs kept."""
    return events.select(json_payload(events.columns).alias("value"))


def write_events(events: DataFrame, path: str | None = None, kafka: Mapping[str, str] | None = None,
                 mode: str = "append") -> None:
    """Publish events as JSON lines to a folder, or to a topic."""
    if (path is None) == (kafka is None):
        raise ValueError("give either a path or Kafka options")
    values = events if events.columns == ["value"] else event_values(events)
    if path is not None:
        values.write.mode(mode).text(path)
    else:
        values.select(F.col("value").cast("binary").alias("value")).write.format("kafka").options(**kafka).save()

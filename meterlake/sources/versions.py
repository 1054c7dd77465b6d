"""Tables readers can use while they are replaced, and day tables of small batches that are put together later.

*Versions.* An overwrite goes to a folder of its own; when it is complete, the catalog's table is pointed at it. A reader that has planned its query keeps the folder it planned with; one that
comes later sees the new rows; a writer that dies leaves the table as it was. Folders no longer used are removed by ``remove_versions``, when no reader needs them.

*Day tables.* Batches append to day folders and are replaced as a whole when they are retried. ``compact`` puts the small files of days that are closed together; rows stay what they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.sources.readers import exists
from meterlake.sources.sinks import write_table


# -- versions -----------------------------------------------------------------------
def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").select("data_type").collect()
    return rows[0][0]


def publish(df: DataFrame, table: str, root: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> str:
    """Write ``df`` below ``root`` as the new version of catalog table ``table`` and return its folder.

    The first version creates the table. Later ones must have its columns and types; else nothing is switched.
    """
    spark = df.sparkSession
    folder = f"{root.rstrip('/')}/version={uuid.uuid4().hex}"
    columns = [*[c for c in df.columns if c not in partition_by], *partition_by]
    if spark.catalog.tableExists(table):
        there, given = ([(f.name, f.dataType) for f in x.select(*x.columns).schema] for x in (spark.table(table), df.select(*columns)))
        if there != given:
            raise ValueError(f"{table} has other columns than the new version: {there} against {given}")
    write_table(df, folder, partition_by, mode="errorifexists", sort_by=sort_by)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
    else:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*columns).schema)
        layout = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
        _create(spark, f"CREATE TABLE {table} ({fields}) USING parquet {layout} LOCATION '{folder}'")
    return folder


_BY_FOLDER = "spark.sql.hive.manageFilesourcePartitions"


def _create(spark: SparkSession, statement: str) -> None:
    """Create a table whose partitions are the folders below its location, so that one change of the location switches them all."""
    before = spark.conf.get(_BY_FOLDER)
    spark.conf.set(_BY_FOLDER, "false")  # the table remembers it
    try:
        spark.sql(statement)
    finally:
        spark.conf.set(_BY_FOLDER, before)


def remove_versions(spark: SparkSession, table: str, root: str) -> list[str]:
    """Delete the version folders below ``root`` that ``table`` does not point at; call it when no reader can be on them. Returns what went."""
    jvm = spark.sparkContext._jvm
    current = _location(spark, table).rstrip("/").rsplit("/", 1)[-1]
    top = jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = [s.getPath() for s in fs.listStatus(top) if s.getPath().getName().startswith("version=") and s.getPath().getName() != current]
    for path in gone:
        fs.delete(path, True)
    return [p.toString() for p in gone]


# -- day tables ----------------------------------------------------------------------
def _dynamic(df: DataFrame, path: str, day: str) -> None:
    """Replace the days ``df`` has rows of; other days are not touched."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def append_batch(df: DataFrame, path: str, batch_id: object, day: str, column: str = "batch_id") -> None:
    """Add a batch to a table of day folders; a retry replaces what an earlier try left.

    The first time rows are appended. If the table holds rows of the batch, the days they lie in and the new rows' days are written again without them. A day of which nothing would be left keeps one
    row of nulls but for its day, which ``read_days`` leaves out, because a folder is replaced only by rows.
    """
    spark = df.sparkSession
    rows = df.withColumn(column, F.lit(batch_id).cast("string"))
    there = spark.read.schema(rows.schema).parquet(path) if exists(spark, path) else None
    left = None if there is None else there.where(F.col(column) == str(batch_id))
    if left is None or left.isEmpty():
        rows.write.mode("append").partitionBy(day).parquet(path)
        return
    days = left.select(day).unionByName(rows.select(day)).distinct()
    mark = days.select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name != day else F.col(day) for f in rows.schema])
    others = there.join(days, day, "left_semi").where(F.coalesce(F.col(column) != str(batch_id), F.lit(False)))
    _dynamic(reduce(DataFrame.unionByName, [others, rows, mark]), path, day)


def read_days(spark: SparkSession, path: str, schema, column: str = "batch_id") -> DataFrame:
    """The rows of a table ``append_batch`` writes."""
    return spark.read.schema(schema).parquet(path).where(F.col(column).isNotNull())


def small_files(rows: DataFrame, day: str, below: int) -> DataFrame:
    """Days of a Parquet frame that lie in two or more files smaller than ``below`` bytes: day, files, bytes. File names and sizes come from the scan's metadata; no data page is read."""
    files = rows.select(day, F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")).distinct()
    return files.where(F.col("size") < below).groupBy(day).agg(F.count("*").alias("files"), F.sum("size").alias("bytes")).where("files > 1")


def compact(spark: SparkSession, path: str, schema, day: str, before: str, below: int = 64 << 20, sort_by: Sequence[str] = (), column: str = "batch_id") -> DataFrame:
    """Write the days before ``before`` that lie in many small files again, as few files sorted by ``sort_by``; returns the days with their number of files and bytes before.

    Each of those days is replaced by its own rows. A day whose batches may still be retried is not closed: choose ``before`` accordingly.
    """
    table = spark.read.schema(schema).parquet(path)
    chosen = small_files(table.where(F.col(day) < F.lit(before).cast("date")), day, below).collect()  # one row for each such day
    found = spark.createDataFrame([tuple(r) for r in chosen], f"`{day}` date, files bigint, bytes bigint")
    if chosen:
        closed = table.where(F.col(day).isin([r[day] for r in chosen]) & F.col(column).isNotNull())
        order = [day, *(sort_by or [column])]
        _dynamic(closed.repartitionByRange(*order).sortWithinPartitions(*order), path, day)
    return found

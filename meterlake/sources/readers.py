"""Sources: CSV trees, Parquet, event streams."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake import schemas
from meterlake.functions import now


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (or glob) exists, on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop_path)
    return bool(found)


def _first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a text file, read from its first block only; None if the file is empty."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
    try:
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, jvm.java.nio.charset.StandardCharsets.UTF_8)).readLine()
    finally:
        stream.close()


def _by_header(spark: SparkSession, files: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by the names in their header line. One line of each file is looked at, several files at a time; what is kept is one list of names for each distinct header."""
    with ThreadPoolExecutor(max_workers=16) as pool:
        lines = pool.map(lambda f: _first_line(spark, f), files)
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines, strict=True):
        if line is not None:
            names = next(csv.reader([line.removeprefix("\ufeff")], escapechar="\\"), [])
            groups.setdefault(tuple(n.strip() for n in names), []).append(file)
    return groups


def _read_csv(spark: SparkSession, files: Sequence[str], schema: T.StructType, multi_line: bool) -> DataFrame:
    """CSV files as typed columns, each read by its own header with the engine's CSV reader: one scan for all files of a header.

    Columns a file lacks are NULL, columns the schema lacks are left out, a value that does not fit its type is NULL. A row with another number of fields than its header keeps its text in
    ``corrupt_record`` and has no values; so does every row of a file whose header names no column of the schema. Fields are counted in every row, so the parser does not leave out columns.
    """
    frames = []
    for header, own in _by_header(spark, files).items():
        known = [n if n in schema.names and n not in header[:i] else f"__extra_{i}" for i, n in enumerate(header)]
        corrupt = F.col(schemas.CORRUPT)
        if not set(known) & set(schema.names):
            rows = spark.read.text(own).withColumnRenamed("value", schemas.CORRUPT)
        else:
            fields = [T.StructField(n, T.StringType()) for n in [*known, schemas.CORRUPT]]
            rows = spark.read.schema(T.StructType(fields)).options(header=True, multiLine=multi_line, columnNameOfCorruptRecord=schemas.CORRUPT, recursiveFileLookup=True, columnPruning=False).csv(own)
        values = [F.when(corrupt.isNull(), F.col(f.name).try_cast(f.dataType)) if f.name in rows.columns else F.lit(None).cast(f.dataType) for f in schema]
        beside = next((f for f in schema.names if f in rows.columns), None)  # the reader gives the raw text only along with a column
        text = corrupt if beside is None else F.when(F.coalesce(F.length(beside), F.lit(0)) >= 0, corrupt)
        frames.append(rows.select(*[v.alias(n) for v, n in zip(values, schema.names, strict=True)], text.alias(schemas.CORRUPT)))
    empty = T.StructType([*schema, T.StructField(schemas.CORRUPT, T.StringType())])
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], empty)


def read_csv_tree(spark: SparkSession, root: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """All ``*.csv`` files below ``root`` by their headers, with ``corrupt_record``. Folder names such as ``year=2024`` do not become columns.

    ``multi_line`` allows line breaks inside quotes; such a file is not split among tasks.
    """
    if not exists(spark, root):
        raise FileNotFoundError(f"no such folder: {root}")
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(root).inputFiles()
    if not files:
        raise FileNotFoundError(f"no CSV file below {root}")
    return _read_csv(spark, files, schema, multi_line)


def read_csv_file(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """One CSV file, or a folder of its parts, by header, with ``corrupt_record``."""
    if not exists(spark, path):
        raise FileNotFoundError(f"no such file: {path}")
    return _read_csv(spark, spark.read.text(path).inputFiles(), schema, multi_line)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def values_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """Constant rows as a table."""
    return spark.createDataFrame(list(rows), schema)


def list_views(spark: SparkSession, prefix: str = "") -> DataFrame:
    """The session's temporary views, by name."""
    names = sorted(t.name for t in spark.catalog.listTables() if t.isTemporary and t.name.startswith(prefix))
    return spark.createDataFrame([(n,) for n in names], "view_name string")


# Source labels written into the envelope.
FILE_SOURCE_SYSTEM, KAFKA_SOURCE_SYSTEM = "local_file_stream", "eventhubs_emulator_kafka"


# -- streams ----------------------------------------------------------------------
def text_event_stream(spark: SparkSession, path: str, source_system: str = FILE_SOURCE_SYSTEM,
                      as_of: str | None = None, max_files: int | None = None) -> DataFrame:
    """JSON lines landing as text files, wrapped in the bronze envelope."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select(
        F.col("value").alias("raw_event_payload"),
        now(as_of).alias("ingestion_timestamp"),
        F.lit(source_system).alias("source_system"),
        F.lit(None).cast("string").alias("partition_id"),
        F.lit(None).cast("string").alias("offset"),
        F.col("_metadata.file_path").alias("producer_metadata"),
    )


def bronze_event_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Bronze envelopes already captured as Parquet."""
    reader = spark.readStream.schema(schemas.ENVELOPE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def kafka_options(servers: str, topic: str, connection_string: str | None = None,
                  starting_offsets: str = "latest", protocol: str = "SASL_PLAINTEXT") -> dict[str, str]:
    """Reader options for a Kafka-compatible topic; a connection string adds a SASL PLAIN login."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting_offsets}
    if connection_string:
        login = "org.apache.kafka.common.security.plain.PlainLoginModule"
        options |= {
            "kafka.security.protocol": protocol,
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": f'{login} required username="$ConnectionString" password="{connection_string}";',
        }
    return options


def kafka_to_envelope(records: DataFrame, source_system: str = KAFKA_SOURCE_SYSTEM, as_of: str | None = None) -> DataFrame:
    """Kafka records to bronze envelopes; topic, time and time type go into the metadata JSON."""
    return records.select(
        F.col("value").cast("string").alias("raw_event_payload"),
        now(as_of).alias("ingestion_timestamp"),
        F.lit(source_system).alias("source_system"),
        F.col("partition").cast("string").alias("partition_id"),
        F.col("offset").cast("string").alias("offset"),
        F.to_json(F.struct(
            "topic", F.col("timestamp").cast("string").alias("kafka_timestamp"),
            F.col("timestampType").alias("timestamp_type"),
        )).alias("producer_metadata"),
    )


def kafka_event_stream(spark: SparkSession, options: Mapping[str, str], as_of: str | None = None) -> DataFrame:
    """A Kafka-compatible topic as bronze envelopes (needs the Kafka connector on the class path)."""
    return kafka_to_envelope(spark.readStream.format("kafka").options(**options).load(), as_of=as_of)


def event_stream(spark: SparkSession, fmt: str, source: str | Mapping[str, str], **options) -> DataFrame:
    """A stream of bronze envelopes from ``json_landing``, ``bronze_parquet`` or ``kafka``."""
    builders = {
        "json_landing": text_event_stream, "bronze_parquet": bronze_event_stream, "kafka": kafka_event_stream}
    if fmt not in builders:
        raise ValueError(f"unknown stream format {fmt!r}; use one of {sorted(builders)}")
    return builders[fmt](spark, source, **options)

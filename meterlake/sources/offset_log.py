"""Landed logs as a stream by partition and offset: where a broker's topic was copied to files, it is read as the topic itself would be.

A log lies below one folder as Parquet: ``partition=K/segment=S`` holds the offsets from S * segment_rows on (``land_log``). The stream's position is one next offset for each partition, kept in Spark's checkpoint, so a restart goes on
exactly where the last batch ended. The driver looks at folder names and the footers of each partition's last segment; records are read by the tasks: one for each segment
that a batch touches, or, where those are many and small, one for several that follow each other.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "offset_log"
SCHEMA = "topic string, partition int, offset bigint, timestamp timestamp, timestampType int, value string"
_COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
SEGMENT_ROWS = 100_000
_MANY = 128  # pieces of a batch above which small ones share a task


def land_log(records: DataFrame, path: str, segment_rows: int = SEGMENT_ROWS) -> None:
    """Append records (``SCHEMA``; a value in bytes becomes text) to the log. Each offset of a partition must be landed once."""
    rows = records.select(*[F.col(c).cast("string" if c == "value" else records.schema[c].dataType).alias(c) for c in _COLUMNS])
    placed = rows.withColumn("segment", F.floor(F.col("offset") / segment_rows)).repartition("partition", "segment").sortWithinPartitions("partition", "segment", "offset")
    placed.write.mode("append").partitionBy("partition", "segment").parquet(path)


class Piece(NamedTuple):
    """Offsets from ``start`` up to but not including ``end``: those of one segment, or (``shared``) of several from ``segment`` on."""

    partition: int
    segment: int
    start: int
    end: int


def pieces(start: Mapping[str, int], end: Mapping[str, int], segment_rows: int) -> list[Piece]:
    """What lies between two positions, cut at segments. A partition that is new starts at its first offset."""
    found = []
    for partition, upto in end.items():
        at = start.get(partition, 0)
        while at < upto:
            segment = at // segment_rows
            stop = min(upto, (segment + 1) * segment_rows)
            found.append(Piece(int(partition), segment, at, stop))
            at = stop
    return found


def shared(found: Sequence[Piece], segment_rows: int) -> list[Piece]:
    """Pieces as tasks: neighbours of one partition together, so that few segments have a task each and many small ones don't pay for one each. A task gets ``SEGMENT_ROWS`` offsets at most, or one segment."""
    together = max(1, min(-(-len(found) // _MANY), SEGMENT_ROWS // segment_rows))
    tasks: list[Piece] = []
    for piece in found:
        last = tasks[-1] if tasks else None
        if last and last.partition == piece.partition and last.end == piece.start and piece.segment - last.segment < together:
            tasks[-1] = last._replace(end=piece.end)
        else:
            tasks.append(piece)
    return tasks


class OffsetLog(DataSource):
    """Options: ``path``, ``segmentRows``, ``startingOffsets`` (``earliest``, ``latest`` or JSON such as {"0": 17}: the first offset to read) and ``endingOffsets`` (JSON: the first one not to read)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> OffsetLogReader:  # noqa: N802
        return OffsetLogReader(dict(self.options))


class OffsetLogReader(DataSourceStreamReader):
    def __init__(self, options: Mapping[str, str]):
        given = {k.lower(): v for k, v in options.items()}
        self.path, self.segment_rows = given["path"], int(given.get("segmentrows", SEGMENT_ROWS))
        self.starting, self.ending = given.get("startingoffsets", "earliest"), json.loads(given.get("endingoffsets", "{}"))

    def _folder(self) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(self.path if "://" in self.path or self.path.startswith("file:") else f"file://{self.path}")

    def _named(self, fs: pafs.FileSystem, folder: str, name: str) -> list[int]:
        entries = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
        return sorted(int(e.base_name.partition("=")[2]) for e in entries if e.base_name.startswith(f"{name}="))

    def _next(self) -> dict[str, int]:
        """The next offset of each partition, from the statistics of its last segment's files."""
        fs, top = self._folder()
        position = {}
        for partition in self._named(fs, top, "partition"):
            own = f"{top}/partition={partition}"
            last = self._named(fs, own, "segment")[-1]
            highest = -1
            for file in fs.get_file_info(pafs.FileSelector(f"{own}/segment={last}")):
                if file.extension == "parquet":
                    meta = pq.read_metadata(file.path, filesystem=fs)
                    at = meta.schema.names.index("offset")
                    highest = max([highest, *[meta.row_group(g).column(at).statistics.max for g in range(meta.num_row_groups) if meta.row_group(g).num_rows]])
            position[str(partition)] = highest + 1
        return position

    def initialOffset(self) -> dict:  # noqa: N802
        if self.starting == "latest":
            return self._next()
        return {} if self.starting == "earliest" else json.loads(self.starting)

    def latestOffset(self) -> dict:  # noqa: N802
        return {p: min(n, self.ending.get(p, n)) for p, n in self._next().items()}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return [InputPartition(tuple(piece)) for piece in shared(pieces(start, end, self.segment_rows), self.segment_rows)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        piece = Piece(*partition.value)
        fs, top = self._folder()
        stored = [c for c in _COLUMNS if c != "partition"]
        for part in pieces({str(piece.partition): piece.start}, {str(piece.partition): piece.end}, self.segment_rows):
            rows = pads.dataset(f"{top}/partition={part.partition}/segment={part.segment}", filesystem=fs, format="parquet", exclude_invalid_files=True)
            wanted = (pads.field("offset") >= part.start) & (pads.field("offset") < part.end)
            for batch in rows.to_batches(columns=stored, filter=wanted):
                columns = {c: batch.column(c) for c in stored} | {"partition": pa.array([piece.partition] * batch.num_rows, pa.int32())}
                columns["timestamp"] = columns["timestamp"].cast(pa.timestamp("us", "UTC"))
                yield pa.RecordBatch.from_arrays([columns[c] for c in _COLUMNS], names=_COLUMNS)

    def commit(self, end: dict) -> None: ...


def offset_log_stream(
    spark: SparkSession, path: str, starting: str | Mapping[str, int] = "earliest", ending: Mapping[str, int] | None = None, segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """A landed log as a stream of ``SCHEMA``; ``readers.kafka_to_envelope`` makes bronze envelopes of it."""
    spark.dataSource.register(OffsetLog)
    reader = spark.readStream.format(FORMAT).option("segmentRows", segment_rows).option("startingOffsets", starting if isinstance(starting, str) else json.dumps(dict(starting)))
    if ending is not None:
        reader = reader.option("endingOffsets", json.dumps(dict(ending)))
    return reader.load(path)

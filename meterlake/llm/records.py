"""Token sequences as length-delimited binary records with masked checksums, and an offset index for shuffled reads.

A shard file is a run of records: length (8 bytes), masked checksum of the length (4), payload, masked checksum of the payload (4),
all little-endian. The payload is a sequence of unsigned token ids, 2 bytes each where the vocabulary fits, else 4. Its index
file has one fixed row for each record: document id, whether the id is null, offset of the record, first token's place in the shard.
Checksums are crc32 rotated right by 15 bits plus a constant, so that a checksum stored inside data that is itself checked does no harm.

Nulls count as empty texts: their record holds the end id alone. A null id sorts first. Rows with equal ids are ordered by a hash of their text, equal
rows lie side by side. An empty table gives no records.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from meterlake.llm.common import full_text, kept, slices, table
from meterlake.llm.tokens import encoder
from meterlake.session import scratch_path

_MASK = 0xA282EAD8  # fixed value of the format
_INDEX = np.dtype([("id", "<i8"), ("null", "u1"), ("offset", "<u8"), ("start", "<u8")])


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return size + struct.pack("<I", masked(size)) + payload + struct.pack("<I", masked(payload))


def unframe(read, at: str) -> bytes:
    """The next record from ``read(n)``; ValueError when a length or checksum is wrong."""
    head = read(12)
    if len(head) != 12 or struct.unpack("<I", head[8:])[0] != masked(head[:8]):
        raise ValueError(f"{at}: broken length")
    (size,) = struct.unpack("<Q", head[:8])
    body = read(size + 4)
    if len(body) != size + 4 or struct.unpack("<I", body[size:])[0] != masked(body[:size]):
        raise ValueError(f"{at}: broken record")
    return body[:size]


def _files(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int, shards: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes shards in ascending id order; returns one row per shard: shard, path, width, records, tokens, start.

    ``folder`` is one all executors share. A task writes under a name of its own and renames at the end, so a task that is run again after
    a lost executor, or twice at once, leaves one whole shard; the returned rows name the files that count.
    """
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base, root = _files(folder)
    base.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokens = encoder(tokenizer)
        kind = "<u2" if tokens.vocabulary <= 1 << 16 else "<u4"
        fs, top = _files(folder)
        own = f"{top}/shard-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        index: list[tuple] = []
        offset = start = 0
        with fs.open_output_stream(f"{own}.tmp") as out, fs.open_output_stream(f"{own}.index.tmp") as ind:
            for part in batches:
                for piece in slices([part], "text"):
                    rows = []
                    for i, ids in zip(piece.column("id").to_pylist(), tokens.encode([x or "" for x in piece.column("text").to_pylist()]), strict=True):
                        record = frame(np.append(ids, np.uint32(end_id)).astype(kind).tobytes())
                        out.write(record)
                        rows.append((i or 0, i is None, offset, start))
                        offset += len(record)
                        start += len(ids) + 1
                    ind.write(np.array(rows, _INDEX).tobytes())
                    index.append(len(rows))
        if not index:
            fs.delete_file(f"{own}.tmp"), fs.delete_file(f"{own}.index.tmp")
            return
        fs.move(f"{own}.index.tmp", f"{own}.index")
        fs.move(f"{own}.tmp", f"{own}.records")
        yield pa.RecordBatch.from_pydict({"shard": [TaskContext.get().partitionId()], "path": [own.removeprefix(top).lstrip("/")], "width": [int(kind[-1])], "records": [sum(index)], "tokens": [start]})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), full_text(text_col).alias("text")).withColumn("tie", F.xxhash64("text"))
    made = kept(rows.repartitionByRange(shards, "id", "tie").sortWithinPartitions("id", "tie").mapInArrow(write, "shard long, path string, width long, records long, tokens long"))
    before = F.sum("tokens").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))  # one row per shard file
    return made.withColumn("start", F.coalesce(before, F.lit(0)))


def read_index(spark: SparkSession, folder: str, shards: DataFrame) -> DataFrame:
    """One row per record: path, width, id, offset, first token in the shard and in all shards; for shuffled or partial reads."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = _files(folder)
        for part in batches:
            for path, width, start in zip(*(part.column(c).to_pylist() for c in ("path", "width", "start"))):
                with fs.open_input_stream(f"{top}/{path}.index") as f:
                    while block := f.read(_INDEX.itemsize * 50_000):
                        x = np.frombuffer(block, _INDEX)
                        yield pa.RecordBatch.from_pydict({
                            "path": [path] * len(x), "width": pa.array(np.full(len(x), width, np.int64)), "id": pa.array(x["id"], mask=x["null"] == 1),
                            "offset": pa.array(x["offset"].astype(np.int64)), "start": pa.array(x["start"].astype(np.int64) + start)})

    return _spread(shards).mapInArrow(read, "path string, width long, id long, offset long, start long")


def read_at(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """The records that rows of ``read_index`` name, in any order or choice: id, start, ids (unsigned 32-bit)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = _files(folder)
        opened: tuple[str, pa.NativeFile] | None = None
        for part in (p.slice(k, 500) for p in batches for k in range(0, p.num_rows, 500)):
            ids = []
            for path, width, at in zip(*(part.column(c).to_pylist() for c in ("path", "width", "offset"))):
                if opened is None or opened[0] != path:
                    if opened:
                        opened[1].close()
                    opened = path, fs.open_input_file(f"{top}/{path}.records")
                opened[1].seek(at)
                ids.append(np.frombuffer(unframe(opened[1].read, f"{path} at {at}"), f"<u{width}").astype("<u4").tobytes())
            yield pa.RecordBatch.from_pydict({"id": part.column("id"), "start": part.column("start"), "ids": pa.array(ids, pa.binary())})
        if opened:
            opened[1].close()

    return index.mapInArrow(read, "id long, start long, ids binary")


def shuffled(index: DataFrame, seed: int) -> DataFrame:
    """Index rows in an order that depends on the seed alone."""
    key = F.xxhash64(F.lit(seed), "path", "offset")
    return index.orderBy(key, "path", "offset")


def _spread(shards: DataFrame) -> DataFrame:
    """One task per shard or so: a shard row is a file name, and the work is in the file."""
    return shards.repartition(int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions")), "shard")


def op6(spark: SparkSession, sf_dir: str, tokenizer: str) -> DataFrame:
    folder = scratch_path(spark, "records")
    shards = write_records(table(spark, sf_dir, "documents"), folder, tokenizer, end_id=2)
    found = read_at(spark, folder, read_index(spark, folder, shards))
    return found.select(
        F.col("id").alias("doc_id"), "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))

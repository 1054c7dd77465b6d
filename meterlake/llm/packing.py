"""Best-fit decreasing packing of tokenised documents into sequences of fixed capacity.

Best fit needs only the lengths, and there are at most ``capacity`` of them. So Spark counts pieces by length, the driver packs
those counts (a segment tree over remaining capacities finds the tightest open bin in logarithmic time; equal bins are kept as one group), and the plan of
at most a few thousand rows tells each piece, by its rank among pieces of its length, its sequence and offset. The packing is the one best-fit
decreasing makes of all pieces at once, whatever the number of partitions.

Nulls count as empty texts: one piece with the end id. Equal rows are packed each for itself. An empty table packs into nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from meterlake.llm.common import slices, table, written
from meterlake.llm.tokens import encoder


class OpenBins:
    """Segment tree over capacities 0..top: how many groups of open bins have each remaining capacity."""

    def __init__(self, top: int):
        self.size = 1
        while self.size <= top:
            self.size *= 2
        self.any = [False] * (2 * self.size)

    def mark(self, room: int, there: bool) -> None:
        at = room + self.size
        self.any[at] = there
        while at > 1:
            at //= 2
            self.any[at] = self.any[2 * at] or self.any[2 * at + 1]

    def tightest(self, need: int) -> int | None:
        """The least remaining capacity of ``need`` or more among open bins."""
        at = need + self.size
        if self.any[at]:
            return need
        while at > 1:
            if at % 2 == 0 and self.any[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.any[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return None


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, first bin, pieces in a bin, offset) that place ``counts[length]`` pieces.

    Piece number ``rank`` of its length, in the run that starts at ``first``, lies in bin ``first bin + (rank - first) // pieces`` at
    ``offset + (rank - first) % pieces * length``. Bins of equal room are interchangeable, so they are filled group by group: a bin that has
    just taken a piece stays the tightest one while it has room for another.
    """
    tree = OpenBins(capacity)
    groups: dict[int, list[tuple[int, int]]] = {}
    runs, bins = [], 0

    def put(room: int, first: int, n: int) -> None:
        if room > 0 and n > 0:
            groups.setdefault(room, []).append((first, n))
            tree.mark(room, True)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left > 0:
            room = tree.tightest(length)
            if room is None:
                room, per = capacity, capacity // length
                first, n = bins, -(-left // per)
                bins += n
            else:
                per = room // length
                first, n = groups[room].pop()
                if not groups[room]:
                    tree.mark(room, False)
            full = min(n, left // per)
            if full:
                runs.append((length, rank, first, per, capacity - room))
                put(room - per * length, first, full)
                rank, left = rank + full * per, left - full * per
            if full < n:
                if left > 0:  # fewer than fill one more bin
                    runs.append((length, rank, first + full, per, capacity - room))
                    put(room - left * length, first + full, 1)
                    rank, left, full = rank + left, 0, full + 1
                put(room, first + full, n - full)
    return runs


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids (unsigned, 2 bytes each where the vocabulary fits, else 4), and (task, rank): the piece's number among those of its length in its task.

    A document longer than the capacity is cut into whole pieces from its end, so only its first piece may be shorter.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokens, task = encoder(tokenizer), TaskContext.get().partitionId()
        kind = "<u2" if max(tokens.vocabulary, end_id + 1) <= 1 << 16 else "<u4"
        seen = np.zeros(capacity + 1, np.int64)
        for part in slices(batches, "text"):
            rows: dict[str, list] = {c: [] for c in ("doc_id", "piece", "start", "length", "ids", "rank")}
            for i, ids in zip(part.column("id").to_pylist(), tokens.encode([x or "" for x in part.column("text").to_pylist()]), strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype(kind, copy=False)
                short = len(ids) % capacity
                for k, at in enumerate([0, *range(short, len(ids), capacity)] if short else range(0, len(ids), capacity)):
                    own = ids[at : short if short and k == 0 else at + capacity]
                    for c, v in zip(rows, (i, k, at, len(own), own.tobytes(), int(seen[len(own)]))):
                        rows[c].append(v)
                    seen[len(own)] += 1
            if rows["piece"]:
                yield pa.RecordBatch.from_pydict(rows | {"task": [task] * len(rows["piece"])}, schema=_PIECES)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids binary, rank long, task long")


_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("rank", pa.int64()), ("task", pa.int64())])


def pack(cut: DataFrame, capacity: int) -> DataFrame:
    """The rows of a stored ``pieces`` table with sequence_id and offset instead of rank and task, and ids of 4 bytes.

    Pieces are read twice: their lengths are counted by task, which gives each task its first rank of every length; then each
    piece is placed by its rank. To the driver come at most ``capacity`` counts.
    """
    spark = cut.sparkSession
    by_task = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    first = F.sum("n").over(W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1))
    offsets = by_task.select("task", "length", F.coalesce(first, F.lit(0)).alias("before"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = np.array(best_fit(counts, capacity), np.int64).reshape(-1, 5)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    lengths = runs[:, 0] * (1 << 48) + runs[:, 1]  # one ascending key of length and first rank

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p.slice(k, 1_000) for p in batches for k in range(0, p.num_rows, 1_000)):
            length, rank = (part.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            run = runs[np.searchsorted(lengths, length * (1 << 48) + rank, "right") - 1] if len(length) else np.zeros((0, 5), np.int64)
            into = rank - run[:, 1]
            kept = {c: part.column(c) for c in ("doc_id", "piece", "start", "length")}
            kept["ids"] = [np.frombuffer(x, f"<u{len(x) // n}").astype("<u4").tobytes() for x, n in zip(part.column("ids").to_pylist(), length.tolist())]
            yield pa.RecordBatch.from_pydict(kept | {"sequence_id": run[:, 2] + into // run[:, 3], "offset": run[:, 4] + into % run[:, 3] * length})

    ranked = cut.join(offsets, ["task", "length"]).withColumn("rank", F.col("rank") + F.col("before")).drop("before", "task")
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long")


def packed(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """Documents to placed pieces; see the module's text."""
    return pack(written(pieces(docs, tokenizer, end_id, capacity), "pieces"), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed rows themselves: sequence_id, ids of the whole sequence, and the documents in it with their offsets."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"), F.transform("p", lambda x: F.struct(x["offset"], x["doc_id"], x["piece"])).alias("parts"))


def op10_columns(placed: DataFrame) -> DataFrame:
    return placed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op10(spark: SparkSession, sf_dir: str, tokenizer: str) -> DataFrame:
    return op10_columns(packed(table(spark, sf_dir, "documents"), tokenizer))

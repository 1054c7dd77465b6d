"""Repair of a conversation's structure with the fewest edits, streamed turn by turn.

A good conversation has the role initials ``(s?(ua)+)?``. Edits of a row: K keeps it (0), R gives it the role user or assistant (3), D deletes it (4); I inserts a user or an assistant turn with an empty text
anywhere (3). Rows that are blank or repeat an earlier row must be deleted; a truncated row that stays costs 3 more. Of the cheapest edits, those whose initials are the least string in ASCII are taken.

Spark deals the rows out by conversation and sorts them by turn (nulls first), then role and text; no task holds a conversation. The program over four states (nothing yet, after s, after u, after a) carries
for each state the cheapest cost so far and the rank of its edits among the others'; at the end of every row the candidates end with that row's own edit, so none is the beginning of another and ranks are
all a comparison needs. Its state goes from one Arrow batch to the next. What led to each state is one byte for each state and row; beyond SPILL bytes these go to a file in the shared folder, and are
read backwards, block by block, when the conversation ends. A second pass over the same order applies the edits and puts out the repaired turns as it reads. Bounds of a task: SPILL, and a conversation's edits as one string (a byte a row).

A null text or role counts as one space, so its row is blank or has no good role. Rows of the same turn are ordered by role and text; null conversations are one conversation, whose id is null. The role's first character is its initial; an empty role has none
that fits. Extra columns don't matter; no rows give no conversations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.llm.common import scratch_path, table, written

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3
SPILL = 1 << 22  # bytes of backpointers a task holds
NOTHING, AFTER_S, AFTER_U, AFTER_A = range(4)
GOOD_END = (NOTHING, AFTER_A)
_INSERTED = {NOTHING: AFTER_U, AFTER_S: AFTER_U, AFTER_U: AFTER_A, AFTER_A: AFTER_U}  # also where a row goes that is given a role
_KEPT = {"s": {NOTHING: AFTER_S}, "u": {NOTHING: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U}, "a": {AFTER_U: AFTER_A}}
_NAME = {AFTER_U: "user", AFTER_A: "assistant"}
_MOST_INSERTS = 2  # a third one leads where the first did
FINE, TRUNCATED, GONE = range(3)  # of a row: nothing to add, costs more if it stays, has to go
VISIBLE = r"[^\x20\x09-\x0D]"


def _inserts(state: int) -> Iterator[tuple[int, int]]:
    """(number of turns inserted, state after them)."""
    for n in range(_MOST_INSERTS + 1):
        yield n, state
        state = _INSERTED[state]


def _edges(initial: str, fault: int) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, edits) for a row of this kind, turns inserted before it included."""
    out = []
    for start in range(4):
        for n, state in _inserts(start):
            base, edits = n * COST[INSERT], INSERT * n
            out.append((start, state, base + COST[DELETE], edits + DELETE))
            if fault != GONE:
                stays = base + (TRUNCATED_COST if fault == TRUNCATED else 0)
                out.append((start, _INSERTED[state], stays + COST[REROLE], edits + REROLE))
                if state in _KEPT.get(initial, {}):
                    out.append((start, _KEPT[initial][state], stays + COST[KEEP], edits + KEEP))
    return out


_EDITS = sorted({e for initial in "sua?" for fault in range(3) for *_, e in _edges(initial, fault)})
_CODE = {(start, e): 1 + start * len(_EDITS) + k for start in range(4) for k, e in enumerate(_EDITS)}  # fits one byte; 0: state can't be reached
_STEP = {code: (start, e) for (start, e), code in _CODE.items()}

# A survivor of each state: (cost above the cheapest, rank), or None. Few such tuples ever occur, so steps are remembered.
Front = tuple
START: Front = ((0, 0), None, None, None)


class _Steps(dict):
    """(front, initial, fault) -> (next front, added cost, one backpointer byte for each state)."""

    def __missing__(self, key):
        front, initial, fault = key
        best: list = [None] * 4
        for start, to, cost, edits in _edges(initial, fault):
            if front[start] is not None:
                at = (front[start][0] + cost, front[start][1], edits, start)
                if best[to] is None or at < best[to]:
                    best[to] = at
        low = min(b[0] for b in best if b)
        order = {b[1:3]: k for k, b in enumerate(sorted((b for b in best if b), key=lambda b: b[1:3]))}
        ahead = tuple(None if b is None else (b[0] - low, order[b[1:3]]) for b in best)
        back = bytes(0 if b is None else _CODE[b[3], b[2]] for b in best)
        self[key] = ahead, low, back
        return self[key]


class Backpointers:
    """Bytes written forwards, four a row, and read backwards; all but the last SPILL bytes are in a file."""

    def __init__(self, place: Callable[[], tuple], spill: int = SPILL):
        self.place, self.spill, self.held, self.file = place, spill, bytearray(), None

    def add(self, row: bytes) -> None:
        self.held += row
        if len(self.held) >= self.spill:
            if self.file is None:
                self.fs, self.path = self.place()
                self.file, self.written = self.fs.open_output_stream(self.path), 0
            self.file.write(self.held)
            self.written += len(self.held)
            self.held = bytearray()

    def backwards(self) -> Iterator[bytes]:
        yield from self._rows(self.held)
        if self.file is not None:
            self.file.close()
            with self.fs.open_input_file(self.path) as file:
                end = self.written
                while end:
                    start = max(0, end - self.spill // 4 * 4)
                    file.seek(start)
                    yield from self._rows(file.read(end - start))
                    end = start
            self.fs.delete_file(self.path)

    @staticmethod
    def _rows(block: bytes) -> Iterator[bytes]:
        for k in range(len(block) - 4, -1, -4):
            yield block[k : k + 4]


class Repair:
    """The program over one conversation: rows in order, then the cheapest edits."""

    steps = _Steps()

    def __init__(self, place: Callable[[], tuple] | None = None, spill: int = SPILL):
        self.front, self.cost, self.back = START, 0, Backpointers(place, spill)

    def add(self, initial: str, fault: int) -> None:
        self.front, more, back = self.steps[self.front, initial if initial in _KEPT else "?", fault]
        self.cost += more
        self.back.add(back)

    def edits(self) -> tuple[int, str]:
        """(cost, edits), with the turns inserted at the end."""
        last = min(
            (self.front[state][0] + n * COST[INSERT], self.front[state][1], INSERT * n, state)
            for state in range(4) if self.front[state] is not None for n, end in _inserts(state) if end in GOOD_END)
        state, parts = last[3], [last[2]]
        for row in self.back.backwards():
            state, edits = _STEP[row[state]]
            parts.append(edits)
        return self.cost + last[0], "".join(reversed(parts))


def _spaced(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def prepared(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of a table of turns (nulls: one space), and ``there``, true."""
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), _spaced("role").alias("role"), _spaced("text").alias("text"), F.lit(True).alias("there"))


def damaged(turns: DataFrame) -> DataFrame:
    """``prepared`` rows after the damage a checksum of conversation and turn chooses. A row that is dropped stays as one that is not ``there``, so its conversation is not lost."""
    kind = F.crc32(F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).when(kind == 0, "").otherwise(F.col("text"))
    rows = prepared(turns).select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (kind != 0).alias("there"), F.when(kind == 3, 2).otherwise(1).alias("times"))
    return rows.select("conv_id", "turn", "role", "text", "there", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("again")).drop("again")


_ORDER = ["conv_id", "turn", "role", "text"]  # nulls first, as ascending order has them


def judged(rows: DataFrame) -> DataFrame:
    """The rows dealt out by conversation and in order, each with its ``initial`` and first fault: ``blank``, ``duplicate``, ``truncated`` or none.

    Equal rows of a conversation are found where it was dealt to, by a sort on the text's hash, so texts shuffle once. Rows that are not there have no fault and are nobody's earlier row.
    """
    again = F.row_number().over(Window.partitionBy("conv_id", "there", "role", F.sha2(F.col("text").cast("binary"), 256)).orderBy(F.col("turn").asc_nulls_first())) > 1
    last = F.regexp_extract("text", rf"({VISIBLE})[\x20\x09-\x0D]*\z", 1)
    fault = (
        F.when(~F.col("there"), F.lit(None)).when(last == "", "blank").when(again, "duplicate").when(~last.isin(".", "!", "?"), "truncated")
    )
    return (
        rows.repartition("conv_id").withColumn("fault", fault).withColumn("initial", F.substring("role", 1, 1))
        .select("conv_id", "turn", "role", "text", "there", "fault", "initial").sortWithinPartitions(*_ORDER, F.coalesce(F.col("fault") == "duplicate", F.lit(False)))
    )


def _spill_place(folder: str) -> Callable[[], tuple]:
    """Where a task's backpointers go: a file of its own in the shared folder."""
    def place() -> tuple:
        import uuid

        from pyarrow import fs

        where, path = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        where.create_dir(path, recursive=True)
        return where, f"{path}/{uuid.uuid4().hex}"

    return place


_SUMMARY = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_LEGAL = {"su", "ua", "au"}


def audits(rows: DataFrame, spill: int = SPILL) -> DataFrame:
    """One row for each conversation of ``prepared`` or ``damaged`` rows: gaps, faults, illegal neighbours, cost, audit (the edits' initials)."""
    place = _spill_place(scratch_path(rows.sparkSession, "backpointers"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, done = None, []

        for part in batches:
            for conv, turn, initial, fault, there in zip(part["conv_id"], part["turn"], part["initial"], part["fault"], part["there"]):
                conv, turn = (None if x is None else int(x) for x in (conv, turn))
                if current is None or current.conv != conv:
                    if current is not None:
                        done.append(current.row())
                    current = _Conversation(conv, place, spill)
                if there:
                    current.add(turn, initial, fault)
            if done:
                yield pd.DataFrame(done, columns=columns).astype(kinds)
                done = []
        if current is not None:
            yield pd.DataFrame([current.row()], columns=columns).astype(kinds)

    columns = [c.split()[0] for c in _SUMMARY.split(", ")]
    kinds = {c: "Int64" for c in columns[:-1]}
    narrow = judged(rows).select(F.col("conv_id").cast("string"), F.col("turn").cast("string"), "initial", "fault", "there")  # as text: pandas has no long with nulls
    return narrow.mapInPandas(run, _SUMMARY)


class _Conversation:
    def __init__(self, conv: int | None, place: Callable[[], tuple], spill: int):
        self.conv, self.repair = conv, Repair(place, spill)
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.before = 0, None
        self.first = self.last = None
        self.turns = 0

    def add(self, turn: int | None, initial: str, fault: str | None) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        if fault is not None:
            self.faults[fault] += 1
        if self.before is not None and self.before + initial not in _LEGAL:
            self.illegal += 1
        self.before = initial
        self.repair.add(initial, TRUNCATED if fault == "truncated" else FINE if fault is None else GONE)

    def row(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        cost, edits = self.repair.edits()
        return (self.conv, gaps, *self.faults.values(), self.illegal, cost, edits)


_REPAIRED = "conv_id long, position long, turn long, role string, text string, edit string"


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The turns of every repaired conversation: conv_id, position (from 0), turn (null for an inserted one), role, text, edit.

    ``found`` is ``audits`` of the same rows. Each conversation's edits come first in the order and are applied to the rows as they are read. Rows of a conversation stand together and in order.
    """
    lead = found.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), "audit", F.lit(0).alias("part"))
    body = rows.where("there").select("conv_id", "turn", "role", "text", F.lit(None).cast("string").alias("audit"), F.lit(1).alias("part"))
    both = lead.unionByName(body).repartition("conv_id").sortWithinPartitions(_ORDER[0], "part", *_ORDER[1:])
    # of equal rows the first stays by its audit, so their order among each other doesn't matter

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, edits, at, state, position = None, "", 0, NOTHING, 0

        def inserted() -> Iterator[tuple]:
            nonlocal at, state, position
            while at < len(edits) and edits[at] == INSERT:
                state = _INSERTED[state]
                yield conv, position, None, _NAME[state], "", INSERT
                at, position = at + 1, position + 1

        for part in batches:
            out: list[tuple] = []
            for c, turn, role, text, audit, kind in zip(*(part.column(k).to_pylist() for k in ("conv_id", "turn", "role", "text", "audit", "part"))):
                if kind == 0:
                    out += inserted()  # at the end of the one before
                    conv, edits, at, state, position = c, audit, 0, NOTHING, 0
                    continue
                out += inserted()
                edit, at = edits[at], at + 1
                if edit == DELETE:
                    continue
                state = _INSERTED[state] if edit == REROLE else _KEPT[role[0]][state]
                out.append((conv, position, turn, _NAME[state] if edit == REROLE else role, text, edit))
                position += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*out), schema)], schema=schema)
        if rest := list(inserted()):
            yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rest), schema)], schema=schema)

    kinds = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _REPAIRED.split(", ")])
    return both.mapInArrow(run, _REPAIRED)


def digests(turns: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of the frame ``repaired`` gives: ``role:text`` of each turn, joined by line breaks, hashed as the turns stream by."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        conv, digest = None, None
        for part in batches:
            done: list[tuple] = []
            for c, position, role, text in zip(*(part.column(k).to_pylist() for k in ("conv_id", "position", "role", "text"))):
                if position == 0:
                    if digest is not None:
                        done.append((conv, digest.hexdigest()))
                    conv, digest = c, sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done])], names=["conv_id", "repaired_sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([digest.hexdigest()])], names=["conv_id", "repaired_sha256"])

    return turns.mapInArrow(run, "conv_id long, repaired_sha256 string")


NO_TURNS = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # of no bytes


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(table(spark, sf_dir, "conversations"))
    found = written(audits(rows), "audits")
    texts = digests(repaired(rows, found)).withColumnRenamed("conv_id", "__conv")
    return found.join(texts, F.col("conv_id").eqNullSafe(F.col("__conv")), "left").select(*found.columns, F.coalesce("repaired_sha256", F.lit(NO_TURNS)).alias("repaired_sha256"))


OP13_SQL = r"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
damage AS (
  SELECT *, xor(4294967295, list_reduce(list_transform(string_split(k, ''), lambda c: CAST(ord(c) AS BIGINT)), lambda r, b:
    list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(r, b)), 4294967295::BIGINT)) % 20 AS d
  FROM named),
damaged AS (
  SELECT conv_id, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role, CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE d WHEN 3 THEN 2 ELSE 1 END)) AS again FROM damage WHERE d <> 0),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z', 1) AS last FROM damaged),
judged AS (
  SELECT conv_id, turn, role, text, substr(role, 1, 1) AS initial, row_number() OVER w AS i, lag(substr(role, 1, 1)) OVER w AS before,
    CASE WHEN last = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM seen WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth > 1)),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM judged GROUP BY conv_id),
inserted(start, n, st, said) AS (VALUES
  ('', 0, '', []::VARCHAR[]), ('', 1, 'u', ['user:']), ('', 2, 'a', ['user:', 'assistant:']), ('s', 0, 's', []), ('s', 1, 'u', ['user:']), ('s', 2, 'a', ['user:', 'assistant:']),
  ('u', 0, 'u', []), ('u', 1, 'a', ['assistant:']), ('u', 2, 'u', ['assistant:', 'user:']), ('a', 0, 'a', []), ('a', 1, 'u', ['user:']), ('a', 2, 'a', ['user:', 'assistant:'])),
next(st, good) AS (VALUES ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
best AS (
  SELECT conv_id, 0::BIGINT AS i, '' AS st, {'cost': 0::BIGINT, 'audit': '', 'said': []::VARCHAR[]} AS b FROM facts
  UNION ALL
  SELECT conv_id, i, st, min(b) FROM (
    SELECT j.conv_id, j.i, CASE e.edit WHEN 'D' THEN p.st WHEN 'R' THEN x.good ELSE j.initial END AS st, {
      'cost': r.b.cost + 3 * p.n + CASE e.edit WHEN 'D' THEN 4 ELSE CASE e.edit WHEN 'R' THEN 3 ELSE 0 END + CASE j.fault WHEN 'truncated' THEN 3 ELSE 0 END END,
      'audit': r.b.audit || repeat('I', p.n) || e.edit,
      'said': r.b.said || p.said || CASE e.edit WHEN 'D' THEN []::VARCHAR[] WHEN 'R' THEN [CASE x.good WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || j.text] ELSE [j.role || ':' || j.text] END} AS b
    FROM best r JOIN judged j ON j.conv_id IS NOT DISTINCT FROM r.conv_id AND j.i = r.i + 1 JOIN inserted p ON p.start = r.st JOIN next x ON x.st = p.st CROSS JOIN (VALUES ('D'), ('K'), ('R')) e(edit)
    WHERE e.edit = 'D' OR j.fault NOT IN ('blank', 'duplicate') AND (e.edit = 'R' OR j.initial = x.good OR j.initial = 's' AND p.st = '')) c
  GROUP BY conv_id, i, st),
done AS (
  SELECT r.conv_id, min({'cost': r.b.cost + 3 * p.n, 'audit': r.b.audit || repeat('I', p.n), 'said': r.b.said || p.said}) AS b
  FROM best r JOIN facts f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = f.n JOIN inserted p ON p.start = r.st WHERE p.st IN ('', 'a') GROUP BY r.conv_id)
SELECT o.conv_id, coalesce(f.gaps, 0) AS gaps, coalesce(f.blank, 0) AS blank, coalesce(f.duplicate, 0) AS duplicate, coalesce(f.truncated, 0) AS truncated, coalesce(f.illegal, 0) AS illegal,
  coalesce(d.b.cost, 0) AS cost, coalesce(d.b.audit, '') AS audit, sha256(coalesce(array_to_string(d.b.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM o.conv_id
"""

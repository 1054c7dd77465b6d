"""Chat formatting from an event log.

A conversation is a log of events in the order of ``seq``: ``message`` starts one, ``delta`` adds text to one (and starts it if it is new), ``edit`` replaces its text,
``regenerate`` empties it, ``delete`` takes it out. Spark deals the log out by conversation and sorts it by sequence; a task folds one conversation after another
and holds no more than one. The fold gives the final messages in the order they were started; rendering gives one string and the spans the loss is taken over.

Every turn reads ``<s>[INST] role``, a line break, the text, a line break, ``[/INST]</s>`` and a line break. A control string inside a text gets a backslash in front, one
more if there are some already, and so can be told from the template's own; ``unescape`` takes it off again.

Null texts count as empty, null roles as an empty role, null events as ``delta``; null conversations are one conversation, whose id is null. Events of equal ``seq`` are ordered by message, event, role and text;
repeated rows are events of their own. An empty log gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import table

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_START, _END = "<s>[INST] ", "\n[/INST]</s>\n"
_ANY = "|".join(map(re.escape, CONTROL))
_PLAIN = re.compile(rf"(\\*)({_ANY})")
_ESCAPED = re.compile(rf"\\(\\*)({_ANY})")
_OWN = re.compile(rf"(?<!\\)(?:{_ANY})")
_LOSS = ("assistant",)


def escape(text: str) -> str:
    return _PLAIN.sub(r"\\\1\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def fold(events: Iterable[tuple]) -> list[tuple[str, str]]:
    """Final (role, text) of each message from (message, event, role, text) in order.

    A message's role is the first one given for it; ``message`` always starts a new one. Edits, regenerations and deletions of a message that isn't there change nothing.
    """
    entries: list[list | None] = []
    latest: dict = {}
    for message, event, role, text in events:
        at = latest.get(message)
        if event == "message" or at is None and event in (None, "delta"):
            latest[message] = len(entries)
            entries.append([role or "", [text or ""]])
        elif at is None:
            continue
        elif event == "delete":
            entries[latest.pop(message)] = None
        elif event == "regenerate":
            entries[at][1] = []
        elif event == "edit":
            entries[at][1] = [text or ""]
        else:
            entries[at][1].append(text or "")
    return [(e[0], "".join(e[1])) for e in entries if e is not None]


def render(messages: Iterable[tuple[str, str]], loss_roles: tuple[str, ...] = _LOSS) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and its loss mask as (start, end) in code points."""
    out, at, mask = [], 0, []
    for role, text in messages:
        head = f"{_START}{escape(role.replace(chr(92), chr(92) * 2).replace(chr(10), chr(92) + 'n'))}\n"
        body = escape(text)
        if role in loss_roles:
            mask.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, _END]
        at += len(head) + len(body) + len(_END)
    return "".join(out), mask


def parse(formatted: str) -> list[tuple[str, str]]:
    """The messages of a formatted conversation: the template's own control strings are those without a backslash."""
    out, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(_START, at):
            raise ValueError(f"no turn at {at}")
        line = formatted.index("\n", at)
        role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(formatted[at + len(_START) : line]))
        close = _OWN.search(formatted, line + 1)
        end = close.start() - 1 if close else -1
        if end < line + 1 or not formatted.startswith(_END, end):
            raise ValueError(f"no end of the turn at {at}")
        out.append((role, unescape(formatted[line + 1 : end])))
        at = end + len(_END)
    return out


def conversations(events: DataFrame, loss_roles: tuple[str, ...] = _LOSS) -> DataFrame:
    """conv_id, formatted, mask (spans) from a log of conv_id, seq, message, event, role, text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, log = None, []
        done: dict[str, list] = {"conv_id": [], "formatted": [], "mask": []}

        def close() -> None:
            text, mask = render(fold(log), loss_roles)
            done["conv_id"].append(conv[0])
            done["formatted"].append(text)
            done["mask"].append([{"start": a, "end": b} for a, b in mask])

        for part in batches:
            for c, *event in zip(*(part.column(k).to_pylist() for k in ("conv_id", "message", "event", "role", "text"))):
                if conv != (c,):
                    if conv:
                        close()
                    conv, log = (c,), []
                log.append(event)
            if done["conv_id"]:
                yield pa.RecordBatch.from_pydict(done, schema=schema)
                done = {k: [] for k in done}
        if conv:
            close()
            yield pa.RecordBatch.from_pydict(done, schema=schema)

    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("mask", pa.list_(span))])
    log = events.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("seq").cast("long").alias("seq"), F.col("message").cast("long").alias("message"), "event", "role", "text")
    return log.repartition("conv_id").sortWithinPartitions("conv_id", "seq", "message", "event", "role", "text").mapInArrow(run, "conv_id long, formatted string, mask array<struct<start:long,end:long>>")


def events_of_turns(turns: DataFrame) -> DataFrame:
    """A table of whole turns as a log: each row starts a message of its own, also where a turn's number repeats."""
    row = F.xxhash64("turn", "role", "text")
    return turns.select("conv_id", F.col("turn").alias("seq"), row.alias("message"), F.lit("message").alias("event"), "role", "text")


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns (role, line break, text, line break for each) and loss (the text under the mask), all from the output."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rows: dict[str, list] = {"conv_id": part.column("conv_id").to_pylist(), "n_turns": [], "turns": [], "loss": []}
            for text, mask in zip(part.column("formatted").to_pylist(), part.column("mask").to_pylist()):
                messages = parse(text)
                rows["n_turns"].append(len(messages))
                rows["turns"].append("".join(f"{role}\n{said}\n" for role, said in messages))
                rows["loss"].append("".join(unescape(text[s["start"] : s["end"]]) for s in mask))
            yield pa.RecordBatch.from_pydict(rows | {"formatted_chars": [len(t) for t in part.column("formatted").to_pylist()]}, schema=schema)

    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns", pa.string()), ("loss", pa.string()), ("formatted_chars", pa.int64())])
    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns string, loss string, formatted_chars long")


CASE = "</s>[INST] ok [/INST]"  # the conversation -7 that the query adds


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", CASE), (-7, 1, "assistant", CASE)], turns.schema)
    out = read_back(conversations(events_of_turns(turns.unionByName(extra))))
    return out.select(
        "conv_id", "n_turns", F.sha2(F.col("turns").cast("binary"), 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


OP5_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, n, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(n, r)),
e AS (
  SELECT *, regexp_replace(text, '(\\*)(<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>)', '\\\1\2', 'g') AS body FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(length(body) + length(role) + 10 + 1 + 13) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

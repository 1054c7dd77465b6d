"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the text's bytes cuts it where its low bits are zero, so equal passages of different documents
give equal chunks wherever they stand. A task encodes each distinct chunk once, as long as its bounded cache holds it. Where
two chunks meet, the text around the cut is encoded again and compared with what the chunks had, in a growing window, until
both sides agree token for token.

Nulls count as empty texts; an empty text has no ids. Repeated rows give repeated results; row order is free. Columns
other than the id and the text are not read.
"""

from __future__ import annotations

import re
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import map_text
from meterlake.llm.tokens import Encoder, encoder

WINDOW = 32  # bytes the rolling hash looks back
_BREAK = re.compile(r"[ \n]+")
_CACHE_CHARS = 24_000_000


def _table() -> np.ndarray:
    """256 fixed pseudo-random numbers: the finaliser of a 32-bit mixing hash over 1 to 256."""
    x = np.arange(1, 257, dtype=np.uint64) * 0x9E3779B1 & 0xFFFFFFFF
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor) & np.uint64(0xFFFFFFFF)
    return (x ^ (x >> np.uint64(16))).astype(np.uint32)


_GEAR = _table()


def rolling_hash(data: bytes) -> np.ndarray:
    """At each byte the sum of the table's values of the last WINDOW bytes, each doubled once for every byte after it."""
    h = _GEAR[np.frombuffer(data, np.uint8)]
    step = 1
    while step < WINDOW:
        older = np.zeros_like(h)
        older[step:] = h[:-step] << np.uint32(step)
        h = h + older
        step *= 2
    return h


def chunks(text: str, bits: int = 10, least: int = 256) -> list[str]:
    """The text cut after bytes whose hash has ``bits`` leading zeros, never inside a character, ``least`` bytes apart."""
    data = text.encode("utf-8", "surrogatepass")
    if len(data) <= least:
        return [text] if text else []
    at = np.flatnonzero(rolling_hash(data) >> np.uint32(32 - bits) == 0) + 1
    at = at[at < len(data)]
    at = at[(np.frombuffer(data, np.uint8)[at] & 0xC0) != 0x80]
    cuts = [0]
    for k in at.tolist():
        if k - cuts[-1] >= least:
            cuts.append(k)
    return [data[a:b].decode("utf-8", "surrogatepass") for a, b in zip(cuts, [*cuts[1:], len(data)])]


def _tail(text: str, words: int) -> int:
    """Start of the last ``words`` words with the break before them; -1 when there are no more words than that."""
    at = len(text)
    for _ in range(words):
        at = max(text.rfind(" ", 0, at), text.rfind("\n", 0, at))
        if at < 0:
            return -1
        while at > 0 and text[at - 1] in " \n":
            at -= 1
    return at if at > 0 else -1


def _head(text: str, words: int) -> int:
    """End of the first ``words`` words; -1 when there are no more words than that."""
    at = 0
    for _ in range(words):
        while at < len(text) and text[at] in " \n":
            at += 1
        found = _BREAK.search(text, at)
        if not found:
            return -1
        at = found.start()
    return at


def join(encode, left: str, left_ids: np.ndarray, right: str, right_ids: np.ndarray) -> tuple[np.ndarray, str, np.ndarray]:
    """Ids of the text up to a place where both sides agree, then the rest of ``right`` as text and ids.

    The window's outer words must get the ids they had in their chunk. It doubles until they do; a chunk too short for
    that is encoded again as a whole with its neighbour.
    """
    words = 2
    while True:
        a, b = _tail(left, words), _head(right, words)
        if a < 0 or b < 0:
            return np.zeros(0, "<u4"), left + right, encode([left + right])[0]
        first, last = _head(left[a:], 1), _tail(right[:b], 1)
        old_left, old_right, outer_left, outer_right, new = encode([left[a:], right[:b], left[a:][:first], right[:b][last:], left[a:] + right[:b]])
        n, m = len(old_left), len(old_right)
        if (
            first > 0 and last > 0 and len(left_ids) >= n and np.array_equal(left_ids[len(left_ids) - n :], old_left) and np.array_equal(right_ids[:m], old_right)
            and np.array_equal(new[: len(outer_left)], outer_left) and np.array_equal(new[len(new) - len(outer_right) :], outer_right)
        ):
            return np.concatenate([left_ids[: len(left_ids) - n], new]), right[b:], right_ids[m:]
        words *= 2


class ChunkEncoder:
    """Encodes texts by their chunks; keeps the ids of the chunks last used."""

    def __init__(self, tokens: Encoder, bits: int, least: int):
        self.tokens, self.bits, self.least = tokens, bits, least
        self.known: OrderedDict[str, np.ndarray] = OrderedDict()
        self.held = self.encoded = self.reused = 0

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [chunks(t, self.bits, self.least) for t in texts]
        new = list(dict.fromkeys(c for parts in cut for c in parts if c not in self.known))
        self.encoded += len(new)
        self.reused += sum(map(len, cut)) - len(new)
        for c, ids in zip(new, self.tokens.encode(new), strict=True):
            self.known[c] = ids
            self.held += len(c)
        out = [self._joined(parts) for parts in cut]
        for c in (c for parts in cut for c in parts):
            if c in self.known:
                self.known.move_to_end(c)
        while self.held > _CACHE_CHARS and self.known:
            self.held -= len(self.known.popitem(last=False)[0])
        return out

    def _joined(self, parts: list[str]) -> np.ndarray:
        if not parts:
            return np.zeros(0, "<u4")
        done, left, ids = [], parts[0], self.known[parts[0]]
        for right in parts[1:]:
            ready, left, ids = join(self.tokens.encode, left, ids, right, self.known[right])
            done.append(ready)
        return np.concatenate([*done, ids])


def encode_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", bits: int = 10, least: int = 256) -> DataFrame:
    """Per row: id, ``ids`` (little-endian unsigned 32-bit numbers) and ``decoded`` (the text those ids stand for).

    ``tokenizer`` is a tokenizers file every worker can open. A chunk is encoded once in each task, and what a task keeps is bounded:
    sharing chunks between tasks would shuffle every text twice (figures in the README).
    """
    schema = pa.schema([("id", pa.from_numpy_dtype(np.int64)), ("ids", pa.binary()), ("decoded", pa.string())])

    def make():
        tokens = encoder(tokenizer)
        work = ChunkEncoder(tokens, bits, least)

        def run(part: pa.RecordBatch, texts: list[str]) -> dict:
            ids = work.encode(texts)
            return {"id": part.column("id"), "ids": [x.tobytes() for x in ids], "decoded": tokens.decode(ids)}

        return run

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_text(rows, "text", schema, make)


def op3(spark, sf_dir: str, tokenizer: str) -> DataFrame:
    from meterlake.llm.common import table

    coded = encode_documents(table(spark, sf_dir, "documents"), tokenizer)
    return coded.select(
        F.col("id").alias("doc_id"), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))

"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

Words and marks of a text (with a coarse form of each: capitals, repeats of the word before, words seen in an earlier place) give 1- and 2-grams,
hashed into a vector of fixed size with the logarithm of their count, scaled to length one. Training passes over a bounded sample of labelled rows
one by one (``max_rows``, a parameter; rows of the held-out fold are never in it); scoring is a sparse dot product per text.

Nulls count as empty texts; an empty text gets the bias's score. Without labels of both kinds every weight is 0 and every score 0.5.
Labels, language, source and id are never inputs. Repeated rows get equal scores; an empty table gives none; extra columns don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import full_text, held_out, labelled_sample, map_text, slices, table

BITS = 18
MAX_ROWS = 8_000  # labelled texts the model is fitted on
THRESHOLD = 0.3
_TOKEN = re.compile(r"\w+|[^\w\s]+")


class _Codes(dict):
    """crc32 and coarse form of the words last seen, at most a fixed number: word -> code * 4 + form."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 60_000:
            self.clear()
        form = 1 if len(word) > 1 and word.isupper() else 2 if word[0].isalpha() else 3 if word[0].isdigit() else 0
        value = self[word] = crc32(word.lower().encode("utf-8", "surrogatepass")) * 4 + form
        return value


_CODES = _Codes()


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed n-grams, and their values: log-scaled counts of length one."""
    tokens = _TOKEN.findall(text)
    if not tokens:
        return np.zeros(0, np.int64), np.zeros(0)
    code = np.fromiter(map(_CODES.__getitem__, tokens), np.int64, len(tokens))
    form, code = code & 3, code >> 2
    same = np.zeros(len(code), np.int64)
    same[1:] = code[1:] == code[:-1]  # the word before, again
    pair = code[:-1] * 0x9E3779B1 + code[1:]
    _, first = np.unique(pair, return_index=True)
    seen = np.ones(len(code), np.int64)
    seen[first] = 0
    seen[-1] = 0  # two words that stood together before
    kind = (form * 4 + same * 2 + seen) + 7_000_003
    grams = [code, kind * 0x85EBCA6B, (kind[:-1] * 64 + kind[1:]) * 0xC2B2AE35, pair + 1]
    x = np.concatenate(grams).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    index, count = np.unique((x >> np.uint64(64 - BITS)).astype(np.int64), return_counts=True)
    value = 1 + np.log(count)
    return index, value / np.sqrt((value * value).sum())


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        index, value = features(text)
        return float(_squash(self.bias + self.weights[index] @ value))


def _squash(z: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], passes: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1) -> Model:
    """Per-coordinate updates in the order given; the sums z and n of every coordinate define its weight."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    share = np.mean([y for _, _, y in rows]) if rows else 0.0
    if not 0 < share < 1:
        return Model(np.zeros(size - 1, np.float32), 0.0)

    def weight(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(passes):
        for index, value, y in rows:
            at, x = np.append(index, size - 1), np.append(value, 1.0)
            w = weight(z[at], n[at])
            g = (_squash(w @ x) - y) * x * (0.5 / (share if y else 1 - share))  # both labels weigh the same
            more = n[at] + g * g
            z[at] += g - (np.sqrt(more) - np.sqrt(n[at])) / alpha * w
            n[at] = more
    w = weight(z, n)
    return Model(w[:-1].astype(np.float32), float(w[-1]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> Model:
    """Trained in one task on at most ``max_rows`` rows; to the driver come the weights alone, of fixed size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(*features(t), y) for part in batches for t, y in zip(part.column("text").to_pylist(), part.column("label").to_pylist())]
        model = train(rows)
        yield pa.RecordBatch.from_pydict({"weights": [model.weights.tobytes()], "bias": [model.bias]})

    found = labelled_sample(docs, labels, label, max_rows).mapInArrow(run, "weights binary, bias double").collect()
    if not found:
        return train([])
    return Model(np.frombuffer(bytes(found[0]["weights"]), np.float32), found[0]["bias"])


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS weights

    def make():
        model = shared.value
        return lambda part, texts: {"doc_id": part.column("id"), "score": [model.score(t) for t in texts]}

    return map_text(docs.select(F.col(id_col).cast("long").alias("id"), full_text(text_col).alias("text")), "text", pa.schema([("doc_id", pa.int64()), ("score", pa.float64())]), make)


def accepted(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score reaches the threshold, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part in slices(batches, f"c_{at}"):
            good = [model.score(t or "") >= threshold for t in part.column(at).to_pylist()]
            yield part.filter(pa.array(good, pa.bool_()))

    renamed = docs.toDF(*[f"c_{i}" for i in range(len(names))])
    return renamed.mapInArrow(run, renamed.schema).toDF(*names)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = scored(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

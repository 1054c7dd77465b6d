"""Quality rules: a linear-chain conditional random field labels each line content or boilerplate.

Features of a line are a few indicators (length, marks, capitals, repeats, how it ends). The field's weights are fitted on a bounded sample of labelled texts
(``max_rows``, a parameter, without the held-out fold): lines of good texts count as content, lines of bad ones as boilerplate. Viterbi
decoding gives the best sequence of labels of a text; a text is retained when content lines hold at least MIN_CONTENT of its word characters
and the fixed base rules don't fail.

Nulls count as empty texts, which have no words and so fail the base rules. Without labels of both kinds all lines are content. Repeated rows get equal
results; an empty table gives none; extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import full_text, labelled_sample, map_text, table

MAX_ROWS = 1_500  # labelled texts the field is fitted on
MIN_CONTENT = 0.5
MIN_WORDS, MAX_REPEATED = 10, 20  # base rules: words, and percent of words in repeated windows
WINDOW = 5
SYMBOLS = "#*$%&|<>"
CONTENT, BOILERPLATE = 0, 1
N_FEATURES = 48


def line_words(line: str) -> list[bytes]:
    """Words are split at ASCII white space alone; bytes.split does just that."""
    return line.encode("utf-8", "surrogatepass").split()


def base_rules(text: str) -> dict[str, int | bool]:
    """Counts of the fixed rules over the whole text."""
    words = text.encode("utf-8", "surrogatepass").split()
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\r\x0b\x0c"):
            repeats += line in seen
            seen.add(line)
    chars = len(text) - sum(text.count(c) for c in " \t\n\r\x0b\x0c")
    repeated = repeated_words(words)
    return {
        "n_words": len(words), "word_chars": chars, "n_symbols": sum(text.count(c) for c in SYMBOLS), "n_dup_lines": repeats, "n_repeat_words": repeated,
        "base_failed": len(words) < MIN_WORDS or 100 * repeated > MAX_REPEATED * len(words),
    }


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of WINDOW words that occur at least twice, each word once."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    if len(set(windows)) == n:
        return 0
    first: dict[tuple, int] = {}
    again = np.zeros(n, bool)
    for i, w in enumerate(windows):
        j = first.setdefault(w, i)
        if j != i:
            again[i] = again[j] = True
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(again), 1)
    np.add.at(edge, np.flatnonzero(again) + WINDOW, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def _step(value: float, *limits: float) -> int:
    return sum(value > x for x in limits)


def line_features(line: str, words: list[bytes], seen: bool, place: int) -> list[int]:
    """Indices of the indicators that hold for a line with words."""
    n, size = len(words), len(line)
    marks = sum(line.count(c) for c in SYMBOLS)
    letters = sum(map(len, words))
    end = words[-1][-1:]
    return [
        min(n.bit_length(), 7),
        8 + _step(marks / size, 0.0, 0.02, 0.08),
        12 + _step(line.count("!") / n, 0.0, 0.2),
        15 + (line.isupper() and letters > 3),
        17 + _step(1 - len(set(words)) / n, 0.0, 0.3, 0.6) + (4 if n >= 8 else 0),
        25 + (0 if end in b".?" else 1 if end in b"!" else 2 if end in b",;:" else 3),
        29 + seen,
        31 + _step(letters / n, 3, 6, 10),
        35 + _step(line.count("|") / n, 0.0, 0.3),
        38 + ("http" in line or "@" in line),
        40 + min(place, 1),
        42,
    ]


def rows_of(text: str) -> tuple[list[int], list[list[int]], list[int]]:
    """Line numbers, features and word characters of the lines that hold a word."""
    numbers, found, weight = [], [], []
    seen: set[str] = set()
    for k, line in enumerate(text.split("\n")):
        words = line_words(line)
        if words:
            numbers.append(k)
            found.append(line_features(line, words, line in seen, len(found)))
            weight.append(sum(map(len, words)))
            seen.add(line)
    return numbers, found, weight


@dataclass(frozen=True)
class LineField:
    emit: np.ndarray  # N_FEATURES x 2
    move: np.ndarray  # 2 x 2

    def viterbi(self, lines: list[list[int]]) -> list[int]:
        """The label sequence of the largest total weight; content where two are equal."""
        if not lines:
            return []
        own = np.array([self.emit[f].sum(0) for f in lines]).tolist()
        (stay, leave), (back, keep) = self.move.tolist()
        a, b = own[0]
        came: list[tuple[int, int]] = []
        for c, d in own[1:]:
            from_a, from_b = a + stay >= b + back, a + leave >= b + keep
            came.append((0 if from_a else 1, 0 if from_b else 1))
            a, b = (a + stay if from_a else b + back) + c, (a + leave if from_b else b + keep) + d
        at = CONTENT if a >= b else BOILERPLATE
        labels = [at]
        for step in reversed(came):
            at = step[at]
            labels.append(at)
        return labels[::-1]


def _marginals(own: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of each line and summed transition probabilities, by forward and backward sums."""
    n = len(own)
    factor, step = np.exp(own - own.max(1, keepdims=True)), np.exp(move)
    ahead, behind = np.zeros((n, 2)), np.ones((n, 2))
    ahead[0] = factor[0] / factor[0].sum()
    for i in range(1, n):
        x = ahead[i - 1] @ step * factor[i]
        ahead[i] = x / x.sum()
    for i in range(n - 2, -1, -1):
        x = step @ (factor[i + 1] * behind[i + 1])
        behind[i] = x / x.sum()
    each = ahead * behind
    each /= each.sum(1, keepdims=True)
    pairs = ahead[:-1, :, None] * step[None] * (factor * behind)[1:, None, :]
    return each, (pairs / pairs.sum((1, 2), keepdims=True)).sum(0) if n > 1 else np.zeros((2, 2))


def train(texts: list[tuple[list[list[int]], int]], passes: int = 4, rate: float = 0.3, ridge: float = 1e-3) -> LineField:
    """Gradient steps on the conditional log-likelihood with per-weight rates, one text at a time; both labels weigh the same."""
    emit, move = np.zeros((N_FEATURES, 2)), np.zeros((2, 2))
    g_emit, g_move = np.full_like(emit, 1e-6), np.full_like(move, 1e-6)
    share = np.mean([y for _, y in texts]) if texts else 0
    if not 0 < share < 1:
        return LineField(emit, move)
    for _ in range(passes):
        for lines, label in texts:
            f = np.array(lines)
            each, pairs = _marginals(emit[f].sum(1), move)
            weight = 0.5 / (share if label else 1 - share) / len(lines)
            miss = np.zeros((len(lines), 2))
            miss[:, label] = 1
            d = ridge * -emit
            np.add.at(d, f, weight * (miss - each)[:, None, :])
            m = weight * -pairs - ridge * move
            m[label, label] += weight * (len(lines) - 1)
            g_emit += d * d
            g_move += m * m
            emit += rate * d / np.sqrt(g_emit)
            move += rate * m / np.sqrt(g_move)
    return LineField(emit, move)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS, max_lines: int = 400) -> LineField:
    """Trained in one task on at most ``max_rows`` texts of at most ``max_lines`` lines; the weights, of fixed size, come to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for part in batches:
            for t, good in zip(part.column("text").to_pylist(), part.column("label").to_pylist()):
                lines = rows_of(t)[1]
                if 0 < len(lines) <= max_lines:
                    rows.append((lines, CONTENT if good else BOILERPLATE))
        field = train(rows)
        yield pa.RecordBatch.from_pydict({"emit": [field.emit.tobytes()], "move": [field.move.tobytes()]})

    found = labelled_sample(docs, labels, label, max_rows).mapInArrow(run, "emit binary, move binary").collect()
    if not found:
        return train([])
    return LineField(np.frombuffer(bytes(found[0]["emit"])).reshape(-1, 2), np.frombuffer(bytes(found[0]["move"])).reshape(2, 2))


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judged(docs: DataFrame, field: LineField, id_col: str = "doc_id", text_col: str = "text", min_content: float = MIN_CONTENT) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, content_share, and boilerplate: numbers of the lines so labelled."""
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("content_share", pa.float64()), ("boilerplate", pa.list_(pa.int32()))])

    def make():
        def run(part: pa.RecordBatch, texts: list[str]) -> dict:
            out: dict[str, list] = {c: [] for c in schema.names[1:]}
            for t in texts:
                base = base_rules(t)
                numbers, lines, weight = rows_of(t)
                labels = field.viterbi(lines)
                content = sum(w for w, y in zip(weight, labels) if y == CONTENT)
                share = content / sum(weight) if weight else 0.0
                for c in (*_COUNTS, "base_failed"):
                    out[c].append(base[c])
                out["kept"].append(not base["base_failed"] and share >= min_content)
                out["content_share"].append(share)
                out["boilerplate"].append([k for k, y in zip(numbers, labels) if y == BOILERPLATE])
            return {"doc_id": part.column("id"), **out}

        return run

    return map_text(docs.select(F.col(id_col).cast("long").alias("id"), full_text(text_col).alias("text")), "text", schema, make)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = judged(docs, fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", *_COUNTS, "base_failed", "kept", "content_share")

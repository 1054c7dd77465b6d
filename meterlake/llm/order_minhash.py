"""Near-duplicate classes by Order MinHash, verified by banded alignment.

A text's words (lower case, without punctuation) give five-word shingles; the second occurrence of a shingle counts as another one. Each
of SKETCHES hash functions picks the ``picks`` smallest shingles; put back into the order they have in the text they make one key. Two texts
become candidates when a key agrees, which happens with about similarity ** picks for each function, and only if the shared parts stand in the same
order. Candidates are aligned word by word in a band around the diagonal; they are linked when the aligned equal words make up
0.8 or more of the longer text.

No bucket is expanded into all its pairs: every text is aligned with the smallest of its bucket. Where some are unlike that one, all are sketched anew, from the shingles
they do not share with it and, by other functions, from all they have, and meet in smaller buckets; LOOKS looks in all, or as many as there are new pairs (``looks=None``). Work is in proportion to the texts and looks, also where thousands of texts
share a passage; no bucket and no number of partners is capped, and hot keys are joined with Spark's skew handling. What is still of different classes in a bucket after the looks is then met pair by pair,
in blocks of fixed size; pairs whose lengths or counts of words rule the similarity out are left, the others are aligned where they meet, and only links become rows. A link between different texts is lost only if no key agrees in any look.

Nulls count as empty texts. Texts with the same words are one node of the graph (all texts without a word are one). The class id is the smallest
id in the class, a null id only if all are null. Rows with equal ids and texts get equal results. Extra columns don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from hashlib import blake2b
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.bitmaps import filter_of, looked_up, tested
from meterlake.llm.common import full_text, give_back, kept, map_text, table, written
from meterlake.llm.graph import components

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES, PICKS = 32, 5
REST_SKETCHES, REST_PICKS = 12, 2  # for texts unlike the smallest of their bucket: of what they have besides it,
LOOKS = 3  # how often the texts of a bucket are looked at, anew sketched; recall in README
_REST_FIRST = 1 << 20  # numbers of their functions
_BLOCK, _BLOCK_BYTES = 1_024, 8 << 20  # texts of a bucket that meet as many others in one cell, and their words
_COUNTS = 128  # classes of words whose counts are compared before an alignment
WHOLE_PICKS = 10  # and SKETCHES of all they have, with more picks, so that a shared passage alone is less often enough
_WORD = re.compile(r"\w+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit mixing hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    """Hashes of the words last seen, at most a fixed number."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 60_000:
            self.clear()
        value = self[word] = int.from_bytes(blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return value


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def word_hashes(words: list[str], known: _Hashes | None = None) -> np.ndarray:
    """64 bits of each word."""
    return np.fromiter(map((_Hashes() if known is None else known).__getitem__, words), np.uint64, len(words))


def shingles(hashes: np.ndarray) -> np.ndarray:
    """Hashes of the occurrence-labelled shingles; a text of fewer words has one shingle, an empty one none."""
    n = len(hashes)
    if n == 0:
        return np.zeros(0, np.uint64)
    k = min(SHINGLE, n)
    out = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        out = _mix(out * _ODD + hashes[i : n - k + 1 + i])
    order = np.argsort(out, kind="stable")
    same = np.concatenate([[False], out[order][1:] == out[order][:-1]])
    if same.any():
        at = np.arange(len(out))
        nth = np.zeros(len(out), np.uint64)
        nth[order] = (at - np.maximum.accumulate(np.where(same, 0, at))).astype(np.uint64)
        out = _mix(out + nth * _ODD)
    return out


def picks_for(n: int, most: int = PICKS) -> int:
    return max(1, min(most, n // 8))


def sketch_keys(marks: np.ndarray, first: int = 0, picks: int = PICKS) -> np.ndarray:
    """All keys of a text, by SKETCHES functions from ``first`` on. Short texts pick fewer shingles, and also as many as texts up to a fifth shorter do, so that both meet."""
    n = len(marks)
    if n == 0:
        return np.zeros(0, np.int64)
    most, least = picks_for(n, picks), picks_for(int(np.ceil(SIMILARITY * n)), picks)
    at_once = max(1, 250_000 // n)
    end = first + SKETCHES
    return np.concatenate([_keys(marks, range(f, min(f + at_once, end)), least, most) for f in range(first, end, at_once)]).view(np.int64)


def _keys(marks: np.ndarray, functions: range, least: int, most: int) -> np.ndarray:
    """One row of hashes for each function, its smallest shingles put back into text order, folded into one number."""
    number = np.arange(functions.start + 1, functions.stop + 1, dtype=np.uint64)
    h = _mix(marks[None, :] ^ _mix(number * _ODD)[:, None])
    low = np.argpartition(h, most - 1, axis=1)[:, :most] if h.shape[1] > most else np.broadcast_to(np.arange(h.shape[1]), h.shape)
    low = np.take_along_axis(low, np.argsort(np.take_along_axis(h, low, 1), axis=1), 1)
    out = []
    for picks in range(least, most + 1):
        key = number * np.uint64(16) + np.uint64(picks)
        for m in marks[np.sort(low[:, :picks], axis=1)].T:
            key = _mix(key * _ODD + m)
        out.append(key)
    return np.concatenate(out)


def aligned(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Equal words of the best alignment over the words of the longer text, or a number under ``least``.

    Words pair up only within a band around the diagonal. The band starts narrow and doubles until the similarity is reached, or until it is as wide as any
    alignment of that similarity can need. Rows of the band are bit vectors (a zero: the count of equal words grows here).
    """
    n = max(len(a), len(b))
    if n == 0:
        return 1.0
    short = min(len(a), len(b))
    if short < least * n:
        return short / n * least  # cannot reach it
    values, counts = np.unique(a, return_counts=True)
    other, more = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(values, other, assume_unique=True, return_indices=True)
    if np.minimum(counts[i], more[j]).sum() < least * n:
        return 0.0
    widest = n - int(np.ceil(least * n)) + 1
    band = min(64, widest)
    while True:
        score = _banded(a, b, band, least * n) / n
        if score >= least or band >= widest:
            return score
        band = min(2 * band, widest)


def _banded(a: np.ndarray, b: np.ndarray, band: int, need: float = 0) -> int:
    """Length of the longest common subsequence with pairs at most ``band`` apart, in blocks of rows that slide along the diagonal. A number under ``need`` as soon as the rows left cannot reach it."""
    rows = max(64, band)
    seen = 0
    low = -band  # column of the vector's lowest bit
    width = rows + 2 * band
    full = (1 << width) - 1
    v = full
    places: dict[int, int] = {}
    left, right = a.tolist(), b.tolist()
    for j in range(0, min(len(right), low + width)):
        places[right[j]] = places.get(right[j], 0) | 1 << (j - low)
    for start in range(0, len(left), rows):
        for i in range(start, min(start + rows, len(left))):
            at = places.get(left[i])
            if at:
                inside = (1 << (2 * band + 1)) - 1 << (i - start)
                m = at & inside
                u = v & m
                v = (v + u | v & ~m) & full
        # the lowest ``rows`` columns are left for good
        gone = v & ((1 << rows) - 1)
        real = min(max(len(right) - low, 0), rows)
        skipped = max(0, -low)
        seen += max(0, real - skipped) - ((gone >> skipped) & ((1 << max(0, real - skipped)) - 1)).bit_count()
        v = v >> rows | ((1 << rows) - 1) << (width - rows)
        low += rows
        if start + rows < len(left):
            if (most := seen + width - v.bit_count() + len(left) - start - rows) < need:
                return most
            places = {}
            for j in range(max(low, 0), min(len(right), low + width)):
                places[right[j]] = places.get(right[j], 0) | 1 << (j - low)
    real = min(max(len(right) - low, 0), width)
    skipped = max(0, -low)
    if real > skipped:
        seen += real - skipped - ((v >> skipped) & ((1 << (real - skipped)) - 1)).bit_count()
    return seen


def node_of(words: list[str]) -> bytes:
    return blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _key(text: str):
    """The text as it stands, as 256 bits."""
    return F.unhex(F.sha2(full_text(text).cast("binary"), 256))


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key (of the text), node (128 bits of its word sequence), keys, words (32 bits of each word, for the alignment)."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("node", pa.binary()), ("keys", pa.list_(pa.int64())), ("words", pa.binary())])

    def make():
        known = _Hashes()  # goes with the task

        def run(part: pa.RecordBatch, texts: list[str]) -> dict:
            nodes, keys, short = [], [], []
            for t in texts:
                words = words_of(t)
                hashes = word_hashes(words, known)
                nodes.append(node_of(words))
                keys.append(sketch_keys(shingles(hashes)))
                short.append(hashes.astype(np.uint32).tobytes())
            return {"doc_id": part.column("id"), "key": part.column("key"), "node": nodes, "keys": keys, "words": short}

        return run

    return map_text(docs.select(F.col(id_col).cast("long").alias("id"), full_text(text_col).alias("text"), _key(text_col).alias("key")), "text", schema, make)


def whole_keys(words: np.ndarray, look: int) -> np.ndarray:
    """Keys of all a text has, for its ``look``-th sketch; by other functions each time."""
    return sketch_keys(shingles(words), SKETCHES * look, WHOLE_PICKS)


def rest_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Keys for finding partners of ``b`` among the other texts unlike ``a``, by functions of ``a``'s own: of what ``b`` has besides ``a``, where a passage that many texts hold is out of play."""
    marks = shingles(b)
    rest = marks[~np.isin(marks, shingles(a))]
    if len(rest) == 0:
        return np.zeros(0, np.int64)
    scoped = _mix(rest ^ np.uint64(int.from_bytes(blake2b(a.tobytes(), digest_size=8).digest(), "little")))
    picks = min(REST_PICKS, len(scoped))
    return _keys(scoped, range(_REST_FIRST, _REST_FIRST + REST_SKETCHES), picks, picks).view(np.int64)


def _texts_of(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, words) of a stored set of nodes; a Bloom filter of fixed size keeps the other texts out of the shuffle."""
    maybe = tested(rows.select("node", "words"), "node", filter_of(nodes, "node")).where("maybe").drop("maybe")
    return written(maybe.groupBy("node").agg(F.first("words").alias("words")).join(nodes, "node", "left_semi"), "aligned_texts")


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    a, b = (texts.select(F.col("node").alias(c), F.col("words").alias(f"w{c}")) for c in "ab")
    return pairs.join(a, "a").join(b, "b").select(*pairs.columns, "wa", "wb")


def _few_rows(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)
    give_back()


def verify(pairs: DataFrame, texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(a, b, alike) for pairs of nodes, stored; ``texts`` has their words."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("alike", pa.bool_())])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _few_rows(batches):
            wa, wb = ([np.frombuffer(x, np.uint32) for x in part.column(c).to_pylist()] for c in ("wa", "wb"))
            yield pa.RecordBatch.from_pydict({"a": part.column("a"), "b": part.column("b"), "alike": [aligned(x, y, least) >= least for x, y in zip(wa, wb)]}, schema=schema)

    return written(_with_texts(pairs.select("a", "b"), texts).mapInArrow(check, "a binary, b binary, alike boolean"), "alignments")


def _anew(going_on: DataFrame, texts: DataFrame, look: int) -> DataFrame:
    """(node, key): new keys of the texts ``b`` in pairs whose ``a`` has texts unlike it: those of all a text has, once for each text, and those of what it has besides an ``a`` it is unlike."""
    def make(keys: Callable) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in _few_rows(batches):
                words = [[np.frombuffer(x, np.uint32).astype(np.uint64) for x in part.column(c).to_pylist()] for c in part.schema.names[1:]]
                yield pa.RecordBatch.from_pydict({"node": part.column("node"), "keys": [keys(*w) for w in zip(*words)]}, schema=schema)

        return run

    schema = pa.schema([("node", pa.binary()), ("keys", pa.list_(pa.int64()))])
    kind = "node binary, keys array<long>"
    whole = texts.join(going_on.select(F.col("b").alias("node")).distinct(), "node", "left_semi").select("node", "words").mapInArrow(make(lambda words: whole_keys(words, look)), kind)
    unlike = _with_texts(going_on.where(~F.col("alike")).select("a", "b"), texts).select(F.col("b").alias("node"), "wa", "wb")
    return whole.unionAll(unlike.mapInArrow(make(rest_keys), kind)).select("node", F.explode("keys").alias("key")).distinct()


def _with_heads(members: DataFrame) -> DataFrame:
    """(a, b): each node of a bucket (key, node, label) with the smallest node in it. Nodes of one label are linked already, so they are not paired."""
    head = F.min(F.struct("node", "label")).alias("h")
    heads = kept(members.groupBy("key").agg(head, F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("key", F.col("h.node").alias("a"), F.col("h.label").alias("of_a")))
    return members.join(heads, "key").where("label != of_a").select("a", F.col("node").alias("b")).distinct()


def linked(rows: DataFrame, least: float = SIMILARITY, looks: int | None = LOOKS) -> DataFrame:
    """(a, b): links that connect the near-duplicate nodes of a stored table of ``sketches``.

    First look: the nodes of a bucket are aligned with its smallest one. Where some are unlike it, all that were aligned with the same node, alike to it or not, are sketched anew, meet in new buckets
    and are looked at again, ``looks`` times in all. Nodes alike to the same node are linked and not paired again. ``looks=None`` goes on until no bucket holds a pair that was not looked at, with new functions each time. Each look is
    stored, so that plans do not grow.

    Last, texts of different classes that met in a bucket of any look are aligned with each other (``_left_out``): no pair with a key in common goes unseen.
    """
    met: list[DataFrame] = []
    pairs = kept(_with_heads(rows.select("node", F.explode("keys").alias("key")).distinct().withColumn("label", F.col("node"))))
    seen, at = None, 0
    while looks is None or at < looks:
        if pairs.isEmpty():
            break
        looked_at = verify(pairs, _texts_of(_nodes(pairs), rows), least)
        seen = looked_at if seen is None else written(seen.unionAll(looked_at), "looked_at")
        at += 1
        if looks is None or at < looks:
            unlike = seen.where(~F.col("alike")).select("a").distinct()
            going_on = kept(seen.join(looked_at.select("a").distinct(), "a", "left_semi").join(unlike, "a", "left_semi"))
            labels = seen.where("alike").groupBy(F.col("b").alias("node")).agg(F.min("a").alias("low"))
            members = _anew(going_on, _texts_of(_nodes(going_on), rows), at).join(labels, "node", "left").select("node", "key", F.least("node", F.coalesce("low", "node")).alias("label"))
            met.append(written(members, "members"))
            pairs = kept(_with_heads(met[-1]).join(seen, ["a", "b"], "left_anti"))
    if seen is None:
        return pairs
    links = seen.where("alike").select("a", "b")
    return links.unionAll(_left_out(seen, met, rows, least)[0])


def _left_out(seen: DataFrame, met: list[DataFrame], rows: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """(links, texts): links (a, b) that connect the alike ones among texts of different classes with a key in common, as a bucket's texts are aligned with its smallest one only, and the words of these texts.

    Both were aligned with one that is unlike some text, so no other text is looked at. A bucket is cut into blocks, and two blocks meet in one cell, where lengths and counts of words are compared as arrays and what they allow is
    aligned at once: no pair becomes a row before it is a link. A pair is aligned in the bucket of the smallest key it has in common, so once, and not where links of the cell connect it already. What is compared grows with the square of
    the different classes in a bucket; rows and memory don't.
    """
    unlike = seen.where(~F.col("alike")).select("a").distinct()
    nodes = kept(seen.join(unlike, "a", "left_semi").select(F.col("b").alias("node")).distinct())
    texts = _texts_of(nodes, rows)
    keyed = tested(rows.select("node", "keys"), "node", filter_of(nodes, "node")).where("maybe").select("node", F.explode("keys").alias("key"))
    for members in met:
        keyed = keyed.unionAll(members.select("node", "key"))
    roots = components(seen.where("alike").select("a", "b"))
    labels = nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("label"))
    sizes = texts.select("node", F.length("words").alias("size"))
    own = written(keyed.groupBy("node").agg(F.collect_set("key").alias("keys")).join(labels, "node").join(sizes, "node"), "left_out")
    keys = own.select("node", "label", "size", F.explode("keys").alias("key"))
    blocks = F.greatest(F.ceil(F.count("*") / _BLOCK), F.ceil(F.sum("size") / _BLOCK_BYTES)).cast("int")
    mixed = kept(keys.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), blocks.alias("blocks")).where("low != high").select("key", "blocks"))
    placed = kept(keys.join(mixed, "key").select("node", "key", "blocks"))
    held = kept(placed.groupBy("node").agg(F.array_sort(F.collect_list("key")).alias("shared")))
    cells = placed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "node").join(own.select("node", "label").join(held, "node").join(texts, "node"), "node")
    found = cells.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y").mapInArrow(_cell_links(least), "a binary, b binary")
    return written(found.distinct(), "links_left_out"), texts


def _alike(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs that are alike."""
    return verify(pairs, texts, least).where("alike").select("a", "b")


def _counts(words: list[np.ndarray]) -> np.ndarray:
    """The words of each text counted in a few classes of words, one byte for each class."""
    return np.array([np.minimum(np.bincount(w % _COUNTS, minlength=_COUNTS), 255) for w in words], np.uint8)


def _cell_links(least: float) -> Callable:
    """(a, b): links of a cell that connect its alike texts of different labels, of pairs whose smallest shared key is the cell's and whose lengths and counts of words allow the similarity. No alignment has more equal words than the
    counts have in common and the words beyond a full byte."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def compare(cell: pa.Table) -> Iterator[tuple[bytes, bytes]]:
        key, block, label = cell.column("key")[0].as_py(), cell.column("block").to_numpy(), cell.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
        one = cell.column("x")[0].as_py() == cell.column("y")[0].as_py()
        words = [np.frombuffer(w, np.uint32) for w in cell.column("words").to_pylist()]
        n, counts = np.array(list(map(len, words))), _counts(words)
        beyond = n - counts.sum(axis=1, dtype=np.int64)
        node, shared = cell.column("node").to_pylist(), [frozenset(k) for k in cell.column("shared").to_pylist()]
        linked_to = label.copy()  # labels that links of this cell have joined are one
        for i in range(len(n)):
            j = np.arange(i + 1, len(n))
            j = j[(linked_to[j] != linked_to[i]) & (one | (block[j] != block[i])) & (np.minimum(n[j], n[i]) >= np.maximum(n[j], n[i]) * least)]
            if len(j):
                common = np.minimum(counts[j], counts[i]).sum(axis=1, dtype=np.int64) + np.minimum(beyond[j], beyond[i])
                for k in j[common >= least * np.maximum(n[j], n[i])].tolist():
                    if linked_to[k] != linked_to[i] and min(shared[i] & shared[k]) == key and aligned(words[i], words[k], least) >= least:
                        linked_to[linked_to == linked_to[k]] = linked_to[i]
                        yield min(node[i], node[k]), max(node[i], node[k])

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, bytes]]:
        open_cell: pa.Table | None = None  # rows of the last cell, which may go on in the next batch
        for batch in batches:
            part = pa.Table.from_batches([batch])
            part = part if open_cell is None else pa.concat_tables([open_cell, part])
            at = [part.column(c).to_numpy() for c in ("key", "x", "y")]
            starts = [0, *(np.flatnonzero(np.any([c[1:] != c[:-1] for c in at], axis=0)) + 1).tolist()] if part.num_rows else []
            for start, end in zip(starts, starts[1:]):
                yield from compare(part.slice(start, end - start))
            open_cell = part.slice(starts[-1]) if starts else None
        if open_cell is not None:
            yield from compare(open_cell)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = links(batches)
        while some := list(islice(found, 10_000)):
            yield pa.RecordBatch.from_pydict({"a": [a for a, _ in some], "b": [b for _, b in some]}, schema=schema)
        give_back()

    return run


def _nodes(pairs: DataFrame) -> DataFrame:
    return kept(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, key, node, class_id, class_size, kept_node (of the text that stays)."""
    rows = written(sketches(docs, id_col, text_col), "sketches")
    nodes = kept(rows.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")))
    roots = components(linked(rows, least))
    grouped = kept(nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "first_id", "n").where("root != node or n > 1").unionAll(
        nodes.join(roots.where("root = node").select("node"), "node", "left_semi").where("n = 1").select("node", F.col("node").alias("root"), "first_id", "n")))
    total = kept(grouped.groupBy("root").agg(
        F.min("first_id").alias("class_id"), F.sum("n").alias("class_size"), F.min(F.struct(F.col("first_id").isNull(), "first_id", "node"))["node"].alias("kept_node")))
    own = kept(grouped.join(total, "root").select("node", "class_id", "class_size", "kept_node"))
    out = rows.select("doc_id", "key", "node").join(own, "node", "left")
    return out.select(
        "doc_id", "key", "node", F.when(F.col("class_size").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"),
        F.coalesce("kept_node", "node").alias("kept_node"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """One row of each class: of the text that holds the smallest id, the row with that id. All columns as they are. Rows alone in their class don't shuffle."""
    marks = classes(docs, id_col, text_col, least).where("class_size > 1")
    groups = kept(marks.groupBy(F.col("key").alias("__key")).agg(F.min("node").alias("__node"), F.min("class_id").alias("__id"), F.min("kept_node").alias("__kept")))
    own = [f"c_{i}" for i in range(len(docs.columns))]
    keyed = docs.toDF(*own).withColumn("__key", _key(own[docs.columns.index(text_col)]))
    out = looked_up(keyed, "__key", groups)
    alone = out.where(F.col("__kept").isNull())
    heads = out.where((F.col("__kept") == F.col("__node")) & F.col(own[docs.columns.index(id_col)]).cast("long").eqNullSafe(F.col("__id"))).dropDuplicates(["__node"])
    return alone.select(*own).unionAll(heads.select(*own)).toDF(*docs.columns)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))

"""Information-theoretic sanitisation of personal data.

Protected entities are the values fixed patterns find: e-mail and IP addresses, card and phone numbers. A term (a word) is estimated to disclose an entity by
how much seeing it tells about the entity: pointwise mutual information over the entity's own information, both from counts over the
whole corpus. Terms at or above ``disclosure`` (1 would name the entity outright) are sanitised wherever the entity stands in the same text: generalised to
a placeholder, or removed.

All counts are of different texts: a text counts once, however often it is copied. An entity counts with the texts that hold it, and a term stands by it wherever it is in such a text, next to it or far away. Edited copies
prove nothing either: each text has a near-copy mark, the smallest hash of two neighbouring words away from its entities, and a pair needs ``support`` texts that are really different, counted as
(sum of n)^2 / (sum of n^2) over the texts with each mark. Entities of fewer texts are put aside before terms are looked at; of the terms by the others, those too common to disclose
anything go by a lower bound of their texts, so only rare ones are counted exactly. A term is taken to stand in one text more, without the entity, so that a few texts that agree by chance are not enough. Bloom filters of fixed size keep other words out of the shuffle, exact joins follow them.

Nulls count as empty texts. Results depend on the text alone, so rows with equal texts get equal spans. An empty table gives none. Extra columns don't matter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from hashlib import blake2b
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.bitmaps import looked_up
from meterlake.llm.common import full_text, kept, map_text, slices, table

KINDS = ("email", "ip", "card", "phone")
REACH = 8  # words each side of an entity that are left out of the near-copy mark
_LEAST_WORDS = 8  # a text of fewer words besides is marked by all its words
SUPPORT = 3
DISCLOSURE = 0.8
FILTER_BITS = 1 << 23  # 1 MiB: the size bound of the filter each task holds

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_TERM = re.compile(r"[^\W\d_]+")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses. Found from each @ backwards, so a long run of letters costs one look."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            free = found.end()
        at = text.find("@", max(free, at + 1))
    return out


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _ip_fits(found: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in found.split("."))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then by start, in code points."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if _ip_fits(m[0])]
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


def as_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def entity_of(kind: str, value: str) -> str:
    """One form of a protected value, however it is written."""
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else _NOT_DIGIT.sub('', value)}"


def _outside(text: str, spans: list[tuple[str, int, int]]) -> Iterator[re.Match]:
    """Words that are no part of a protected value."""
    taken = sorted((a, b) for _, a, b in spans)
    k = 0
    for m in _TERM.finditer(text):
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        if k == len(taken) or m.end() <= taken[k][0]:
            yield m


def _hash(words: list[str]) -> np.ndarray:
    """64 bits of each pair of neighbouring words."""
    h = np.fromiter((crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
    x = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def text_hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def near_copy_mark(text: str, spans: list[tuple[str, int, int]]) -> int:
    """A number that most edited copies of a text share and different texts don't, whatever stands around their entities."""
    words = [(m.start(), m[0].lower()) for m in _outside(text, spans)]
    starts, keep = [a for a, _ in words], np.ones(len(words), bool)
    for _, a, _ in spans:
        k = int(np.searchsorted(starts, a))
        keep[max(0, k - REACH) : k + REACH] = False
    left = [w for (_, w), k in zip(words, keep) if k]
    if len(left) < _LEAST_WORDS:
        return text_hash(" ".join(w for _, w in words))
    return int(_hash(left).min().astype(np.int64))


def _bits(terms: DataFrame, size: int) -> np.ndarray | None:
    """A filter of the terms as an array of booleans; ``size`` bits come to the driver at most."""
    per = 1 << 15
    slot = F.pmod(F.crc32(F.col("term").cast("binary")), F.lit(size))
    rows = terms.select(slot.alias("slot")).groupBy(F.floor(F.col("slot") / per).cast("int").alias("bucket")).agg(F.bitmap_construct_agg(F.col("slot") % per).alias("bitmap")).collect()
    if not rows:
        return None
    out = np.zeros(size, bool)
    for r in rows:
        out[r["bucket"] * per : (r["bucket"] + 1) * per] = np.unpackbits(np.frombuffer(bytes(r["bitmap"]), np.uint8), bitorder="little")
    return out


def _filtered(spark: SparkSession, values: DataFrame):
    """A function that makes, inside a task, a test for values of the frame's column ``term``."""
    bits = _bits(values, FILTER_BITS)
    shared = spark.sparkContext.broadcast(np.packbits(np.zeros(8, bool) if bits is None else bits))

    def make() -> Callable[[str], bool]:
        there = np.unpackbits(shared.value).astype(bool)
        return lambda value: bool(there[crc32(value.encode("utf-8", "surrogatepass")) % len(there)])

    return make


def _columns(rows: set[tuple], schema: pa.Schema) -> dict:
    return dict(zip(schema.names, map(list, zip(*rows)))) if rows else {c: [] for c in schema.names}


def disclosing(docs: DataFrame, text_col: str = "text", support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """(entity, term, share): terms that disclose an entity; share is information about it over the entity's own, by counts of different texts."""
    spark = docs.sparkSession
    texts = docs.select(full_text(text_col).alias("text"))
    effective = F.sum("n") * F.sum("n") / F.sum(F.col("n") * F.col("n"))

    # entities of enough different texts
    who = pa.schema([("entity", pa.string()), ("text", pa.int64()), ("mark", pa.int64())])

    def holding():
        def run(part: pa.RecordBatch, texts: list[str]) -> dict:
            rows = set()
            for text in texts:
                if spans := base_spans(text):
                    key, mark = text_hash(text), near_copy_mark(text, spans)
                    rows |= {(entity_of(k, text[a:b]), key, mark) for k, a, b in spans}
            return _columns(rows, who)

        return run

    held = kept(map_text(texts, "text", who, holding).distinct())
    entities = held.groupBy("entity", "mark").agg(F.count("*").alias("n")).groupBy("entity").agg(F.sum("n").alias("n_entity"), effective.alias("different")).where(F.col("different") >= support)
    entities = kept(entities.select("entity", "n_entity"))
    known = _filtered(spark, entities.select(F.col("entity").alias("term")))

    # words of the texts that hold one of them
    both = pa.schema([("entity", pa.string()), ("term", pa.string()), ("text", pa.int64()), ("mark", pa.int64())])

    def beside():
        often = known()

        def run(part: pa.RecordBatch, texts: list[str]) -> dict:
            rows = set()
            for text in texts:
                spans = base_spans(text)
                if mine := {e for k, a, b in spans if often(e := entity_of(k, text[a:b]))}:
                    key, mark, terms = text_hash(text), near_copy_mark(text, spans), {m[0].lower() for m in _outside(text, spans)}
                    rows |= {(e, t, key, mark) for e in mine for t in terms}
            return _columns(rows, both)

        return run

    pairs = map_text(texts, "text", both, beside).distinct().groupBy("entity", "term", "mark").agg(F.count("*").alias("n"))
    pairs = pairs.groupBy("entity", "term").agg(F.sum("n").alias("n_both"), effective.alias("different")).where(F.col("different") >= support)
    n_texts = docs.select(F.xxhash64(full_text(text_col)).alias("h")).distinct().count()
    rate = F.col("n_both") / F.col("n_entity")
    # share >= disclosure means n_term + 1 <= this; of all pairs of a term the greatest limit counts
    limit = F.lit(float(n_texts)) * rate * F.pow(F.col("n_entity") / F.lit(float(n_texts)), F.lit(disclosure))
    pairs = kept(pairs.join(entities, "entity").select("entity", "term", "n_both", "n_entity", limit.alias("most")))
    limits = kept(pairs.groupBy("term").agg(F.max("most").alias("most")))
    maybe = _filtered(spark, limits.select("term"))

    # texts of each term: at least as many as in any one slice of the corpus
    counts = pa.schema([("term", pa.string()), ("n", pa.int64())])

    def at_least():
        candidate = maybe()

        def run(part: pa.RecordBatch, texts: list[str]) -> dict:
            n = Counter(t for text in {text_hash(t): t for t in texts}.values() for t in set(_TERM.findall(text.lower())))
            found = [(t, k) for t, k in n.items() if k > 1 and candidate(t)]
            return {"term": [t for t, _ in found], "n": [k for _, k in found]}

        return run

    common = map_text(texts, "text", counts, at_least).groupBy("term").agg(F.max("n").alias("least"))
    rare = kept(limits.join(common, "term", "left").where(F.col("most") * (1 + 1e-9) >= F.coalesce("least", F.lit(1)) + 1).select("term"))
    rarely = _filtered(spark, rare)
    where = pa.schema([("term", pa.string()), ("text", pa.int64())])

    def counting():
        candidate = rarely()

        def run(part: pa.RecordBatch, texts: list[str]) -> dict:
            known: dict[str, bool] = {}
            rows = set()
            for text in texts:
                key = text_hash(text)
                for t in set(_TERM.findall(text.lower())):
                    if t not in known:
                        known[t] = candidate(t)
                    if known[t]:
                        rows.add((t, key))
            return _columns(rows, where)

        return run

    n_term = map_text(texts, "text", where, counting).join(rare, "term", "left_semi").distinct().groupBy("term").agg(F.count("*").alias("n_term"))
    own = -F.log2(F.col("n_entity") / F.lit(float(n_texts)))
    about = F.log2(rate / ((F.col("n_term") + 1) / F.lit(float(n_texts))))  # p(term | entity) against p(term)
    share = F.when(own > 0, F.least(about / own, F.lit(1.0))).otherwise(F.lit(0.0))
    return pairs.join(n_term, "term").select("entity", "term", share.alias("share")).where(F.col("share") >= disclosure)


def _found_terms(docs: DataFrame, flagged: DataFrame, text_col: str) -> DataFrame:
    """(key, start, end) of flagged terms in texts that hold their entity; key is the text's sha256."""
    spark = docs.sparkSession
    listed = _filtered(spark, flagged.select(F.concat_ws("\n", "entity", "term").alias("term")).distinct())

    def find():
        there = listed()

        def run(part: pa.RecordBatch, texts: list[str]) -> dict:
            out: dict[str, list] = {c: [] for c in ("key", "entity", "term", "start", "end")}
            for key, text in zip(part.column("key").to_pylist(), texts):
                spans = base_spans(text)
                held = {entity_of(k, text[a:b]) for k, a, b in spans}
                places = [(m[0].lower(), m.start(), m.end()) for m in _outside(text, spans)] if held else []
                for e in held:
                    for term, a, b in places:
                        if there(f"{e}\n{term}"):
                            for c, v in zip(out, (key, e, term, a, b)):
                                out[c].append(v)
            return out

        return run

    schema = pa.schema([("key", pa.string()), ("entity", pa.string()), ("term", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    rows = docs.select(full_text(text_col).alias("text")).withColumn("key", F.sha2(F.col("text").cast("binary"), 256))
    found = map_text(rows, "text", schema, find)
    return found.join(flagged.select("entity", "term"), ["entity", "term"]).select("key", "start", "end").distinct()


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """One row per row of ``docs``: doc_id, key, spans (base) and terms, each an array of (kind, start, end)."""
    flagged = kept(disclosing(docs, text_col, support, disclosure))
    terms = term_spans(docs, flagged, text_col)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.string()), ("spans", pa.list_(span))])

    def make():
        def run(part: pa.RecordBatch, texts: list[str]) -> dict:
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in base_spans(t)] for t in texts]
            return {"doc_id": part.column("id"), "key": part.column("key"), "spans": spans}

        return run

    rows = docs.select(F.col(id_col).cast("long").alias("id"), full_text(text_col).alias("text")).withColumn("key", F.sha2(F.col("text").cast("binary"), 256))
    base = map_text(rows, "text", schema, make)
    return base.join(terms, "key", "left").select("doc_id", "key", "spans", F.coalesce("terms", F.expr("cast(array() as array<struct<kind:string,start:bigint,end:bigint>>)")).alias("terms"))


def term_spans(docs: DataFrame, flagged: DataFrame, text_col: str = "text") -> DataFrame:
    """(key, terms): the disclosing words of each text that has any, as sorted (kind, start, end)."""
    spans = _found_terms(docs, flagged, text_col).groupBy("key").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("s"))
    return kept(spans.select("key", F.transform("s", lambda x: F.struct(F.lit("term").alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).alias("terms")))


def replace(text: str, spans: list[tuple[str, int, int]], remove_terms: bool = False) -> str:
    """The text with each span generalised to ``[KIND]``; overlapping spans count as the one that starts first."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], "" if remove_terms and kind == "term" else f"[{kind.upper()}]"]
        at = max(at, b)  # a span that overlaps the one before only ends later
    return "".join([*out, text[at:]])


def sanitised(docs: DataFrame, text_col: str = "text", support: int = SUPPORT, disclosure: float = DISCLOSURE, remove_terms: bool = False) -> DataFrame:
    """The rows with personal data and disclosing terms replaced in the text; other columns as they are. A null text stays null."""
    flagged = kept(disclosing(docs, text_col, support, disclosure))
    terms = term_spans(docs, flagged, text_col)
    names = docs.columns
    own = [f"c_{i}" for i in range(len(names))]
    renamed = docs.toDF(*own)
    text = own[names.index(text_col)]
    rows = looked_up(renamed.withColumn("__key", F.sha2(full_text(text).cast("binary"), 256)), "__key", terms.withColumnRenamed("key", "__key").withColumnRenamed("terms", "__terms"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            texts = []
            for t, more in zip(part.column(text).to_pylist(), part.column("__terms").to_pylist()):
                texts.append(t and replace(t, base_spans(t) + [(x["kind"], x["start"], x["end"]) for x in more or []], remove_terms))
            columns = [pa.array(texts, part.column(c).type) if c == text else part.column(c) for c in own]
            yield pa.RecordBatch.from_arrays(columns, own)

    return rows.select(*own, "__terms").mapInArrow(run, renamed.schema).toDF(*names)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    out = found(table(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS]
    return out.select("doc_id", *counts, F.sha2(joined(F.col("spans")).cast("binary"), 256).alias("base_sha256"), joined(F.concat("spans", "terms")).alias("spans"))

"""The pipeline against a version in one process, and the rules its stages share."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from conftest_llm import TEXTS, frame, rows_of
from meterlake.llm import disclosure, ftrl, order_minhash
from meterlake.llm.common import table
from meterlake.llm.queries import BYTES
from test_dedup import brute_components, exact_groups


def brute(spark, docs, sf_dir):
    """Text of each id after the first two stages, and its root by all aligned pairs and by those of similar shingles."""
    model = ftrl.fit(docs, table(spark, sf_dir, "labels"))
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect() if model.score(r["text"] or "") >= ftrl.THRESHOLD]
    first = {min((i for i in ids if i is not None), default=None) for ids in exact_groups(rows).values()}
    rows = {i: t for i, t in rows if i in first}
    hashes = {i: order_minhash.word_hashes(order_minhash.words_of(t)) for i, t in rows.items()}
    marks = {i: Counter(order_minhash.shingles(h).tolist()) for i, h in hashes.items()}
    links = [(a, b) for a in hashes for b in hashes if a < b and order_minhash.aligned(hashes[a].astype(np.uint32), hashes[b].astype(np.uint32)) >= 0.8]
    close = [(a, b) for a, b in links if sum((marks[a] & marks[b]).values()) >= 0.8 * sum((marks[a] | marks[b]).values())]
    return rows, brute_components(rows, links), brute_components(rows, close)


def test_run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = corpus_pipeline.run(spark, sf_dir).collect()
    texts, most, least = brute(spark, docs, sf_dir)
    by_doc, bins = defaultdict(list), defaultdict(list)
    for r in out:
        by_doc[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {i for i in texts if most[i] == i} <= set(by_doc) <= {i for i in texts if least[i] == i}
    assert len(by_doc) <= len({most[i] for i in texts}) + 0.02 * len(texts)  # sketches may miss pairs of less similar shingles
    lib = Tokenizer.from_file(BYTES)
    for i in by_doc:
        text = texts[i]
        spans = disclosure.base_spans(text)
        ids = lib.encode(disclosure.replace(text, spans), add_special_tokens=False).ids
        assert sum(r["length"] for r in by_doc[i]) == len(ids) + 1
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_every_stage_takes_odd_rows(spark, sf_dir, tmp_path, name, stage):
    spark.createDataFrame([(0, 1), (2, 1), (7, 0), (9, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (frame(spark), frame(spark, []).limit(0)):
        out = stage(spark, docs, str(tmp_path))
        rows = out.collect()
        if name != "packing":
            assert out.columns == docs.columns and len(rows) <= len(TEXTS)
        if docs.isEmpty():
            assert not rows


def test_stage_order_and_numbers(spark, sf_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "personal_data", "packing"]
    docs = table(spark, sf_dir, "documents")
    exact = corpus_pipeline.exact(spark, docs, sf_dir)
    sizes = Counter(exact_groups([(r["doc_id"], r["text"]) for r in docs.collect()]).keys())
    assert exact.count() == len(sizes) and exact.columns == docs.columns
    clean = corpus_pipeline.personal(spark, docs, sf_dir)
    assert clean.count() == docs.count() and rows_of(clean.where("length(text) != n_chars"), "doc_id") == []

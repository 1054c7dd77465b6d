"""Registered queries over a whole given table, against the libraries; the classifier's updates one by one."""

import math
import random
from hashlib import sha256
from pathlib import Path
from zlib import crc32

import numpy as np
import pytest
from tokenizers import Tokenizer

from meterlake.llm import bitmaps, common, disclosure, ftrl
from meterlake.llm.queries import BYTES, QUERIES, WORDS


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def library_ids(path, texts):
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    return library, {i: np.array(e.ids, "<u4") for (i, _), e in zip(sorted(texts.items()), library.encode_batch([t for _, t in sorted(texts.items())], add_special_tokens=False))}


def test_op3_equals_the_library(spark, sf_dir, texts):
    library, ids = library_ids(WORDS, texts)
    want = {i: (len(x), sha256(x.tobytes()).hexdigest(), sha256(library.decode(x.tolist(), skip_special_tokens=False).encode()).hexdigest()) for i, x in ids.items()}
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op3_chunk_reuse"](spark, sf_dir).collect()}
    assert got == want


def test_op6_equals_the_library(spark, sf_dir, texts):
    _, ids = library_ids(WORDS, texts)
    start, want = 0, {}
    for i in sorted(ids):
        x = np.append(ids[i], 2).astype("<u4")
        want[i] = (start, len(x), crc32(x.tobytes()))
        start += len(x)
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in QUERIES["op6_records"](spark, sf_dir).collect()} == want


def test_op10_pieces_are_whole_and_gapless(spark, sf_dir, texts):
    _, ids = library_ids(BYTES, texts)
    rows = QUERIES["op10_packing"](spark, sf_dir).collect()
    sequences, total = {}, 0
    for i in ids:
        mine = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        x = np.append(ids[i], 2).astype("<u4")
        assert [r["piece"] for r in mine] == list(range(len(mine))) and sum(r["length"] for r in mine) == len(x)
        at = 0
        for r in mine:
            assert r["start"] == at and r["ids_crc32"] == crc32(x[at : at + r["length"]].tobytes()) and r["length"] <= 1024
            at += r["length"]
        assert len(mine) == 1 or all(r["length"] == 1024 for r in mine[1:])
        total += len(x)
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= 1.1 * math.ceil(total / 1024) + 1


def plain_ftrl(rows, passes=3, alpha=0.5, beta=1.0, l1=0.02, l2=0.1):
    """The published per-coordinate update, in dictionaries of Python numbers."""
    z, n = {}, {}
    share = sum(y for *_, y in rows) / len(rows)

    def weight(i):
        zi = z.get(i, 0.0)
        return 0.0 if abs(zi) <= l1 else -(zi - math.copysign(l1, zi)) / ((beta + math.sqrt(n.get(i, 0.0))) / alpha + l2)

    for _ in range(passes):
        for index, value, y in rows:
            x = {**dict(zip(index.tolist(), value.tolist())), "bias": 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - y) * v * 0.5 / (share if y else 1 - share)
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z}


def test_op9_updates_and_scores_against_brute_force():
    rnd = random.Random(1)
    words = {0: "click here buy now free win cash".split(), 1: "river stone quiet morning walked under trees".split()}
    texts = [(" ".join(rnd.choice(words[y] + words[1 - y][:2]) for _ in range(rnd.randint(1, 30))), y) for y in (0, 1) * 20 + (0,) * 9]
    rows = [(*ftrl.features(t), y) for t, y in texts]
    model, want = ftrl.train(rows), plain_ftrl(rows)
    assert model.bias == pytest.approx(want["bias"], abs=1e-9)
    assert {i: w for i, w in enumerate(model.weights.tolist()) if w} == pytest.approx({i: w for i, w in want.items() if i != "bias" and w}, abs=1e-6)
    for t, _ in texts:
        index, value = ftrl.features(t)
        assert model.score(t) == pytest.approx(1 / (1 + math.exp(-(want["bias"] + sum(want.get(i, 0.0) * v for i, v in zip(index.tolist(), value.tolist()))))), abs=1e-5)


def test_what_is_broadcast_is_bounded():
    """Every forced broadcast of the package is one of these, and none grows with the data."""
    root = Path(common.__file__).parent
    found = sorted(p.name for p in root.glob("*.py") for line in p.read_text().splitlines() if "broadcast(" in line)
    assert found == sorted(["bitmaps.py", "common.py", "disclosure.py", "ftrl.py", "ftrl.py", "ns_bounds.py"])
    assert bitmaps.SLOTS == 1 << 25 and disclosure.FILTER_BITS == 1 << 23 and ftrl.BITS == 18  # 4 MiB, 1 MiB, 2 MiB of weights; a labelled sample; a model of fixed size; one row a cluster

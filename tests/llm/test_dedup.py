import random
import re
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest

from conftest_llm import TEXTS, frame, plain
from meterlake.llm import exact_dedup, graph, order_minhash

SQUEEZE = re.compile(r"[\x20\x09-\x0d]+")


def exact_groups(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[SQUEEZE.sub(" ", t or "")].append(i)
    return groups


@pytest.mark.parametrize("slots", [1 << 6, 1 << 25])  # a full filter changes nothing
def test_copies(odd, slots):
    groups = exact_groups(TEXTS)
    want = Counter()
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for i in ids:
            want[i, keep, len(ids), i == keep, sha256(text.encode()).hexdigest()] += 1
    got = Counter(tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in exact_dedup.copies(odd, slots=slots).collect())
    assert got == want


def test_deduplicated_rows(odd, none):
    out = exact_dedup.deduplicate(odd)
    assert out.schema == odd.schema
    want = Counter((min((i for i in ids if i is not None), default=None), SQUEEZE.sub(" ", t)) for t, ids in exact_groups(TEXTS).items())
    assert Counter((r["doc_id"], SQUEEZE.sub(" ", r["text"] or "")) for r in out.collect()) == want
    assert exact_dedup.deduplicate(none).count() == 0 and exact_dedup.copies(none).count() == 0


def test_main_path_is_native(odd):
    plan = exact_dedup.copies(odd)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def brute_components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("links", [
    [], [(1, 2)], [(1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (6, 7)], [(9, 1), (9, 2), (9, 3)], [(5, 4), (3, 4), (3, 2), (1, 2), (8, 7), (1, 1)],
    [(random.Random(4).randint(0, 60), random.Random(k).randint(0, 60)) for k in range(50)], [(random.Random(k).randint(0, 200), random.Random(k + 999).randint(0, 200)) for k in range(120)]])
def test_components(spark, links):
    df = spark.createDataFrame(links, "a long, b long")
    links = [(a, b) for a, b in links if a != b]
    got = {r["node"]: r["root"] for r in graph.components(df).collect()}
    assert got == brute_components({x for p in links for x in p}, links)


def lcs(a, b, band):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + 1 if x == y and abs(i - j) <= band else 0)
    return best[-1][-1]


@pytest.mark.parametrize("seed", range(25))
def test_banded_alignment(seed):
    rnd = random.Random(seed)
    n, k = rnd.randint(0, 160), rnd.choice([2, 6, 60])
    a = [rnd.randrange(k) for _ in range(n)]
    b = list(a)
    for _ in range(rnd.randint(0, 30)):
        at = rnd.randint(0, len(b))
        b[at : at + rnd.randint(0, 2)] = [rnd.randrange(k) for _ in range(rnd.randint(0, 2))]
    x, y = np.array(a, np.uint32), np.array(b, np.uint32)
    for band in (1, 9, 400):
        assert order_minhash._banded(x, y, band) == lcs(a, b, band)
    whole = lcs(a, b, 10**6) / max(len(a), len(b)) if a or b else 1.0
    got = order_minhash.aligned(x, y)
    assert (got >= 0.8) == (whole >= 0.8) and got <= max(whole, 0.8)


def test_occurrences_and_order_count():
    hashes = lambda s: set(order_minhash.sketch_keys(order_minhash.shingles(order_minhash.word_hashes(s))).tolist())
    words = [f"w{i}" for i in range(200)]
    assert hashes(words) == hashes(list(words))
    assert not hashes(words) & hashes(words[100:] + words[:100])  # the same shingles but for the seam, in another order
    marks = order_minhash.shingles(order_minhash.word_hashes(["same"] * 50))
    assert len(set(marks.tolist())) == 46  # each occurrence is one of its own


def edited(rnd, words, n):
    out = list(words)
    for _ in range(n):
        at = rnd.randrange(len(out))
        out[at : at + 1] = rnd.choice([[], [f"new{rnd.random()}"], [out[at], f"more{rnd.random()}"]])
    return out


def corpus():
    """Copies, near copies (also of each other only), texts sharing a long passage, and texts of their own."""
    rnd = random.Random(8)
    word = lambda: f"t{rnd.randrange(9_000)}"
    rows = []
    for size in (12, 40, 150, 400):
        for _ in range(6):
            base = [word() for _ in range(size)]
            rows += [base, base, *[edited(rnd, base, max(1, size // 100)) for _ in range(4)]]
    passage = [word() for _ in range(120)]
    rows += [[word() for _ in range(60)] + passage + [word() for _ in range(60)] for _ in range(40)]
    rows += [[word() for _ in range(rnd.randint(1, 300))] for _ in range(60)]
    rnd.shuffle(rows)
    return [(k, " ".join(w).capitalize() + ".") for k, w in enumerate(rows)]


def test_classes_against_all_pairs(spark):
    rows = corpus()
    words = {i: order_minhash.word_hashes(order_minhash.words_of(t)).astype(np.uint32) for i, t in rows}
    marks = {i: Counter(order_minhash.shingles(order_minhash.word_hashes(order_minhash.words_of(t))).tolist()) for i, t in rows}
    ids = sorted(words)
    linked = [(a, b) for a in ids for b in ids if a < b and order_minhash.aligned(words[a], words[b]) >= 0.8]
    close = [(a, b) for a, b in linked if sum((marks[a] & marks[b]).values()) >= 0.8 * sum((marks[a] | marks[b]).values())]
    most, least = brute_components(ids, linked), brute_components(ids, close)
    got = {r["doc_id"]: (r["class_id"], r["class_size"]) for r in order_minhash.classes(plain(spark, rows)).collect()}
    missed = [(a, b) for a, b in close if got[a][0] != got[b][0]]
    assert not missed  # every pair of similar shingles
    for i in ids:  # and nothing that does not align
        assert most[got[i][0]] == most[i] and got[i][0] <= least[i]
    assert Counter(c for c, _ in got.values()) == {c: n for c, n in {v for v in got.values()}}


def test_a_bucket_without_its_head(spark):
    """Two near copies that share a passage with an unlike smaller text still meet each other."""
    rnd = random.Random(2)
    passage = [f"p{k}" for k in range(400)]
    pair = [f"q{k}" for k in range(300)]
    rows = [(0, " ".join([f"z{rnd.random()}" for _ in range(160)] + passage)), (1, " ".join(passage + pair)), (2, " ".join(passage + edited(rnd, pair, 2)))]
    rows += [(k, " ".join([f"y{k}_{j}" for j in range(200)] + passage)) for k in range(3, 40)]
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.classes(plain(spark, rows)).collect()}
    assert got[2] == 1 and got[1] == 1 and len(set(got.values())) == 39


def test_common_text_inside_the_head(spark):
    """A passage, two edited copies of it, and many longer texts that hold it and are unlike all of these and each other."""
    rnd = random.Random(5)
    passage = [f"b{k}" for k in range(100)]
    copies = [passage, passage[:30] + ["one"] + passage[31:], passage[:70] + ["two"] + passage[71:]]
    texts = copies + [[f"x{k}_{j}" for j in range(20)] + passage + [f"y{k}_{j}" for j in range(20)] for k in range(1_000)]
    order = list(range(len(texts)))
    rnd.shuffle(order)
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.classes(plain(spark, [(i, " ".join(texts[i])) for i in order])).collect()}
    words = [order_minhash.word_hashes(t).astype(np.uint32) for t in texts[:60]]
    want = brute_components(range(60), [(a, b) for a in range(60) for b in range(a) if order_minhash.aligned(words[a], words[b]) >= 0.8])
    assert [got[i] for i in range(60)] == [want[i] for i in range(60)] and len(set(got.values())) == 1_001


def test_alike_members_stay_candidates(spark):
    """A text that is only alike to one which is alike to the heads of all their buckets."""
    text = [f"m{k}" for k in range(200)]
    texts = [text, text[:-7]] + [text + [f"e{k}_{j}" for j in range(48)] for k in range(120)]
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.classes(plain(spark, [(i, " ".join(t)) for i, t in enumerate(texts)])).collect()}
    words = [order_minhash.word_hashes(t).astype(np.uint32) for t in texts]
    assert order_minhash.aligned(words[0], words[1]) >= 0.8 > order_minhash.aligned(words[1], words[2])
    assert set(got.values()) == {0} and len(got) == 122


def test_near_edges(odd, none):
    got = defaultdict(set)
    for r in order_minhash.classes(odd).collect():
        got[r["doc_id"]].add((r["class_id"], r["class_size"]))
    assert got[0] == got[1] == got[2] == got[10] == {(0, 5)}  # with the one that has no id
    assert got[None] == {(0, 5), (None, 1)}
    assert got[3] == got[4] == got[5] == {(3, 3)} and got[12] == {(11, 3)} and got[7] == {(7, 1)}
    out = order_minhash.deduplicate(odd)
    assert out.schema == odd.schema
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in out.collect()) == [-1, 0, 3, 6, 7, 8, 9, 11, 13]
    assert order_minhash.classes(none).count() == 0 and order_minhash.deduplicate(none).count() == 0


def test_stages_keep_columns_of_any_name(spark):
    df = frame(spark, [(1, "one text"), (2, "another text")])
    assert order_minhash.deduplicate(exact_dedup.deduplicate(df)).columns == df.columns


@pytest.mark.parametrize("block", [5, 256])  # a bucket in many blocks, or in one
def test_texts_unlike_the_head_of_their_bucket_meet_each_other(spark, tmp_path, monkeypatch, block):
    """All share one key, the smallest is unlike every other, and the others are alike two by two: one look at the head finds none of them."""
    monkeypatch.setattr(order_minhash, "_BLOCK", block)
    rows = [(bytes([0]), [7], np.arange(20, dtype=np.uint32).tobytes())]
    for i in range(1, 41):
        words = np.arange(20, dtype=np.uint32) + 1000 * ((i + 1) // 2)
        words[-1] += i
        rows.append((bytes([i]), [7, 100 + i], words.tobytes()))
    spark.createDataFrame([(bytearray(n), k, bytearray(w)) for n, k, w in rows], "node binary, keys array<bigint>, words binary").write.parquet(f"{tmp_path}/rows")
    got = {(r["a"][0], r["b"][0]) for r in order_minhash.linked(spark.read.parquet(f"{tmp_path}/rows"), looks=1).collect()}
    assert got == {(i, i + 1) for i in range(1, 41, 2)}


def test_alignment_ends_early_only_below_the_similarity():
    rnd = random.Random(11)
    for _ in range(150):
        n = rnd.randint(60, 700)
        a = [rnd.randrange(400) for _ in range(n)]
        b = edited(rnd, a, int(n * rnd.choice([0.05, 0.15, 0.25, 0.4])))
        code: dict = {}
        x, y = (np.array([code.setdefault(w, len(code)) for w in t], np.uint32) for t in (a, b))
        most = max(len(x), len(y))
        whole = order_minhash._banded(x, y, most)
        for band in (64, most):
            exact, got = order_minhash._banded(x, y, band), order_minhash._banded(x, y, band, 0.8 * most)
            assert got == exact or exact <= got < 0.8 * most
        assert (order_minhash.aligned(x, y) >= 0.8) == (whole >= 0.8 * most)


@pytest.mark.parametrize("block", [7, 1_024])
def test_pairs_without_enough_common_words_become_no_rows(spark, tmp_path, monkeypatch, block):
    """300 texts share a key and a passage, and two of them are alike: the bucket has 44,850 pairs, of which only that one is left to be aligned."""
    monkeypatch.setattr(order_minhash, "_BLOCK", block)
    passage = np.arange(100, dtype=np.uint32)
    texts = [np.concatenate([passage, np.random.default_rng(i).integers(1 << 20, 1 << 31, 160).astype(np.uint32)]) for i in range(300)]
    texts[7] = texts[200].copy()
    texts[7][-20:] = np.arange(5_000, 5_020, dtype=np.uint32)
    texts += [np.full(1_000, 9, np.uint32), np.concatenate([np.full(900, 9, np.uint32), np.arange(100, 200, dtype=np.uint32)])]  # counts beyond a byte
    node = lambda i: i.to_bytes(4, "big")
    spark.createDataFrame([(bytearray(node(i)), [1], bytearray(w.tobytes())) for i, w in enumerate(texts)], "node binary, keys array<bigint>, words binary").write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    seen = spark.createDataFrame([(bytearray(node(0)), bytearray(node(i)), False) for i in range(1, len(texts))], "a binary, b binary, alike boolean")
    pairs, words = order_minhash._left_out(seen, [], rows, 0.8)
    want = {(7, 200), (300, 301)}
    read = lambda df: {tuple(int.from_bytes(r[c], "big") for c in "ab") for r in df.collect()}
    assert read(pairs) == want and read(order_minhash._alike(pairs, words, 0.8)) == want


@pytest.mark.parametrize("block", [7, 1_024])
def test_pairs_left_over_become_rows_only_as_links(spark, tmp_path, monkeypatch, block):
    """80 texts of the same words share two keys, four times twenty of them in an order of their own; the bucket has 3,160 pairs that counts of words allow, and 760 that are alike; 76 links connect them."""
    monkeypatch.setattr(order_minhash, "_BLOCK", block)
    order = [np.random.default_rng(i).permutation(200).astype(np.uint32) for i in range(4)]
    texts = [np.arange(900, 1_100, dtype=np.uint32), *[np.roll(order[i % 4], i // 4) for i in range(80)]]
    node = lambda i: i.to_bytes(4, "big")
    spark.createDataFrame([(bytearray(node(i)), [1, 2], bytearray(w.tobytes())) for i, w in enumerate(texts)], "node binary, keys array<bigint>, words binary").write.parquet(f"{tmp_path}/rows")
    seen = spark.createDataFrame([(bytearray(node(0)), bytearray(node(i)), False) for i in range(1, len(texts))], "a binary, b binary, alike boolean")
    found, _ = order_minhash._left_out(seen, [], spark.read.parquet(f"{tmp_path}/rows"), 0.8)
    links = [tuple(int.from_bytes(r[c], "big") for c in "ab") for r in found.collect()]
    assert len(links) == 76 if block > 80 else len(links) < 760
    assert brute_components(range(1, 81), links) == {i: (i - 1) % 4 + 1 for i in range(1, 81)}

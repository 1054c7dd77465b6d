import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest_llm import TEXTS
from meterlake.llm import packing, records
from meterlake.session import scratch_path

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def one_by_one(lengths, capacity):
    """Best-fit decreasing by looking at every open bin."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fitting = [r for r in rooms if r >= n]
        if fitting:
            rooms[rooms.index(min(fitting))] -= n
        else:
            rooms.append(capacity - n)
    return Counter(rooms)


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_best_fit_decreasing(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([7, 20, 64, 100])
    lengths = [rnd.randint(1, capacity) for _ in range(rnd.choice([0, 1, 5, 60, 400]))]
    if seed % 3 == 0:
        lengths = [rnd.choice(lengths[:3]) for _ in lengths] if lengths else lengths
    used = defaultdict(list)
    placed = Counter()
    runs = sorted(packing.best_fit(Counter(lengths), capacity))
    for length, n in Counter(lengths).items():
        own = [r for r in runs if r[0] == length]
        for rank in range(n):
            run = [r for r in own if r[1] <= rank][-1]
            into = rank - run[1]
            used[run[2] + into // run[3]].append((run[4] + into % run[3] * length, length))
            placed[length] += 1
    assert placed == Counter(lengths)
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert Counter(capacity - sum(n for _, n in p) for p in used.values()) == one_by_one(lengths, capacity)


def test_segment_tree():
    rnd = random.Random(3)
    tree, there = packing.OpenBins(50), set()
    for _ in range(2_000):
        k, on = rnd.randint(0, 50), rnd.random() < 0.5
        tree.mark(k, on)
        (there.add if on else there.discard)(k)
        need = rnd.randint(0, 50)
        assert tree.tightest(need) == min((x for x in there if x >= need), default=None)


def test_packed_documents(odd, none):
    lib = Tokenizer.from_file(BYTES)
    rows = packing.packed(odd, BYTES, end_id=2, capacity=1024).collect()
    want = Counter((i, tuple([*lib.encode(t or "", add_special_tokens=False).ids, 2])) for i, t in TEXTS)
    by_doc, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sum(r["length"] for r in rows) == sum(len(ids) * n for (_, ids), n in want.items())
    for (i, ids), n in want.items():
        if len([1 for (j, _) in want.elements() if j == i]) == 1:
            got = sorted(by_doc[i], key=lambda r: r["piece"])
            assert b"".join(bytes(r["ids"]) for r in got) == np.array(ids, "<u4").tobytes()
            assert [r["piece"] for r in got] == list(range(len(got))) and all(r["length"] == 1024 for r in got[1:])
            assert [r["start"] for r in got] == [sum(x["length"] for x in got[:k]) for k in range(len(got))]
    for parts in bins.values():
        ends = [0]
        for offset, length in sorted(parts):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 1024
    assert Counter(1024 - sum(n for _, n in p) for p in bins.values()) == one_by_one([r["length"] for r in rows], 1024)
    assert packing.packed(none, BYTES).count() == 0


def test_sequences_hold_the_pieces(odd):
    placed = packing.packed(odd, BYTES, capacity=64).cache()
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(placed).collect()}
    for r in placed.collect():
        assert whole[r["sequence_id"]][4 * r["offset"] : 4 * (r["offset"] + r["length"])] == bytes(r["ids"])


def test_records_round_trip(spark, odd):
    folder = scratch_path(spark, "records")
    shards = records.write_records(odd, folder, WORDS, end_id=2, shards=3)
    index = records.read_index(spark, folder, shards)
    lib = Tokenizer.from_file(WORDS)
    want = [(i, [*lib.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in TEXTS]
    rows = sorted(records.read_at(spark, folder, index).collect(), key=lambda r: r["start"])
    assert [r["id"] for r in rows] == sorted((i for i, _ in TEXTS), key=lambda i: (i is not None, i or 0))
    assert Counter((r["id"], bytes(r["ids"])) for r in rows) == Counter((i, np.array(x, "<u4").tobytes()) for i, x in want)
    assert [r["start"] for r in rows] == [sum(len(r["ids"]) // 4 for r in rows[:k]) for k in range(len(rows))]
    mixed = records.read_at(spark, folder, records.shuffled(index, seed=5).limit(6)).collect()
    assert {(r["id"], r["start"], bytes(r["ids"])) for r in mixed} <= {(r["id"], r["start"], bytes(r["ids"])) for r in rows} and len(mixed) == 6


def test_records_of_nothing(spark, none):
    folder = scratch_path(spark, "records")
    shards = records.write_records(none, folder, WORDS, end_id=2)
    assert records.read_at(spark, folder, records.read_index(spark, folder, shards)).count() == 0


def test_broken_record_is_refused():
    import io

    good = records.frame(b"payload")
    assert records.unframe(io.BytesIO(good).read, "here") == b"payload"
    assert struct.unpack("<Q", good[:8])[0] == 7 and good[8:12] != struct.pack("<I", zlib.crc32(good[:8]))
    for k in range(len(good)):
        bad = good[:k] + bytes([good[k] ^ 1]) + good[k + 1 :]
        with pytest.raises(ValueError):
            records.unframe(io.BytesIO(bad).read, "here")

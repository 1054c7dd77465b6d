"""Conversation repair against a search through all edits, and against SQL."""

import random
import re
from hashlib import sha256
from itertools import product
from pathlib import Path
from zlib import crc32

import compare
import pytest
from pyarrow import fs

from meterlake.llm import structure_repair as sr

GOOD = re.compile(r"(s?(ua)+)?")
COLUMNS = "conv_id long, turn long, role string, text string, audit string, part int"


def search(rows):
    """(cost, audit, initials) of the cheapest edits of (initial, fault) rows, by trying all with at most two inserted turns in a place."""
    best = None
    inserts = ["", "u", "a", "ua", "au"]
    options = [[("D", 4, "")] + ([] if fault == sr.GONE else [(e, c + 3 * (fault == sr.TRUNCATED), g) for e, c, g in (("K", 0, initial), ("R", 3, "u"), ("R", 3, "a"))]) for initial, fault in rows]
    for edits in product(*options):
        base = sum(c for _, c, _ in edits)
        if best and base > best[0]:
            continue
        for more in product(inserts, repeat=len(rows) + 1):
            cost = base + 3 * sum(map(len, more))
            if best and cost > best[0]:
                continue
            if GOOD.fullmatch("".join(m + g for m, (_, _, g) in zip(more, edits)) + more[-1]):
                audit = "".join("I" * len(m) + e for m, (e, _, _) in zip(more, edits)) + "I" * len(more[-1])
                best = min(best, (cost, audit)) if best else (cost, audit)
    return best


def test_cheapest_and_least_edits_equal_a_search():
    r = random.Random(11)
    cases = [list(c) for n in range(3) for c in product(product("suax", range(3)), repeat=n)] + [[(r.choice("suuaaax"), r.choice([0, 0, 0, 1, 2])) for _ in range(r.choice([3, 3, 4]))] for _ in range(120)]
    for rows in cases:
        repair = sr.Repair()
        for initial, fault in rows:
            repair.add(initial, fault)
        assert repair.edits() == search(rows), rows


def test_backpointers_spill_and_are_removed(tmp_path):
    r = random.Random(2)
    rows = [(r.choice("suax"), r.choice([0, 0, 1, 2])) for _ in range(5_000)]
    spilled, held = sr.Repair(lambda: (fs.LocalFileSystem(), str(tmp_path / "back")), spill=1 << 8), sr.Repair()
    for row in rows:
        spilled.add(*row), held.add(*row)
    assert (tmp_path / "back").exists() and len(spilled.back.held) < 1 << 8
    assert spilled.edits() == held.edits()
    assert not (tmp_path / "back").exists()


def simple(turns):
    """op13's rows for a list of (conv_id, turn, role, text), by the contract's words, with the edits from a search of short conversations."""
    out = {}
    for conv in {t[0] for t in turns}:
        rows = []
        for _, turn, role, text in [t for t in turns if t[0] == conv]:
            kind = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            if kind == 0:
                continue
            row = (turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            rows += [row] * (2 if kind == 3 else 1)
        rows.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        seen, faults = set(), []
        for _, role, text in rows:
            visible = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else "")
            seen.add((role, text))
        kinds = [sr.TRUNCATED if f == "truncated" else sr.GONE if f else sr.FINE for f in faults]
        cost, audit = search([(role[:1] or "?", kind) for (_, role, _), kind in zip(rows, kinds)]) if rows else (0, "")
        said, at, initials = [], 0, ""
        for edit in audit:
            expected = "a" if initials.endswith("u") else "u"
            name = {"a": "assistant", "u": "user"}[expected]
            if edit == "I":
                said.append(f"{name}:")
                initials += expected
                continue
            _, role, text = rows[at]
            at += 1
            if edit != "D":
                said.append(f"{role if edit == 'K' else name}:{text}")
                initials += role[0] if edit == "K" else expected
        numbers = [t for t, *_ in rows if t is not None]
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])), cost, audit, sha256("\n".join(said).encode()).hexdigest())
    return out


def query(rows):
    found = sr.audits(rows)
    texts = {r["conv_id"]: r["repaired_sha256"] for r in sr.digests(sr.repaired(rows, found)).collect()}
    return {r["conv_id"]: (*tuple(r)[1:], texts.get(r["conv_id"], sr.NO_TURNS)) for r in found.collect()}


def test_rows_of_all_kinds(spark):
    r = random.Random(4)
    texts = ["A whole sentence.", "cut off", " \n", "", "Is it? ", "Is it? ", None, "ends in white space.\n\t", "a ", "!", "word" * 40_000 + "."]
    turns = [(c, turn, r.choice(["user", "assistant", "assistant", "system", "tool", "", None, "unknown"]), r.choice(texts)) for c in [*range(40), None, 1 << 60] for turn in r.sample([None, 0, 1, 2, 3, 5, -4, 1 << 60], 3)]
    turns += turns[:6] + [(77, None, None, None), (78, None, "user", "Hello."), (78, None, "assistant", "Yes.")]  # repeated rows; turns all null
    frame = spark.createDataFrame([(*t, None, 1) for t in turns], COLUMNS)  # extra columns with names used inside
    assert query(sr.damaged(frame)) == simple(turns)


def test_conversations_without_rows_after_damage(spark):
    gone = next(t for t in range(1_000) if crc32(f"5:{t}".encode()) % 20 == 0)
    frame = spark.createDataFrame([(5, gone, "user", "All of it.")], "conv_id long, turn long, role string, text string")
    assert query(sr.damaged(frame)) == {5: (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())}
    assert query(sr.damaged(frame.limit(0))) == {}


def test_giant_conversation_streams_with_a_small_buffer(spark):
    n = 30_000
    rows = sr.prepared(spark.range(n).selectExpr("1L as conv_id", "id as turn", "if(id % 7 = 3, 'tool', if(id % 2 = 0, 'user', 'assistant')) as role", "concat('turn ', id, '.') as text"))
    found = sr.audits(rows, spill=1 << 10).collect()
    assert len(found) == 1
    repair = sr.Repair()
    for k in range(n):
        repair.add("t" if k % 7 == 3 else "u" if k % 2 == 0 else "a", sr.FINE)
    assert (found[0]["cost"], found[0]["audit"]) == repair.edits()
    turns = sr.repaired(rows, sr.audits(rows)).orderBy("position").collect()
    assert GOOD.fullmatch("".join(t["role"][0] for t in turns)) and [t["position"] for t in turns] == list(range(len(turns)))


def test_texts_shuffle_once_for_the_audits(spark):
    rows = sr.damaged(spark.createDataFrame([(1, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string"))
    assert sr.audits(rows)._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf_dir, scale):
    folder = str(Path(sf_dir).parent / scale)
    if not Path(folder).exists():
        pytest.skip("provided tables not found")
    assert compare.differences(sr.op13(spark, folder), compare.connect(folder), sr.OP13_SQL) == []

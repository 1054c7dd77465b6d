import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest_llm import TEXTS, plain
from meterlake.llm import disclosure

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def fits(kind, found):
    digits = [int(c) for c in found if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        total = sum(d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9) for k, d in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if fits(k, m[0])]


@given(st.lists(st.sampled_from(["a", "b.c", "@", "x@y.zz", "@q-1.de.", ".", "1", "255.1", "192.168.0.1", "300", " ", "-", "+1", "+49 (30) 555-01", "4111 1111 1111 1111", "4111111111111111", "é", "00", "(", "%"]), max_size=30))
@settings(max_examples=800, deadline=None)
def test_base_spans(parts):
    text = "".join(parts)
    assert disclosure.base_spans(text) == brute(text)


def test_long_runs_take_linear_time():
    text = "a" * 300_000 + " " + "1" * 300_000 + " " + "a@" * 50_000 + "+1" * 50_000 + "9." * 100_000
    assert disclosure.base_spans(text)


def planted():
    """An address that always stands with the same rare name, among different words; common words; copies of one text."""
    filler = ["the", "of", "and", "with", "for", "from"]
    rows = []
    for k in range(40):
        rows.append(f"{filler[k % 6]} text number{chr(97 + k % 26)}{k} {filler[(k + 1) % 6]} nothing special about it the of and")
    for k in range(6):
        rows.append(f"unlike{k}x the report of Zebulon {'alpha beta gamma delta'.split()[k % 4]} at zeb@mail.example.com and the{k}y of other{k}z words")
    rows += ["copy with Copyword near dup@mail.example.com and the end"] * 30
    rows.append("Zebulon without the address")
    return list(enumerate(rows))


def test_terms_that_disclose(spark):
    rows = planted()
    flagged = {(r["entity"], r["term"]) for r in disclosure.disclosing(plain(spark, rows)).collect()}
    assert ("email:zeb@mail.example.com", "zebulon") in flagged
    assert not {t for _, t in flagged} & {"the", "of", "and", "copyword"}
    got = {r["doc_id"]: r["terms"] for r in disclosure.found(plain(spark, rows)).collect()}
    for i, text in rows:
        spans = {(s["start"], s["end"]) for s in got[i]}
        if "zeb@" in text:
            at = text.index("Zebulon")
            assert (at, at + 7) in spans
        else:
            assert not spans


def brute_shares(rows, support=disclosure.SUPPORT):
    """The same estimate over different texts, counted in one process."""
    import math
    from collections import Counter

    texts = sorted(set(rows))
    held, terms, mark = {}, {}, {}
    for t in texts:
        spans = brute(t)
        held[t] = {disclosure.entity_of(k, t[a:b]) for k, a, b in spans}
        masked = "".join(" " if any(a <= i < b for _, a, b in spans) else c for i, c in enumerate(t))
        terms[t] = set(re.findall(r"[^\W\d_]+", masked.lower()))
        mark[t] = disclosure.near_copy_mark(t, spans)
    everywhere = Counter(w for t in texts for w in set(re.findall(r"[^\W\d_]+", t.lower())))

    def different(found):
        n = Counter(mark[t] for t in found)
        return sum(n.values()) ** 2 / sum(k * k for k in n.values())

    out = {}
    for e in set().union(*held.values()):
        mine = [t for t in texts if e in held[t]]
        for w in set().union(*(terms[t] for t in mine)):
            both = [t for t in mine if w in terms[t]]
            if different(mine) >= support and different(both) >= support:
                own = -math.log2(len(mine) / len(texts))
                share = min(1.0, math.log2(len(both) / len(mine) / ((everywhere[w] + 1) / len(texts))) / own) if own > 0 else 0.0
                if share >= disclosure.DISCLOSURE:
                    out[e, w] = share
    return out


def shares(spark, rows):
    return {(r["entity"], r["term"]): r["share"] for r in disclosure.disclosing(plain(spark, list(enumerate(rows)))).collect()}


def test_shares_against_brute_force(spark):
    rows = [t for _, t in planted()]
    got = shares(spark, rows)
    assert got == pytest.approx(brute_shares(rows)) and got


def random_words(rnd, n):
    return " ".join("".join(rnd.choice("bcdfglmnprst") + rnd.choice("aeiou") for _ in range(rnd.randint(3, 5))) for _ in range(n))


def signatures(n=300, others=600):
    """Different documents with one signature, among others."""
    import random

    rnd = random.Random(12)
    signed = [f"{random_words(rnd, 40)}. Contact Johnx Smithy at js@mail.example.com or call" for _ in range(n)]
    return signed + [f"{random_words(rnd, 40)} contact at or call" for _ in range(others)]


def test_a_signature_discloses_its_names(spark):
    got = {t for e, t in shares(spark, signatures()) if e == "email:js@mail.example.com"}
    assert got == {"johnx", "smithy"}


def test_copies_do_not_change_a_share(spark):
    rows = signatures(5, 100)
    assert shares(spark, rows + [rows[0]] * 3_000) == shares(spark, rows) == pytest.approx(brute_shares(rows))


def test_edited_copies_of_one_text_prove_nothing(spark):
    import random

    rnd = random.Random(3)
    rows = signatures(0, 400)
    words = f"{random_words(rnd, 60)} write to Johnx Smithy at js@mail.example.com or call {random_words(rnd, 60)}".split()
    for k in range(200):
        at = rnd.randrange(50)
        rows.append(" ".join([*words[:at], random_words(rnd, 1), *words[at + 1 :]]))
    assert shares(spark, rows) == {}


def test_names_far_from_the_address_disclose_too(spark):
    import random

    rnd = random.Random(5)
    rows = [f"Zebulon {random_words(rnd, 60)} js@mail.example.com {random_words(rnd, 20)}" for _ in range(30)] + [random_words(rnd, 80) for _ in range(300)]
    got = shares(spark, rows)
    assert set(got) == {("email:js@mail.example.com", "zebulon")} and got == pytest.approx(brute_shares(rows))


def test_sanitised_texts(spark):
    rows = planted()
    out = {r["doc_id"]: r["text"] for r in disclosure.sanitised(plain(spark, rows)).collect()}
    for i, text in rows:
        assert "@" not in out[i]
        if "zeb@" in text:
            assert "Zebulon" not in out[i] and "[EMAIL]" in out[i] and "[TERM]" in out[i]
    gone = {r["doc_id"]: r["text"] for r in disclosure.sanitised(plain(spark, rows), remove_terms=True).collect()}
    assert not any("[TERM]" in t for t in gone.values())


def test_overlapping_spans():
    assert disclosure.replace("abcdefgh", [("card", 1, 4), ("phone", 3, 6), ("ip", 3, 4)]) == "a[CARD]gh"
    assert disclosure.replace("abc", []) == "abc"


def test_edges(odd, none):
    rows = disclosure.found(odd).collect()
    assert len(rows) == len(TEXTS)
    kinds = next(r for r in rows if r["doc_id"] == 9)["spans"]
    assert [s["kind"] for s in kinds] == ["email", "ip", "card", "phone"]
    out = disclosure.sanitised(odd)
    assert out.schema == odd.schema
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[3] is None and texts[4] == "" and texts[9] == "mail me: [EMAIL] or [PHONE], [CARD], [IP]"
    assert disclosure.found(none).count() == 0 and disclosure.sanitised(none).count() == 0


def test_query(spark, sf_dir):
    from hashlib import sha256

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = disclosure.op8(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = brute(texts[r["doc_id"]])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == sha256(joined.encode()).hexdigest() and r["spans"].startswith(joined)
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in spans) for k in PATTERNS]

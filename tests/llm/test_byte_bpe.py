"""Byte-level BPE against the tiktoken library and the tokenizers library's own offsets."""

import random
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest_llm import ODD_TEXTS

from meterlake.llm import byte_bpe
from meterlake.llm.common import table
from meterlake.llm.queries import RANKS

PARTS = ["ab", "a", "-", "--", "=", "_", " ", "  ", "\n", "é", "漢", "🙂", "‍", "<|endoftext|>", "12", "000", "aba", "…", "ß", "カ", "\0", "!", "'s", "́"]


@pytest.fixture(scope="module")
def tok():
    return byte_bpe.byte_bpe(RANKS)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


def generated(n):
    r = random.Random(3)
    for k in range(n):
        if k % 3 == 0:
            yield "".join(r.choice(PARTS) for _ in range(r.randrange(60)))
        elif k % 3 == 1:  # runs, where the ways to cut a token overlap
            yield r.choice("ab-=_ x.*#0あ") * r.randrange(1, 200) + "".join(r.choice("ab-= ") for _ in range(r.randrange(30)))
        else:
            yield "".join(chr(r.choice([r.randrange(32, 0x250), r.randrange(0x250, 0xD800), r.randrange(0xE000, 0x20000)])) for _ in range(r.randrange(40)))


def test_ids_and_bytes_equal_the_library(tok, reference):
    texts = ODD_TEXTS + list(generated(3_000))
    for text, ids in zip(texts, tok.encode(texts), strict=True):
        assert ids.tolist() == reference.encode_ordinary(text)
        assert tok.decode(ids.tolist()) == text.encode() == reference.decode_bytes(ids.tolist())


def test_offsets_equal_the_library(tok):
    texts = ODD_TEXTS[:6] + list(generated(600))
    for text, ids in zip(texts, tok.encode(texts), strict=True):
        assert [tuple(s) for s in tok.offsets(ids, text).tolist()] == tok.library.encode(text, add_special_tokens=False).offsets


def test_split_characters(tok):
    text = "a🙂b漢"
    single = np.array([tok.library.token_to_id(byte_bpe.byte_table()[b]) for b in text.encode()], "<u4")  # a token for each byte
    assert tok.offsets(single, text).tolist() == [[0, 1]] + [[1, 2]] * 4 + [[2, 3]] + [[3, 4]] * 3
    assert tok.pieces(single.tolist()) == ["a", "", "", "", "🙂", "b", "", "", "漢"]
    assert tok.pieces(single.tolist()[:3]) == ["a", "", "", "�"]  # cut off inside a character
    assert tok.decode(single.tolist()[:3]) == text.encode()[:3]


def test_byte_table_is_one_to_one():
    shown = byte_bpe.byte_table()
    assert len(set(shown.values())) == 256 and all(len(c) == 1 and c.isprintable() and not c.isspace() for c in shown.values())


def test_ids_outside_the_vocabulary_are_errors(tok):
    for i in (-1, 50_256, 10**9):
        with pytest.raises(ValueError):
            tok.decode([i])


def test_odd_rows(spark, odd, none, reference):
    rows = byte_bpe.encoded(odd, RANKS, offsets=True).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in odd.collect())
    texts = {r["doc_id"]: r["text"] or "" for r in odd.where("doc_id is not null").collect()}
    for r in rows:
        if r["doc_id"] is not None:
            assert r["ids"] == reference.encode_ordinary(texts[r["doc_id"]]) and len(r["starts"]) == len(r["ends"]) == len(r["ids"])
    back = {r["doc_id"]: bytes(r["data"]).decode() for r in byte_bpe.decoded(byte_bpe.encoded(odd, RANKS), RANKS).collect() if r["doc_id"] is not None}
    assert back == texts
    for empty in (byte_bpe.encoded(none, RANKS), byte_bpe.digests(none, RANKS)):
        assert empty.isEmpty()


def test_query_over_the_whole_table(spark, sf_dir, reference):
    from meterlake.llm.queries import QUERIES

    def want(row):
        text = row["text"] or ""
        ids = np.array(reference.encode_ordinary(text), "<u4")
        return row["doc_id"], len(ids), sha256(ids.tobytes()).hexdigest(), sha256(text.encode()).hexdigest()

    got = QUERIES["op12_byte_bpe"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want(r) for r in table(spark, sf_dir, "documents").collect())

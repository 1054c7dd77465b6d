import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest_llm import ODD_TEXTS
from meterlake.llm import chunk_reuse
from meterlake.llm.tokens import Encoder

FILES = {n: public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json")}
OURS = {n: Encoder(p) for n, p in FILES.items()}
LIBRARY = {n: Tokenizer.from_file(p) for n, p in FILES.items()}
WORDS = "word_bpe_49k.json"


@pytest.mark.parametrize("name", FILES)
def test_odd_texts(name):
    want = [LIBRARY[name].encode(t, add_special_tokens=False).ids for t in ODD_TEXTS]
    assert [x.tolist() for x in OURS[name].encode(ODD_TEXTS)] == want


@pytest.mark.parametrize("name", FILES)
@given(text=st.text(alphabet=st.sampled_from("abcdefgh'stre ÉéßñΣς漢\n\t\xa0\x85\x1c!.,0²½<|>end_́"), max_size=60))
@settings(max_examples=300, deadline=None)
def test_any_text(name, text):
    assert OURS[name].encode([text])[0].tolist() == LIBRARY[name].encode(text, add_special_tokens=False).ids


@given(st.lists(st.sampled_from(["the ", "cat's", " ", "\n", "x" * 40, "Éá", "<|endof", "text|>", "12 34", "!!?", "word word "]), max_size=60), st.integers(2, 6))
@settings(max_examples=150, deadline=None)
def test_chunks_join_to_the_whole(parts, bits):
    text = "".join(parts)
    cut = chunk_reuse.chunks(text, bits=bits, least=4)
    assert "".join(cut) == text
    got = chunk_reuse.ChunkEncoder(OURS[WORDS], bits, 4).encode([text, text])
    want = LIBRARY[WORDS].encode(text, add_special_tokens=False).ids
    assert [x.tolist() for x in got] == [want, want]


def test_shared_passages_are_encoded_once():
    passage = " ".join(f"shared{i}" for i in range(900))
    work = chunk_reuse.ChunkEncoder(OURS[WORDS], 8, 64)
    work.encode([f"first text {passage} ends", f"another start of a text {passage}"])
    assert work.reused > 0.4 * (work.encoded + work.reused)


def test_rolling_hash_sees_its_window_only():
    tail = b"0123456789abcdefghijklmnopqrstuvwxyz"
    a, b = chunk_reuse.rolling_hash(b"left" + tail), chunk_reuse.rolling_hash(b"something else" + tail)
    assert np.array_equal(a[-4:], b[-4:])


def test_operator(spark, odd, none):
    import hashlib

    rows = chunk_reuse.encode_documents(odd, FILES[WORDS], bits=6, least=32).collect()
    lib = LIBRARY[WORDS]
    from conftest_llm import TEXTS

    want = []
    for i, t in TEXTS:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, np.array(ids, "<u4").tobytes(), lib.decode(ids, skip_special_tokens=False)))
    key = lambda r: (r[0] is None, r[0] or 0, hashlib.sha256(r[1]).hexdigest())
    assert sorted(((r["id"], bytes(r["ids"]), r["decoded"]) for r in rows), key=key) == sorted(want, key=key)
    assert chunk_reuse.encode_documents(none, FILES[WORDS]).count() == 0

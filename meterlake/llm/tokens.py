"""Token ids exactly as the tokenizers library gives them, faster than by one call for each text.

The vocabulary of a tokenizers file is handed to tiktoken, which merges the same pairs in the same order. Word-level
byte pairs (lower case, white space dropped): a word always has the same ids, so a bounded cache keeps them; texts
whose splitting could depend on more than white space (special tokens, characters beyond Latin letters) go to the
tokenizers library whole. ``tests/llm/test_tokens.py`` holds both kinds against the library.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import cached_property, lru_cache

import numpy as np

_PLAIN = re.compile("[^\t\n\r\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ]")  # anything but Latin text
_BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value of byte-level encoders
_END = "\0"  # marks the end of a word inside; never part of a text that takes this way
_MAX_WORDS = 200_000
_LONG = 200  # longer words are not kept
_TOGETHER = 500  # words encoded in one call


class Encoder:
    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path = path
        self.vocabulary = 1 + max(*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"]))
        self.special = [t["content"] for t in spec["added_tokens"]]
        suffix = spec["model"]["end_of_word_suffix"]
        ranks, special = _ranks(spec, suffix)
        self.by_word = suffix is not None
        self.fast = tiktoken.Encoding(path, pat_str=f"[^{_END}]*{_END}" if self.by_word else _BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={} if self.by_word else special)
        if self.by_word:
            self.parts = re.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"[^\s\p{L}\p{N}]+", r"(?:[^\s\w]|_)+").replace(r"[\p{L}]+", r"[^\W\d_]+").replace(r"[\p{N}]", r"\d"))
            self.ends = np.zeros(self.vocabulary, bool)
            self.ends[[i for w, i in spec["model"]["vocab"].items() if w.endswith(suffix)]] = True
            self.words: dict[str, bytes] = {}

    @cached_property
    def library(self):
        """The tokenizers library's own object, loaded when a text or a decoding needs it."""
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(self.path)
        library.no_truncation()
        library.no_padding()
        return library

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Unsigned 32-bit ids of each text."""
        if not self.by_word:
            return [self.fast.encode_to_numpy(t, allowed_special="all").astype("<u4", copy=False) for t in texts]
        plain = [None if _PLAIN.search(t) or any(s in t for s in self.special) else t if t.isascii() else unicodedata.normalize("NFC", t) for t in texts]
        words = [None if t is None else t.lower().split() for t in plain]
        if len(self.words) > _MAX_WORDS:
            self.words.clear()
        known = self.words
        missing = list({w for found in words if found for w in found if w not in known})
        self._learn(missing)
        out = [None if found is None else np.frombuffer(b"".join([known[w] for w in found]), "<u4") for found in words]
        if whole := [i for i, found in enumerate(words) if found is None]:
            for i, e in zip(whole, self.library.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False), strict=True):
                out[i] = np.array(e.ids, "<u4")
        for w in missing:
            if len(w) > _LONG:
                del known[w]
        return out

    def _learn(self, words: list[str]) -> None:
        """Many words in one call; a token that ends a word closes each of its parts."""
        for k in range(0, len(words), _TOGETHER):
            group = words[k : k + _TOGETHER]
            parts = [self.parts.findall(w) for w in group]
            ids = self.fast.encode_to_numpy(_END.join(p for found in parts for p in found) + _END, disallowed_special=()).astype("<u4", copy=False)
            last = np.flatnonzero(self.ends[ids]) + 1
            upto = np.cumsum([len(found) for found in parts])
            cuts = [0, *last[upto - 1].tolist()]
            self.words.update((w, ids[a:b].tobytes()) for w, a, b in zip(group, cuts, cuts[1:]))

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.library.decode_batch([x.tolist() for x in ids], skip_special_tokens=False)


def _ranks(spec: dict, suffix: str | None) -> tuple[dict[bytes, int], dict[str, int]]:
    """Bytes of each token with its id, which is the rank of its merge; the end of a word is written as _END."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {}
    for w, i in spec["model"]["vocab"].items():
        if w not in special:
            end = suffix is not None and w.endswith(suffix)
            ranks[bytes(byte[c] for c in (w[: -len(suffix)] if end else w)) + _END.encode() * end] = i
    return ranks, special


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each file and worker process."""
    return Encoder(path)

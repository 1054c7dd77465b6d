"""Byte-level BPE by the tokenizers library over Arrow batches, from a file of ranks.

A rank file names tokens by their bytes. Each byte is shown as one printable character (``byte_table``), so the library can hold tokens as text; its merges are all
ways to put a token together from two others, in the order of the ranks, which merges the same pairs as the ranks themselves do. A text is split by the byte-level pattern and every
match is encoded by itself, without special tokens: their strings are ordinary text.

Offsets come from the ids: the byte lengths of the tokens, added up, are positions in the text's UTF-8, and a running count of characters turns them into code points. A token that
begins or ends inside a character covers the whole of it, so neighbours that share a character overlap. Decoding looks each id up in the byte table and joins the bytes; ``pieces`` keeps the bytes of a character
that is not complete yet for the token that completes it. A decoded text is bytes first: ids may be cut inside a character.

Null texts count as empty: no ids. Rows with equal ids or texts are rows of their own, null ids stay null, extra columns don't matter, an empty table gives no rows. A task holds the ids of one slice of texts (``common.SLICE_CHARS``, or one longer text).
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import full_text, map_text, table

_CACHED_WORDS = 200_000  # words the library remembers in a worker
_AT_ONCE = 200  # texts in one call


def byte_table() -> dict[int, str]:
    """Printable characters of Latin-1 stand for themselves, the other bytes for the characters from 256 on, in order."""
    printable = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = (chr(256 + n) for n in range(256))
    return {b: chr(b) if b in printable else next(others) for b in range(256)}


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens of a rank file: base64 of the bytes and the id on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merges_of(ranks: dict[bytes, int]) -> Iterator[tuple[bytes, bytes]]:
    """Every pair of tokens that joins to a token, the token of the smallest rank first."""
    for token in sorted(ranks, key=ranks.__getitem__):
        cuts = [(token[:i], token[i:]) for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
        yield from sorted(cuts, key=lambda pair: (ranks[pair[0]], ranks[pair[1]]))


class ByteBpe:
    def __init__(self, path: str):
        from tokenizers import Tokenizer, models, pre_tokenizers

        ranks, shown = read_ranks(path), byte_table()
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"{path} has no token for the bytes {missing[:5]}")

        def name(token: bytes) -> str:
            return "".join(map(shown.__getitem__, token))

        self.library = Tokenizer(models.BPE(vocab={name(t): i for t, i in ranks.items()}, merges=[(name(a), name(b)) for a, b in merges_of(ranks)], cache_capacity=_CACHED_WORDS))
        self.library.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        byte_of = {c: b for b, c in shown.items()}
        size = 1 + max(ranks.values())
        names = (self.library.id_to_token(i) for i in range(size))
        self.token_bytes = [None if w is None else bytes(map(byte_of.__getitem__, w)) for w in names]
        self.lengths = np.array([len(t or b"") for t in self.token_bytes], np.int64)

    def ids(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text."""
        for k in range(0, len(texts), _AT_ONCE):
            for e in self.library.encode_batch_fast(texts[k : k + _AT_ONCE], add_special_tokens=False):
                yield e.ids

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Unsigned 32-bit ids of each text."""
        return [np.array(ids, "<u4") for ids in self.ids(texts)]

    def decode(self, ids: Sequence[int]) -> bytes:
        """The bytes of the tokens. An id outside the vocabulary is an error."""
        try:
            if ids and min(ids) < 0:
                raise IndexError
            return b"".join(map(self.token_bytes.__getitem__, ids))
        except (IndexError, TypeError):  # beyond the table, or a gap in it
            raise ValueError("an id is not in the vocabulary") from None

    def offsets(self, ids: np.ndarray, text: str) -> np.ndarray:
        """(start, end) in code points of each token of the text."""
        data = np.frombuffer(text.encode("utf-8"), np.uint8)
        upto = np.cumsum((data & 0xC0) != 0x80)  # characters begun up to and with each byte
        ends = np.cumsum(self.lengths[ids])
        starts = ends - self.lengths[ids]
        if len(ids) == 0:
            return np.zeros((0, 2), np.int64)
        if ends[-1] != len(data):
            raise ValueError("the ids are not those of the text")
        return np.stack([upto[starts] - 1, upto[ends - 1]], axis=1).astype(np.int64)

    def pieces(self, ids: Iterable[int], errors: str = "replace") -> list[str]:
        """The text each token completes, as a stream of tokens would be shown: a character split between tokens comes with its last one."""
        import codecs

        reader = codecs.getincrementaldecoder("utf-8")(errors)
        out = [reader.decode(self.decode([i])) for i in ids]
        if rest := reader.decode(b"", final=True):
            out.append(rest)  # bytes that no token completes
        return out


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    """One tokenizer for each file and worker process."""
    return ByteBpe(path)


def encoded(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", offsets: bool = False) -> DataFrame:
    """doc_id, ids (array of long) and, if asked for, starts and ends of the tokens in code points. No shuffle."""
    fields = [("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))] + [(c, pa.list_(pa.int64())) for c in ("starts", "ends") if offsets]

    def make():
        tok = byte_bpe(tokenizer)

        def work(part: pa.RecordBatch, texts: list[str]) -> dict:
            ids = tok.encode(texts)
            out = {"doc_id": part.column("id"), "ids": [x.astype(np.int64) for x in ids]}
            if offsets:
                spans = [tok.offsets(x, t) for x, t in zip(ids, texts)]
                out |= {"starts": [s[:, 0] for s in spans], "ends": [s[:, 1] for s in spans]}
            return out

        return work

    return map_text(docs.select(F.col(id_col).cast("long").alias("id"), full_text(text_col).alias("text")), "text", pa.schema(fields), make)


def decoded(encodings: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, data (the decoded bytes) from rows of doc_id and ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = byte_bpe(tokenizer)
        for part in batches:
            for k in range(0, part.num_rows, _AT_ONCE):
                some = part.slice(k, _AT_ONCE)
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array([tok.decode(x or []) for x in some.column("ids").to_pylist()], pa.binary())], names=["doc_id", "data"])

    return encodings.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, data binary")


def digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoded and decoded again in the same task, so that ids never leave it."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def make():
        tok = byte_bpe(tokenizer)

        def work(part: pa.RecordBatch, texts: list[str]) -> dict:
            lengths, encoded, decoded = [], [], []
            for ids in tok.ids(texts):
                lengths.append(len(ids))
                encoded.append(sha256(np.array(ids, "<u4").tobytes()).hexdigest())
                decoded.append(sha256(tok.decode(ids)).hexdigest())
            return {"doc_id": part.column("id"), "n_tokens": lengths, "ids_sha256": encoded, "decoded_sha256": decoded}

        return work

    return map_text(docs.select(F.col(id_col).cast("long").alias("id"), full_text(text_col).alias("text")), "text", schema, make)


def op12(spark: SparkSession, sf_dir: str, tokenizer: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), tokenizer)

"""The registered queries of this package and their SQL, where SQL can express them."""

from __future__ import annotations

from functools import partial

import public_tokenizers

from meterlake.llm import byte_bpe, chat, chunk_reuse, disclosure, exact_dedup, ftrl, line_crf, ns_bounds, order_minhash, packing, records, structure_repair, wrapper

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

QUERIES = {
    "op1_line_crf": line_crf.op1,
    "op2_order_minhash": order_minhash.op2,
    "op3_chunk_reuse": partial(chunk_reuse.op3, tokenizer=WORDS),
    "op4_wrapper": wrapper.op4,
    "op5_chat": chat.op5,
    "op6_records": partial(records.op6, tokenizer=WORDS),
    "op7_exact_dedup": exact_dedup.op7,
    "op8_disclosure": disclosure.op8,
    "op9_ftrl": ftrl.op9,
    "op10_packing": partial(packing.op10, tokenizer=BYTES),
    "op11_ns_bounds": ns_bounds.op11,
    "op12_byte_bpe": partial(byte_bpe.op12, tokenizer=RANKS),
    "op13_structure_repair": structure_repair.op13,
}

ORACLE = {"op5_chat": chat.OP5_SQL, "op7_exact_dedup": exact_dedup.OP7_SQL, "op11_ns_bounds": ns_bounds.OP11_SQL, "op13_structure_repair": structure_repair.OP13_SQL}

"""Queries of this package by name, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from . import (bpe, chat, decontaminate, imatch, linededup, merkle, prefixtrie, sharding, simhash, suffixdedup, topk,
               toxicity, warc)

QUERIES = {
    "op1_byte_level_bpe": bpe.query,
    "op2_toxicity": toxicity.query,
    "op3_exact_top_k": topk.query,
    "op4_line_dedup": linededup.query,
    "op5_simhash": simhash.query,
    "op6_chat_formatting": chat.query,
    "op7_suffix_array_dedup": suffixdedup.query,
    "op8_sharding": sharding.query,
    "op9_decontamination": decontaminate.query,
    "op10_warc": warc.query,
    "op11_prefix_trie": prefixtrie.query,
    "op12_merkle_manifest": merkle.query,
    "op13_imatch": imatch.query,
}

ORACLE: dict[str, str] = {
    "op3_exact_top_k": topk.SQL,
    "op4_line_dedup": linededup.SQL,
    "op10_warc": warc.SQL,
    "op11_prefix_trie": prefixtrie.SQL,
    "op12_merkle_manifest": merkle.SQL,
    "op13_imatch": imatch.SQL,
}

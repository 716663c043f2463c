"""Registered queries of the corpus operators and, where SQL can express them, their DuckDB statements."""

from __future__ import annotations

from . import decontam, exact, langid, mixing, neardup, pii, repair, secrets, tokenids, tokens, toxicity, trie, warc

QUERIES = {
    "op1_warc": warc.op1_warc,
    "op2_language_id": langid.op2_language_id,
    "op3_token_counts": tokens.op3_token_counts,
    "op4_near_duplicates": neardup.op4_near_duplicates,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_secrets": secrets.op6_secrets,
    "op7_mixing": mixing.op7_mixing,
    "op8_decontamination": decontam.op8_decontamination,
    "op9_personal_data": pii.op9_personal_data,
    "op10_exact_dedup": exact.op10_exact_dedup,
    "op11_conversation_repair": repair.op11_conversation_repair,
    "op12_token_ids": tokenids.op12_token_ids,
    "op13_prefix_trie": trie.op13_prefix_trie,
}

ORACLES = {
    "op1_warc": warc.OP1_SQL,
    "op6_secrets": secrets.OP6_SQL,
    "op7_mixing": mixing.OP7_SQL,
    "op10_exact_dedup": exact.OP10_SQL,
    "op11_conversation_repair": repair.OP11_SQL,
    "op13_prefix_trie": trie.OP13_SQL,
}

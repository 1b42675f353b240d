"""Queries of this subpackage and their SQL twins."""

from __future__ import annotations

from atlasmith.llm import alignment, licenses, line_dedup, media, mixing, packing, phrases, prefix_trie, simhash, substring, token_counts, topk, toxicity

QUERIES = {
    "op1_media": media.op1_media,
    "op2_topk": topk.op2_topk,
    "op3_license_scan": licenses.op3_license_scan,
    "op4_substring_dedup": substring.op4_substring_dedup,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_simhash": simhash.op7_simhash,
    "op8_mixing": mixing.op8_mixing,
    "op9_packing": packing.op9_packing,
    "op10_line_dedup": line_dedup.op10_line_dedup,
    "op11_cross_tokenizer": alignment.op11_cross_tokenizer,
    "op12_phrases": phrases.op12_phrases,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}
ORACLES = {
    "op2_topk": topk.ORACLE,
    "op4_substring_dedup": substring.ORACLE,
    "op8_mixing": mixing.ORACLE,
    "op10_line_dedup": line_dedup.ORACLE,
    "op13_prefix_trie": prefix_trie.ORACLE,
}

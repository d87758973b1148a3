"""Registered queries of the training-data operators, and the SQL that checks them."""

from __future__ import annotations

from . import (audit, bpe, classifier, fingerprints, lines, neardup, packing, quality, sharding, substrings,
               suffixtree, trie, warc)

QUERIES = {
    "op2_near_duplicates": neardup.op2_near_duplicates,
    "op7_bpe": bpe.op7_bpe,
    "op1_fingerprints": fingerprints.op1_fingerprints,
    "op3_warc": warc.op3_warc,
    "op8_lm_scoring": suffixtree.op8_lm_scoring,
    "op10_quality_classifier": classifier.op10_quality_classifier,
    "op9_line_dedup": lines.op9_line_dedup,
    "op5_packing": packing.op5_packing,
    "op4_quality_rules": quality.op4_quality_rules,
    "op6_substring_dedup": substrings.op6_substring_dedup,
    "op11_sharding": sharding.op11_sharding,
    "op12_filter_audit": audit.op12_filter_audit,
    "op13_prefix_trie": trie.op13_prefix_trie,
}

ORACLES = {
    "op11_sharding": sharding.ORACLE,
    "op12_filter_audit": audit.ORACLE,
    "op13_prefix_trie": trie.ORACLE,
    "op3_warc": warc.ORACLE,
    "op9_line_dedup": lines.ORACLE,
    "op6_substring_dedup": substrings.ORACLE,
}

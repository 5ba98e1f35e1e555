"""The queries of this subpackage, by name, and the SQL that some of them equal."""

from __future__ import annotations

from siltmill.llm import ann, decontaminate, langid, licenses, neardup, packing, quality, substring, suffix_tree, token_files

QUERIES = {
    "op1_decontaminate": decontaminate.query,
    "op2_substring_dedup": substring.query,
    "op3_license_scan": licenses.query,
    "op4_near_duplicates": neardup.query,
    "op5_pack": packing.query,
    "op6_nearest": ann.query,
    "op7_quality": quality.query,
    "op8_suffix_tree": suffix_tree.query,
    "op10_language_id": langid.query,
    "op9_token_files": token_files.query,
}
ORACLES = {
    "op1_decontaminate": decontaminate.ORACLE,
    "op2_substring_dedup": substring.ORACLE,
    "op3_license_scan": licenses.ORACLE,
}

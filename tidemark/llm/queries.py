"""The registered queries of the subpackage and their DuckDB twins."""

from __future__ import annotations

from tidemark.llm import (decontaminate, html_text, language_id, lexical_search, mixing, quality_classifier,
                          quality_rules, simhash, substring_dedup, suffix_dedup, token_alignment, url_filter,
                          warc_archive)

_MODULES = {
    "op1_simhash_dedup": simhash,
    "op2_url_filters": url_filter,
    "op3_quality_rules": quality_rules,
    "op4_quality_classifier": quality_classifier,
    "op5_suffix_dedup": suffix_dedup,
    "op6_html_extraction": html_text,
    "op7_language_id": language_id,
    "op8_substring_dedup": substring_dedup,
    "op9_decontamination": decontaminate,
    "op10_mixing": mixing,
    "op11_lexical_search": lexical_search,
    "op12_warc_archive": warc_archive,
    "op13_token_alignment": token_alignment,
}

QUERIES = {name: module.query for name, module in _MODULES.items()}
ORACLE = {name: module.ORACLE for name, module in _MODULES.items()
          if getattr(module, "ORACLE", None)}

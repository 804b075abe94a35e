"""Registered queries of this subpackage and their DuckDB equivalents."""

from __future__ import annotations

from . import decontamination, exact_dedup, language_id, lexical_search, license_scan, line_dedup, mixing, ngram_join, prefix_trie, quality_classifier, secret_scan, url_filter, warc

QUERIES = {"op1_exact_dedup": exact_dedup.op1_exact_dedup, "op2_quality_classifier": quality_classifier.op2_quality_classifier, "op3_secret_scan": secret_scan.op3_secret_scan, "op4_ngram_join": ngram_join.op4_ngram_join, "op5_line_dedup": line_dedup.op5_line_dedup, "op6_mixing": mixing.op6_mixing, "op7_warc": warc.op7_warc, "op8_url_filter": url_filter.op8_url_filter, "op9_language_id": language_id.op9_language_id, "op10_decontamination": decontamination.op10_decontamination, "op11_prefix_trie": prefix_trie.op11_prefix_trie, "op12_lexical_search": lexical_search.op12_lexical_search, "op13_license_scan": license_scan.op13_license_scan}
ORACLES = {"op1_exact_dedup": exact_dedup.ORACLE, "op5_line_dedup": line_dedup.ORACLE, "op6_mixing": mixing.ORACLE, "op7_warc": warc.ORACLE, "op11_prefix_trie": prefix_trie.ORACLE, "op12_lexical_search": lexical_search.ORACLE, "op13_license_scan": license_scan.ORACLE}

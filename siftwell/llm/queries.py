"""The queries of this subpackage and the SQL that gives the same rows."""

from __future__ import annotations

from siftwell.llm import decontaminate, exact_dedup, html_text, language, licenses, near_dedup, packing, secrets, token_counts, warc

QUERIES = {
    "op1_decontamination": decontaminate.op1_decontamination,
    "op2_secret_scan": secrets.op2_secret_scan,
    "op3_language_id": language.op3_language_id,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_html_extraction": html_text.op5_html_extraction,
    "op6_token_counts": token_counts.op6_token_counts,
    "token_rollup_by_patterns": token_counts.token_rollup_by_patterns,
    "op7_packing": packing.op7_packing,
    "op8_license_scan": licenses.op8_license_scan,
    "op9_warc": warc.op9_warc,
    "op10_minhash_near_dedup": near_dedup.op10_minhash_near_dedup,
}

ORACLE_SQL = {
    "op4_exact_dedup": exact_dedup.ORACLE,
    "token_rollup_by_patterns": token_counts.ORACLE,
    "op8_license_scan": licenses.ORACLE,
    "op9_warc": warc.ORACLE,
}

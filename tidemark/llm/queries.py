"""The registered queries of this subpackage and the same results in SQL, where SQL can express them."""

from __future__ import annotations

from tidemark.llm import (
    bpe,
    cuckoo_dedup,
    filter_audit,
    html,
    improbable,
    jaccard_join,
    langid,
    mixing,
    periodic_runs,
    quality,
    simhash,
    urls,
    warc,
)

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_html_extraction": html.op2_html_extraction,
    "op3_url_filter": urls.op3_url_filter,
    "op4_mixing": mixing.op4_mixing,
    "op5_warc": warc.op5_warc,
    "op6_cuckoo_dedup": cuckoo_dedup.op6_cuckoo_dedup,
    "op7_improbable": improbable.op7_improbable,
    "op8_simhash": simhash.op8_simhash,
    "op9_byte_bpe": bpe.op9_byte_bpe,
    "op10_language_id": langid.op10_language_id,
    "op11_jaccard_join": jaccard_join.op11_jaccard_join,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}

ORACLE_SQL = {
    "op4_mixing": mixing.ORACLE,
    "op5_warc": warc.ORACLE,
    "op6_cuckoo_dedup": cuckoo_dedup.ORACLE,
    "op13_filter_audit": filter_audit.ORACLE,
}

"""The registered queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from tillmetrics.llm import (
    bpe_tree,
    chat_format,
    decontaminate,
    html_wrapper,
    language_id,
    license_scan,
    path_dedup,
    simhash_dedup,
    spotsigs,
    suffix_dedup,
    turn_repair,
    warc_derive,
    whitening,
)

QUERIES = {
    "op1_license_scan": license_scan.op1_license_scan,
    "op2_chat_format": chat_format.op2_chat_format,
    "op3_html_wrapper": html_wrapper.op3_html_wrapper,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_suffix_dedup": suffix_dedup.op5_suffix_dedup,
    "op6_spotsigs": spotsigs.op6_spotsigs,
    "op7_simhash_dedup": simhash_dedup.op7_simhash_dedup,
    "op8_language_id": language_id.op8_language_id,
    "op9_warc_derive": warc_derive.op9_warc_derive,
    "op10_bpe_tree": bpe_tree.op10_bpe_tree,
    "op11_turn_repair": turn_repair.op11_turn_repair,
    "op12_whitening": whitening.op12_whitening,
    "op13_path_dedup": path_dedup.op13_path_dedup,
}
ORACLES = {
    "op1_license_scan": license_scan.SQL,
    "op2_chat_format": chat_format.SQL,
    "op4_decontaminate": decontaminate.SQL,
}

"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from tillsight.llm import (
    bpe,
    grid_join,
    html_text,
    licences,
    line_crf,
    minhash,
    mixing,
    packing,
    quality_rules,
    suffix_dedup,
    token_align,
    turn_repair,
    urls,
)

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_licences": licences.op2_licences,
    "op3_quality_rules": quality_rules.op3_quality_rules,
    "op4_html_text": html_text.op4_html_text,
    "op5_minhash": minhash.op5_minhash,
    "op6_grid_join": grid_join.op6_grid_join,
    "op7_line_crf": line_crf.op7_line_crf,
    "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
    "op9_bpe": bpe.op9_bpe,
    "op10_url_filter": urls.op10_url_filter,
    "op11_turn_repair": turn_repair.op11_turn_repair,
    "op12_best_fit": packing.op12_best_fit,
    "op13_token_align": token_align.op13_token_align,
}

ORACLE = {
    "op1_mix_sources": mixing.ORACLE_OP1,
    "op2_licences": licences.ORACLE_OP2,
    "op10_url_filter": urls.ORACLE_OP10,
}

"""The queries of this subpackage by name, with SQL twins where SQL can express them."""

from __future__ import annotations

from tallyframe.llm import decontaminate, html_text, jaccard_join, lexical_search, mixing, piece_tokens, quality_model, quality_rules, repeated_bytes, token_ids, toxicity, warc, whitening

QUERIES = {
    "op1_jaccard_join": jaccard_join.op1_jaccard_join,
    "op2_decontamination": decontaminate.op2_decontamination,
    "op3_quality_model": quality_model.op3_quality_model,
    "op4_warc": warc.op4_warc,
    "op5_quality_rules": quality_rules.op5_quality_rules,
    "op6_token_ids": token_ids.op6_token_ids,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_repeated_bytes": repeated_bytes.op8_repeated_bytes,
    "op9_html_text": html_text.op9_html_text,
    "op10_mixing": mixing.op10_mixing,
    "op11_lexical_search": lexical_search.op11_lexical_search,
    "op12_whitening": whitening.op12_whitening,
    "op13_piece_tokens": piece_tokens.op13_piece_tokens,
}

SQL: dict[str, str] = {
    "op2_decontamination": decontaminate.SQL,
    "op11_lexical_search": lexical_search.SQL,
}

"""Queries of the corpus operators and, where SQL can express them, their oracle."""

from __future__ import annotations

from ledgerlens.llm import ann, decontaminate, html_text, pieces, quality, secrets, simhash, substrings, token_store, url_filter

QUERIES = {
    "op1_html_text": html_text.op1_html_text,
    "op2_quality": quality.op2_quality,
    "op3_ann": ann.op3_ann,
    "op4_token_store": token_store.op4_token_store,
    "op5_simhash": simhash.op5_simhash,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_substrings": substrings.op7_substrings,
    "op8_pieces": pieces.op8_pieces,
    "op9_url_filter": url_filter.op9_url_filter,
    "op10_secrets": secrets.op10_secrets,
}
ORACLES: dict[str, str] = {"op9_url_filter": url_filter.OP9_SQL}

"""Queries of the corpus operators, one for each, over whole tables."""

from __future__ import annotations

from . import chat, decontaminate, minhash, packing, pages, quality, secrets, substring, suffixes, tokens

QUERIES = {
    "op1_chat_perspectives": chat.query,
    "op2_suffix_dedup": suffixes.query,
    "op3_token_counts": tokens.query,
    "op4_packing": packing.query,
    "op5_substring_dedup": substring.query,
    "op6_decontamination": decontaminate.query,
    "op7_page_text": pages.query,
    "op8_quality_rules": quality.query,
    "op9_near_dedup": minhash.query,
    "op10_secret_scan": secrets.query,
}

ORACLES = {"op1_chat_perspectives": chat.ORACLE}

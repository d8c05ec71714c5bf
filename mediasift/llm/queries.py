"""Registered queries of the text operators and their DuckDB SQL."""

from __future__ import annotations

from mediasift.llm import (
    align, bpe, byte_pieces, chat, decontam, hard_negatives, html_text, langid, lm, quality, simhash, toxicity, urls)

QUERIES = {}
ORACLE = {}
for _mod in (langid, quality, bpe, chat, toxicity, decontam, urls, simhash, html_text, lm,
             align, byte_pieces, hard_negatives):
    QUERIES.update(_mod.QUERIES)
    ORACLE.update(_mod.ORACLE)

"""Registered training-data queries and, where SQL can express them, their oracle SQL."""

from __future__ import annotations

from opinion_spark.llm import bpe, exact, fingerprint, html, language, mining, mixing, near, topk, toxicity, urls, warc, whitening

REGISTRY = {
    "op1_language_id": language.query,
    "op2_bpe": bpe.query,
    "op3_toxicity": toxicity.query,
    "op4_mixing": mixing.query,
    "op5_near_dedup": near.query,
    "op6_top_k": topk.query,
    "op7_html_text": html.query,
    "op8_fingerprints": fingerprint.query,
    "op9_warc": warc.query,
    "op10_url_filter": urls.query,
    "op11_whitening": whitening.query,
    "op12_exact_dedup": exact.query,
    "op13_hard_negatives": mining.query,
}

ORACLE = {
    "op5_near_dedup": near.SQL,
    "op6_top_k": topk.SQL,
    "op9_warc": warc.SQL,
    "op10_url_filter": urls.SQL,
    "op12_exact_dedup": exact.SQL,
    "op13_hard_negatives": mining.SQL,
}

"""Registered queries of the operators: ``name -> callable(spark, sf_dir)``."""

from __future__ import annotations

from tessera.llm import (
    conversation_repair,
    decontaminate,
    exact_dedup,
    html_extract,
    line_dedup,
    mixing,
    near_dedup,
    quality,
    secret_scan,
    substring_dedup,
    topk_search,
    url_reputation,
    whitening,
)
from tessera.sources.tables import table

QUERIES = {
    "op1_substring_dedup": lambda spark, d: substring_dedup.digest(table(spark, d, "documents")),
    "op2_secret_scan": lambda spark, d: secret_scan.digest(table(spark, d, "documents")),
    "op5_line_dedup": lambda spark, d: line_dedup.digest(table(spark, d, "documents")),
    "op6_decontaminate": lambda spark, d: decontaminate.digest(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op3_html_extract": lambda spark, d: html_extract.digest(table(spark, d, "pages")),
    "op4_topk_search": lambda spark, d: topk_search.digest(table(spark, d, "embeddings")),
    "op7_near_dedup": lambda spark, d: near_dedup.digest(table(spark, d, "documents")),
    "op8_quality": lambda spark, d: quality.judged(table(spark, d, "documents"), table(spark, d, "labels")),
    "op9_url_filter": lambda spark, d: url_reputation.digest(table(spark, d, "pages"), table(spark, d, "labels")),
    "op10_mix_sources": lambda spark, d: mixing.digest(table(spark, d, "documents")),
    "op11_conversation_repair": lambda spark, d: conversation_repair.digest(table(spark, d, "conversations")),
    "op12_whitening": lambda spark, d: whitening.digest(table(spark, d, "embeddings")),
    "op13_exact_dedup": lambda spark, d: exact_dedup.digest(table(spark, d, "documents")),
}

ORACLE = {
    "op1_substring_dedup": substring_dedup.DIGEST_SQL,
    "op4_topk_search": topk_search.DIGEST_SQL,
    "op5_line_dedup": line_dedup.DIGEST_SQL,
    "op6_decontaminate": decontaminate.DIGEST_SQL,
    "op9_url_filter": url_reputation.DIGEST_SQL,
    "op13_exact_dedup": exact_dedup.DIGEST_SQL,
}

"""Queries of the corpus operators, and the SQL that some can be held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from objsync.llm import aligned, chat, chat_sql, decontaminate, jaccard, pieces, quality, quality_sql, ranked, recompress, runindex, scaled, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_array_dedup": runindex.op1_suffix_array_dedup,
    "op2_decontamination": decontaminate.op2_decontamination,
    "op3_token_counts": pieces.op3_token_counts,
    "op4_chat_formatting": chat.op4_chat_formatting,
    "op5_ngram_jaccard_join": jaccard.op5_ngram_jaccard_join,
    "op6_quality_rules": quality.op6_quality_rules,
    "op7_warc": warc.op7_warc,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_sentencepiece": pieces.op9_sentencepiece,
    "op10_substring_dedup": recompress.op10_substring_dedup,
    "op11_fingerprints": scaled.op11_fingerprints,
    "op12_cross_tokenizer_alignment": aligned.op12_cross_tokenizer_alignment,
    "op13_ranked_search": ranked.op13_ranked_search,
}

ORACLE: dict[str, str] = {
    "op4_chat_formatting": chat_sql.OP4,
    "op6_quality_rules": quality_sql.OP6,
    "op7_warc": warc.OP7,
    "op10_substring_dedup": recompress.OP10,
    "op11_fingerprints": scaled.OP11,
    "op13_ranked_search": ranked.OP13,
}

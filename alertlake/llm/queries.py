"""The registered queries of this folder, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from alertlake.llm import byte_bpe, chat_format, conversation_repair, decontam, hard_negatives
from alertlake.llm import line_dedup, ngram_lm
from alertlake.llm import quality_model, quality_rules
from alertlake.llm import secret_scan, simhash, token_counts, warc
from alertlake.llm import oracle as SQL
from alertlake.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def add(name: str, build: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    QUERIES[name] = build
    if sql is not None:
        ORACLE[name] = sql


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents")


add(
    "op1_decontamination",
    lambda spark, d: decontam.report(documents(spark, d), read(spark, d, "benchmark")),
    SQL.DECONTAMINATION,
)
add("op2_simhash", lambda spark, d: simhash.report(documents(spark, d)))
add("op3_quality_rules", lambda spark, d: quality_rules.report(documents(spark, d)), quality_rules.sql())
add(
    "op7_token_counts",
    lambda spark, d: token_counts.report(documents(spark, d), public_tokenizers.path("word_bpe_49k.json")),
)
add(
    "op10_byte_bpe",
    lambda spark, d: byte_bpe.report(
        documents(spark, d), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ),
)
add("op4_line_dedup", lambda spark, d: line_dedup.report(documents(spark, d)), line_dedup.SQL)
add("op5_secret_scan", lambda spark, d: secret_scan.report(documents(spark, d)), secret_scan.sql())
add(
    "op8_quality_classifier",
    lambda spark, d: quality_model.report(documents(spark, d), read(spark, d, "labels")),
)
add("op6_language_model", lambda spark, d: ngram_lm.report(documents(spark, d)))
add("op9_warc_derivatives", lambda spark, d: warc.report(read(spark, d, "pages")))
add("op11_hard_negatives", hard_negatives.report, hard_negatives.SQL)
add("op12_chat_format", chat_format.report, chat_format.sql())
add("op13_conversation_repair", conversation_repair.report, conversation_repair.sql())

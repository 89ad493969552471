"""The registered queries of the subpackage, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm import (
    alignment, byte_bpe, chat, html_text, language, lexical, line_dedup, mixing, near_dedup, neighbours, quality,
    token_counts, topk,
)
from fareflow.llm.common import table
from fareflow.llm.sql import SQL
from fareflow.session import new_folder

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
MULTI_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality(table(spark, sf_dir, "documents"))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(*names, "base_failed", "kept")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages, drop=("html",))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predictions(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache is new in each run, so every run encodes each different text once."""
    cache = new_folder(spark, "token-cache")
    docs = table(spark, sf_dir, "documents")
    counted = token_counts.token_counts(docs, cache, BYTE_BPE, public_tokenizers.PATTERN)
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.digests(docs, MULTI_BPE, public_tokenizers.PATTERN, drop=("text",))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(chat.with_extra(table(spark, sf_dir, "conversations")), BYTE_BPE)


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignments(table(spark, sf_dir, "documents"), BYTE_BPE, public_tokenizers.PATTERN, PIECE_BPE)


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Run] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_html_text,
        op3_language,
        op4_token_counts,
        op5_byte_bpe,
        op6_mixing,
        op7_chat,
        op8_top_k,
        op9_near_dedup,
        op10_line_dedup,
        op11_lexical_search,
        op12_alignment,
        op13_neighbours,
    )
}

__all__ = ["QUERIES", "SQL"]

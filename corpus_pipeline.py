"""From raw documents to token ids: quality rules, line dedup, near-dedup, mixing, encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fareflow.llm import byte_bpe, line_dedup, mixing, near_dedup, quality
from fareflow.llm.common import table, written
from fareflow.llm.queries import MULTI_BPE

#: A document that breaks no rule stays, whatever its host's others break.
GOOD = quality.Limits(spare_clean=True)
#: Documents are near copies from a similarity of 0.8 on; at 0.8 a pair shares no band with probability 9e-7.
NEAR = near_dedup.Settings(percent=80, bands=35)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, GOOD)


def without_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_common_lines(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs, NEAR)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the ids, and the digests of the ids and of what they decode to."""
    rows = docs.select("doc_id", "lang", "source", "text")
    return byte_bpe.digests(rows, MULTI_BPE, public_tokenizers.PATTERN, drop=("text",), ids="ids")


STAGES = [
    ("quality rules", good),
    ("line dedup", without_common_lines),
    ("near dedup", one_of_each),
    ("mixing", mixed),
    ("byte bpe", encoded),
]

#: SQL cannot state the merges of the encoder; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

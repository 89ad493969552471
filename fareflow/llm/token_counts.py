"""Token counts behind a cache that is keyed by digests of the content and of the tokenizer.

Counting is the dear part, texts repeat, and corpora are counted again after each crawl: so a text
is encoded only if no row of the cache holds its digest under the same tokenizer, once however often
it occurs, and its count is appended to the cache.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException
from tokenizers import Tokenizer

from fareflow.llm.common import map_rows, written

CACHE = "digest binary, tokenizer string, n_tokens long"
#: Parts whose counts a task's process remembers, the longest it remembers, and how many are encoded at a
#: time: the library's results take some kilobytes each.
MEMO, MEMO_CHARS, BATCH = 100_000, 48, 5_000


def tokenizer_digest(path: str) -> str:
    """The version of a tokenizer: a digest of its file."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


class Counter:
    """Counts tokens as the library does: no added tokens, no truncation, special strings as it has them.

    The library splits a text at its special strings, then by its pattern, and encodes each part by
    itself; so each different part is encoded by it once and remembered. Texts that hold a special
    string go to the library whole.
    """

    def __init__(self, path: str, pattern: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.split = regex.compile(pattern).findall
        self.memo: dict[str, int] = {}

    def _library(self, texts: list[str]) -> list[int]:
        counts = []
        for at in range(0, len(texts), BATCH):
            encoded = self.library.encode_batch_fast(texts[at : at + BATCH], add_special_tokens=False)
            counts += [len(e.ids) for e in encoded]
        return counts

    def counts(self, texts: Iterable[str | None]) -> list[int]:
        texts = [t or "" for t in texts]
        whole = {i for i, t in enumerate(texts) if any(s in t for s in self.special)}
        parts = [[] if i in whole else self.split(t) for i, t in enumerate(texts)]
        tokens = set(chain.from_iterable(parts))
        if len(self.memo) > MEMO:
            self.memo.clear()
        known = self.memo
        new = [t for t in tokens if t not in known]
        found = dict(zip(new, self._library(new)))
        rare = {t: found.pop(t) for t in [t for t in found if len(t) > MEMO_CHARS]}
        known.update(found)
        if rare:
            known = {t: rare[t] if t in rare else known[t] for t in tokens}
        counts = [sum(map(known.__getitem__, x)) for x in parts]
        for i in whole:
            counts[i] = self._library([texts[i]])[0]
        return counts


@lru_cache(maxsize=4)
def counter(path: str, pattern: str) -> Counter:
    """One counter for all tasks of a process."""
    return Counter(path, pattern)


def read_cache(spark: SparkSession, cache: str) -> DataFrame:
    """The rows of the cache; none if nothing has been stored yet."""
    try:
        return spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE)


def _digest(text: str = "text"):
    """SHA-256 of the content: the text as UTF-8, a null one as empty, nothing else changed.

    A byte-level tokenizer counts every byte, so any further normalisation would change the count.
    """
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def fill_cache(docs: DataFrame, cache: str, path: str, pattern: str) -> None:
    """Appends the counts of the texts that the cache lacks.

    Copies are dropped in each task before texts are shuffled by digest, so a text that fills a third
    of the rows is one row per task; the join with the cache keeps that partitioning. A run that is repeated after a failure
    finds what was committed and adds the rest; a count stored twice by parallel runs does no harm.
    """
    spark, version = docs.sparkSession, tokenizer_digest(path)
    stored = read_cache(spark, cache).filter(F.col("tokenizer") == version).select("digest")
    texts = docs.select(_digest().alias("digest"), F.coalesce("text", F.lit("")).alias("text"))
    misses = texts.groupBy("digest").agg(F.first("text").alias("text")).join(stored, "digest", "left_anti")

    def make():
        engine = counter(path, pattern)

        def compute(batch: pa.RecordBatch):
            return {"n_tokens": engine.counts(batch.column("text").to_pylist())}

        return compute

    counted = map_rows(misses, make, "n_tokens long", drop=("text",))
    counted.select("digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)


def token_counts(docs: DataFrame, cache: str, path: str, pattern: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row; null and empty texts have 0 of both.

    Two shuffles: texts without their copies, then digests alone. A digest that very many
    rows share is split by adaptive execution, as is any skewed join.
    """
    fill_cache(docs, cache, path, pattern)
    spark, version = docs.sparkSession, tokenizer_digest(path)
    stored = read_cache(spark, cache).filter(F.col("tokenizer") == version)
    # Written, so that the join reads plain shuffles of both sides and a hot digest can be split.
    stored = written(stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "counts")
    n_bytes = F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long")
    rows = docs.select("doc_id", n_bytes.alias("n_bytes"), _digest().alias("digest"))
    return rows.join(stored, "digest").select("doc_id", "n_bytes", "n_tokens")

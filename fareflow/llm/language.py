"""Language identification as a mixture: which languages a text is made of, and in what parts.

Training counts byte trigrams per language over all labelled training rows. For a text, expectation
maximisation estimates the proportions of languages that make its trigrams likeliest; languages
enter the set in the order of their proportions, each only if the likelihood grows by more than its
penalty. The largest proportion names the text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.llm.common import struct, emit, map_rows, slices

UNKNOWN = "und"
COUNTS = struct(lang=T.StringType(), bucket=T.IntegerType(), n=T.LongType())
#: ASCII that is no letter becomes a space.
_SPACES = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


@dataclass(frozen=True)
class Settings:
    #: Trigrams are hashed to so many buckets; the model has one float for each and each language.
    bits: int = 15
    smoothing: float = 0.5
    rounds: int = 15
    #: Log-likelihood that a language must add, in halves of log(trigrams). A letter is in three
    #: trigrams, so likelihoods count everything three times.
    penalty: float = 3.0
    #: Rows whose crc32 of the id is 0 modulo this are held out.
    folds: int = 5


def held_out(folds: int) -> Column:
    """Whether a row is held out; a row without an id is not, and is not learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))


def buckets(text: str, bits: int) -> np.ndarray:
    """The buckets of the byte trigrams of the lower-cased text, which counts as one line of letters."""
    data = f" {text.lower()} ".encode("utf-8", "surrogatepass").translate(_SPACES)
    x = np.frombuffer(data, np.uint8)
    x = x[np.concatenate([[True], (x[1:] != 32) | (x[:-1] != 32)])].astype(np.uint32)
    code = x[:-2] << np.uint32(16) | x[1:-1] << np.uint32(8) | x[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(32 - bits)


@dataclass
class Model:
    languages: list[str]
    #: Probability of a bucket in a language: buckets x languages.
    chance: np.ndarray

    def predict(self, text: str | None, settings: Settings) -> tuple[str, float]:
        """The main language and its part; UNKNOWN and 0 without letters, or if nothing was learned."""
        if text is None or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        count = np.bincount(buckets(text, settings.bits))
        seen = np.flatnonzero(count)
        count, chance = count[seen].astype(np.float64), self.chance[seen]
        parts = mixture(count, chance, settings)
        best = int(np.argmax(parts))
        return self.languages[best], float(min(max(parts[best], 0.0), 1.0))


def _maximise(count: np.ndarray, chance: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """Proportions after so many rounds of expectation and maximisation, and the log-likelihood."""
    total = count.sum()
    parts = np.full(chance.shape[1], 1 / chance.shape[1])
    for _ in range(rounds if len(parts) > 1 else 0):
        parts = parts * ((count / (chance @ parts)) @ chance) / total
    return parts, float(count @ np.log(chance @ parts))


def mixture(count: np.ndarray, chance: np.ndarray, settings: Settings) -> np.ndarray:
    """The proportion of every language: 0 for those not in the chosen set."""
    whole, _ = _maximise(count, chance, settings.rounds)
    order = np.argsort(-whole, kind="stable")
    price = settings.penalty * 0.5 * np.log(max(count.sum(), 2))
    # The best single language is compared by its own likelihood, not by its part of the mixture.
    alone = count @ np.log(chance)
    first = int(np.argmax(alone))
    order = np.array([first, *[i for i in order if i != first]])
    out = np.zeros(chance.shape[1])
    out[first], best = 1.0, float(alone[first])
    for k in range(2, len(order) + 1):
        parts, likelihood = _maximise(count, chance[:, order[:k]], settings.rounds)
        if likelihood - (k - 1) * price <= best:
            break
        best = likelihood - (k - 1) * price
        out[:] = 0
        out[order[:k]] = parts
    return out


def count_trigrams(docs: DataFrame, settings: Settings) -> DataFrame:
    """COUNTS over the rows (text, lang), summed in each task before the shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                for text, lang in zip(part.column("text").to_pylist(), part.column("lang").to_pylist()):
                    if lang not in counts:
                        counts[lang] = np.zeros(1 << settings.bits, np.int64)
                    counts[lang] += np.bincount(buckets(text, settings.bits), minlength=1 << settings.bits)
        for lang, count in counts.items():
            seen = np.flatnonzero(count)
            yield emit(COUNTS, {"lang": [lang] * len(seen), "bucket": seen, "n": count[seen]})

    counts = docs.select("text", "lang").mapInArrow(run, COUNTS)
    return counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """Learns from every row that has a text, a lang and an id and is not held out.

    The driver gets at most 2 ** bits numbers per language, however many rows there are.
    """
    known = F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
    rows = count_trigrams(docs.filter(known & ~held_out(settings.folds)), settings).toPandas()
    languages = sorted(rows["lang"].unique().tolist())
    counts = np.zeros((1 << settings.bits, len(languages)))
    counts[rows["bucket"], rows["lang"].map({x: i for i, x in enumerate(languages)}).astype(int)] = rows["n"]
    counts += settings.smoothing
    return Model(languages, (counts / counts.sum(axis=0)).astype(np.float32))


def identify(docs: DataFrame, model: Model, settings: Settings = Settings(), drop: tuple[str, ...] = ()) -> DataFrame:
    """The rows with lang_pred and score. Only the text is read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value

        def compute(batch: pa.RecordBatch):
            found = [model.predict(t, settings) for t in batch.column("text").to_pylist()]
            return {"lang_pred": [x for x, _ in found], "score": [x for _, x in found]}

        return compute

    return map_rows(docs, make, "lang_pred string, score double", drop)


def predictions(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; learned from the rows not held out.

    The share of held-out rows that get their own label is the measure of the model.
    """
    model = train(docs, settings)
    rows = docs.select("doc_id", held_out(settings.folds).alias("held_out"), "text")
    return identify(rows, model, settings, drop=("text",))

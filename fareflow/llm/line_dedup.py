"""Drops lines that many documents hold, behind two Bloom filters.

A first pass sets the hash of every long line in a filter of lines seen once and, when it was there
already, in a filter of lines seen twice. Filters of tasks merge bit by bit: what two of them have
seen once has been seen twice. A second pass emits only lines the second filter knows; those are
counted exactly, and the largest document that holds a line is chosen to keep it. The filters have no
false negatives, and a false positive is counted and found harmless.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.llm.common import struct, BLANKS, emit, free_name, map_rows, slices, written

#: Bytes of a filter that are merged at a time.
CHUNK = 8192
PARTS = struct(chunk=T.IntegerType(), once=T.BinaryType(), twice=T.BinaryType())
SUSPECTS = struct(id=T.LongType(), row=T.LongType(), digest=T.BinaryType())
#: Stands for a missing id: smaller than any other, and one document.
NO_ID = -(2**63)


@dataclass(frozen=True)
class Settings:
    least_chars: int = 20
    least_documents: int = 3
    #: Bits of a filter per line, and the most bits it may have (32 MB). Beyond that many lines the
    #: filter lets more through, and more lines are counted exactly; the result is the same.
    bits_per_line: int = 8
    most_bits: int = 2**28


def key(line: str, least_chars: int) -> bytes | None:
    """The line without outer white space, A-Z lower-cased; None if it is short."""
    line = line.strip(BLANKS)
    return line.encode("utf-8", "surrogatepass").lower() if len(line) >= least_chars else None


def lines(text: str | None) -> list[str]:
    return (text or "").split("\n")


def keys(text: str | None, least_chars: int) -> set[bytes]:
    return {k for line in lines(text) if (k := key(line, least_chars)) is not None}


class Filter:
    """A Bloom filter of 64-bit hashes with two probes."""

    def __init__(self, bits: int, data: np.ndarray | None = None):
        self.mask = np.uint64(bits - 1)
        self.data = np.zeros(bits // 8, np.uint8) if data is None else data

    def _probes(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return hashes & self.mask, (hashes >> np.uint64(32)) & self.mask

    def add(self, hashes: np.ndarray) -> None:
        for at in self._probes(hashes):
            np.bitwise_or.at(self.data, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for at in self._probes(hashes):
            found &= (self.data[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def _hashes(found: Iterable[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64)


def _bits(docs: DataFrame, settings: Settings) -> int:
    """A power of two that suits the number of lines, which Spark counts."""
    n = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    total = docs.agg(F.coalesce(F.sum(n.cast("long")), F.lit(0))).first()[0]
    return min(max(1 << int(total * settings.bits_per_line).bit_length(), 8 * CHUNK), settings.most_bits)


def seen_twice(docs: DataFrame, bits: int, settings: Settings) -> DataFrame:
    """The filter of lines that two documents hold, in chunks; chunks without a bit are left out."""

    def fill(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = Filter(bits), Filter(bits)
        for batch in batches:
            for part in slices(batch, "text"):
                found = [_hashes(keys(t, settings.least_chars)) for t in part.column("text").to_pylist()]
                if found and len(every := np.concatenate(found)):
                    every, count = np.unique(every, return_counts=True)
                    twice.add(every[(count > 1) | once.has(every)])
                    once.add(every)
        chunks = once.data.reshape(-1, CHUNK)
        for i in np.flatnonzero(chunks.any(axis=1)).tolist():
            pair = once.data[i * CHUNK : (i + 1) * CHUNK], twice.data[i * CHUNK : (i + 1) * CHUNK]
            yield emit(PARTS, {"chunk": [i], "once": [pair[0].tobytes()], "twice": [pair[1].tobytes()]})

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, once, twice = None, None, None
        for batch in batches:
            for i, a, b in zip(*[batch.column(c).to_pylist() for c in ("chunk", "once", "twice")]):
                a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
                if i != held:
                    if held is not None and twice.any():
                        yield emit(PARTS, {"chunk": [held], "once": [b""], "twice": [twice.tobytes()]})
                    held, once, twice = i, a.copy(), b.copy()
                else:
                    twice |= b | (once & a)
                    once |= a
        if held is not None and twice.any():
            yield emit(PARTS, {"chunk": [held], "once": [b""], "twice": [twice.tobytes()]})

    parts = docs.select("text").mapInArrow(fill, PARTS)
    dealt = parts.repartition("chunk").sortWithinPartitions("chunk")
    return dealt.mapInArrow(merge, PARTS).select("chunk", "twice")


def suspects(docs: DataFrame, settings: Settings) -> DataFrame:
    """id, row, digest: the long lines, once per row, that perhaps two documents hold.

    The filter, of at most ``most_bits``, goes to all tasks through the driver.
    """
    bits = _bits(docs, settings)
    data = np.zeros(bits // 8, np.uint8)
    for row in written(seen_twice(docs, bits, settings), "filter").toLocalIterator():
        data[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(row["twice"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(data)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = Filter(bits, shared.value)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, rows, digests = [], [], []
                for i, row, text in zip(*[part.column(c).to_pylist() for c in ("id", "row", "text")]):
                    if found := list(keys(text, settings.least_chars)):
                        kept = [k for k, hit in zip(found, twice.has(_hashes(found))) if hit]
                        ids += [i] * len(kept)
                        rows += [row] * len(kept)
                        digests += map(xxhash.xxh3_128_digest, kept)
                yield emit(SUSPECTS, {"id": ids, "row": rows, "digest": digests})

    return docs.select(_id().alias("id"), _row().alias("row"), "text").mapInArrow(run, SUSPECTS)


def _id() -> Column:
    return F.coalesce(F.col("doc_id"), F.lit(NO_ID))


def _row() -> Column:
    """Tells the rows without an id apart by their texts, as they are one document but not one group.

    Texts that happen to share a hash share a list of lost lines; each line of it is lost to all of them.
    """
    return F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0))


def dropped_lines(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """id, row, digests: the lines that a document loses. Only suspects are shuffled, as 32 bytes each.

    Counts are combined in each task, so a line in a third of all documents is a row per task; the
    join that deals the verdict back is split by adaptive execution.
    """
    found = written(suspects(docs, settings).distinct(), "suspects")
    # All rows without an id count as one document.
    nameless = F.col("id") == NO_ID
    n = F.count_if(~nameless) + F.max(nameless.cast("long"))
    common = found.groupBy("digest").agg(n.alias("n"), F.max("id").alias("keeper"))
    # Written, so that the join reads a plain shuffle of the suspects and a hot line can be split.
    common = written(common.filter(F.col("n") >= settings.least_documents).select("digest", "keeper"), "common")
    lost = found.join(common, "digest").filter("id <> keeper")
    return lost.groupBy("id", "row").agg(F.collect_list("digest").alias("digests"))


def _with_losses(docs: DataFrame, name: str, settings: Settings) -> DataFrame:
    """The rows with the digests they lose in column ``name``."""
    lost = dropped_lines(docs.select("doc_id", "text"), settings)
    identity, row = free_name(docs.columns, "lost_id"), free_name(docs.columns, "lost_row")
    lost = lost.select(F.col("id").alias(identity), F.col("row").alias(row), F.col("digests").alias(name))
    matches = (_id() == F.col(identity)) & (_row() == F.col(row))
    return docs.join(lost.hint("shuffle_hash"), matches, "left").drop(identity, row)


def _kept(text: str | None, lost: list[bytes] | None, settings: Settings) -> tuple[str, int, int]:
    """The text without its lost lines, how many it had and how many are gone."""
    every = lines(text)
    if not lost:
        return text or "", len(every), 0
    gone = set(lost)
    keyed = ((line, key(line, settings.least_chars)) for line in every)
    rest = [line for line, k in keyed if k is None or xxhash.xxh3_128_digest(k) not in gone]
    return "\n".join(rest), len(every), len(every) - len(rest)


def digests(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 of every row.

    A null or empty text is one empty line. Rows without an id count as one document, smaller than any
    other; rows that share an id are one document. Repeated rows lose the same lines.
    """
    rows = _with_losses(docs.select("doc_id", "text"), "lost", settings)

    def make():
        def compute(batch: pa.RecordBatch):
            pairs = zip(batch.column("text").to_pylist(), batch.column("lost").to_pylist())
            kept, n, gone = zip(*[_kept(t, x, settings) for t, x in pairs])
            sums = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in kept]
            return {"n_lines": n, "n_dropped": gone, "kept_sha256": sums}

        return compute

    return map_rows(rows, make, "n_lines long, n_dropped long, kept_sha256 string", ("text", "lost"))


def drop_common_lines(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` with their texts shortened; ``n_chars``, where there is one, follows.

    A text that loses all its lines becomes empty; a null text stays null.
    """
    name = free_name(docs.columns, "lost_digests")
    rows = _with_losses(docs, name, settings)

    def make():
        def compute(batch: pa.RecordBatch):
            pairs = zip(batch.column("text").to_pylist(), batch.column(name).to_pylist())
            return {"text": [t if t is None else _kept(t, x, settings)[0] for t, x in pairs]}

        return compute

    changed = F.col(name).isNotNull()
    if "n_chars" not in docs.columns:
        return map_rows(rows, make, "text string", (name,)).select(*docs.columns)
    flag = free_name([*docs.columns, name], "shortened")
    out = map_rows(rows.withColumn(flag, changed), make, "text string", (name,))
    length = F.when(F.col(flag), F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", length).select(*docs.columns)

"""Nearest neighbours by multi-index hashing of learned binary codes.

A rotation learned on a sample turns each vector into 64 bits. The code is cut into parts, and each part
has an index of its own: rows by the value of that part. Two codes within a radius r differ by few bits
in some part, so probing each index for the values near the query's own part retrieves every code within
r (pigeonhole); a row that several parts retrieve counts in the first. What is retrieved is ranked by its
distance in the vectors themselves. The radius is learned too: the smallest that holds the wanted share
of the true neighbours within the sample. Rows stand closer in the whole table than in a sample of it, so
there the share can only be larger. A query whose radius holds too few rows is asked again with a wider
one, in the end with one that holds every row.

Index rows are dealt by part and leading bits of its value into cells; a cell of too many rows is split
by a salt, and queries go to the cells that their probes can reach.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.llm.common import emit, free_name, map_rows, struct, written
from fareflow.llm.topk import usable

BITS = 64
FOUND = struct(query_id=T.LongType(), vec_id=T.LongType(), score=T.DoubleType())


@dataclass(frozen=True)
class Settings:
    k: int = 10
    #: Rows whose id is divisible by this are queries.
    every: int = 100
    #: Parts of a code; a divisor of 64, so that a part has 16 bits at most 4 parts on.
    parts: int = 4
    #: Rows the rotation and the radius are learned from, about, and how many of them are asked for the radius.
    sample: int = 8192
    asked: int = 512
    #: The share of the true neighbours in the sample that the radius holds.
    recall: float = 0.97
    turns: int = 30
    #: Index rows of a cell and queries of a block, about.
    cell: int = 4096
    queries: int = 4096

    @property
    def width(self) -> int:
        """Bits of a part."""
        return BITS // self.parts


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; missing components at the end are 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out


@dataclass(frozen=True)
class Codes:
    """Learned binary codes: bit i is the side of a hyperplane through the sample's mean."""

    mean: np.ndarray
    planes: np.ndarray
    scale: float

    @classmethod
    def learn(cls, sample: np.ndarray, turns: int) -> Codes:
        """Principal directions, rotated so that the sample lies as close as it can to its own signs.

        Vectors of fewer than 64 components get several such rotations, from several starts.
        """
        n, width = sample.shape
        scale = float(np.abs(sample).max(initial=0)) or 1.0
        sample = sample / scale
        mean = sample.mean(axis=0) if n else np.zeros(width)
        centred = sample - mean
        _, directions = np.linalg.eigh(centred.T @ centred)
        directions = directions[:, ::-1][:, :BITS]
        flat, kept, random = centred @ directions, [], np.random.default_rng(1)
        for _ in range(-(-BITS // directions.shape[1])):
            rotation = np.linalg.qr(random.standard_normal((flat.shape[1],) * 2))[0]
            for _ in range(turns):
                left, _, right = np.linalg.svd(flat.T @ np.where(flat @ rotation > 0, 1.0, -1.0))
                rotation = left @ right
            kept.append(directions @ rotation)
        return cls(mean, np.concatenate(kept, axis=1)[:, :BITS], scale)

    def of(self, vectors: np.ndarray) -> np.ndarray:
        with np.errstate(all="ignore"):
            bits = (vectors / self.scale - self.mean) @ self.planes > 0
        return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        apart = vectors - query
        return np.sqrt((apart * apart).sum(axis=1))


def learned_radius(sample: np.ndarray, codes: np.ndarray, settings: Settings) -> int:
    """The least radius that holds the wanted share of the neighbours of sample rows within the sample."""
    if len(sample) <= settings.k + 1:
        return BITS
    apart = []
    for i in range(min(settings.asked, len(sample))):
        d = distances(sample, sample[i])
        d[i] = np.inf
        near = np.argpartition(d, settings.k)[: settings.k]
        apart.append(np.bitwise_count(codes[near] ^ codes[i]))
    apart = np.sort(np.concatenate(apart))
    return int(apart[min(int(np.ceil(settings.recall * len(apart))), len(apart)) - 1])


def part_radii(radius: int, settings: Settings) -> list[int]:
    """How many bits may differ in each part, so that every code within ``radius`` is found in one; -1: none.

    With radius = parts * q + rest, a code that differs by more than q in the first rest + 1 parts and by
    more than q - 1 in the others differs by more than the radius.
    """
    q, rest = divmod(radius, settings.parts)
    if q >= settings.width:
        return [settings.width] + [-1] * (settings.parts - 1)
    return [q if i <= rest else q - 1 for i in range(settings.parts)]


class Index:
    """The rows of a cell by the value of one part of their codes."""

    def __init__(self, ids: list[list[int]], vectors: np.ndarray, codes: np.ndarray, part: int, settings: Settings):
        self.part, self.settings = part, settings
        order = np.argsort(self.values(codes, part), kind="stable")
        self.ids, self.vectors, self.codes = [ids[i] for i in order.tolist()], vectors[order], codes[order]
        self.buckets, self.starts = np.unique(self.values(self.codes, part), return_index=True)
        self.starts = np.append(self.starts, len(codes))
        self.masks: dict[int, np.ndarray] = {}

    def values(self, codes: np.ndarray, part: int) -> np.ndarray:
        width = self.settings.width
        return codes >> np.uint64(width * part) & np.uint64(2**width - 1)

    def near(self, value: np.uint64, radius: int) -> np.ndarray:
        """The buckets whose values differ from ``value`` by at most ``radius`` bits."""
        if self.settings.width <= 16 and radius < self.settings.width:
            if radius not in self.masks:
                every = np.arange(2**self.settings.width, dtype=np.uint64)
                self.masks[radius] = every[np.bitwise_count(every) <= radius]
            if len(masks := self.masks[radius]) < len(self.buckets):
                probes = masks ^ value
                at = np.searchsorted(self.buckets, probes).clip(max=len(self.buckets) - 1)
                return at[self.buckets[at] == probes]
        return np.flatnonzero(np.bitwise_count(self.buckets ^ value) <= radius)

    def within(self, code: np.uint64, radius: int, radii: list[int]) -> np.ndarray:
        """The rows within ``radius`` that no earlier part retrieves."""
        near = self.near(self.values(code, self.part), radii[self.part])
        many = self.starts[near + 1] - self.starts[near]
        rows = np.arange(many.sum()) + np.repeat(self.starts[near] - np.cumsum(many) + many, many)
        apart = self.codes[rows] ^ code
        kept = np.bitwise_count(apart) <= radius
        for part in range(self.part):
            kept &= np.bitwise_count(self.values(apart, part)) > radii[part]
        return rows[kept]

    def best(self, query_id: int, query: np.ndarray, rows: np.ndarray) -> list[tuple[float, int]]:
        """Distance and id of the k nearest of ``rows``, the query itself left out."""
        k, d = self.settings.k, distances(self.vectors[rows], query)
        # One row may be the query alone, and rows at the distance of the last may have smaller ids.
        if len(d) > k + 1:
            near = d <= np.partition(d, k)[k]
            rows, d = rows[near], d[near]
        found = [(x, i) for x, row in zip(d.tolist(), rows.tolist()) for i in self.ids[row] if i != query_id]
        return sorted(found)[:k]


def _coded(df: DataFrame, codes: Codes, width: int) -> DataFrame:
    """The rows with their code (long)."""
    size = free_name(df.columns, "size_")

    def make():
        return lambda batch: {"code": codes.of(matrix(batch.column("vector"), width)).view(np.int64)}

    # Slices go by the bytes of a text column; vectors are cut into batches already.
    return map_rows(df.withColumn(size, F.lit("")), make, "code long", drop=(size,), text=size)


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """ids (the k + 1 smallest), vector of every different vector: copies are all at one distance."""
    key = [F.xxhash64("vector"), F.col("vector")]
    order = Window.partitionBy(*key).orderBy("vec_id")
    first = rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    return first.groupBy(*key).agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select("ids", "vector")


def _value(part: int, settings: Settings, leading: int) -> Column:
    """The leading bits of a part of the code."""
    kept = F.shiftrightunsigned("code", settings.width * part + settings.width - leading)
    return kept.bitwiseAND(2**leading - 1)


def _search(asked: DataFrame, index: DataFrame, n: int, width: int, radius: int, settings: Settings) -> DataFrame:
    """query_id, vec_id, score: in each cell the k nearest of the rows within ``radius``."""
    radii = part_radii(radius, settings)
    leading = min(settings.width, 16, max(0, int(np.ceil(np.log2(max(n / settings.cell, 1))))))
    used = [i for i, most in enumerate(radii) if most >= 0]
    n_blocks = -(-asked.count() // settings.queries) or 1

    def cells(i: int) -> Column:
        return F.struct(F.lit(i).alias("part"), _value(i, settings, leading).alias("value"))

    placed = index.select("ids", "vector", "code", F.explode(F.array(*[cells(i) for i in used])).alias("at"))
    placed = placed.select("ids", "vector", "code", "at.*")
    # A row for each part and leading bits: 2**16 times the parts at most.
    sizes = written(placed.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n")), "cells")
    salts = F.broadcast(sizes.select("part", "value", F.ceil(F.col("n") / settings.cell).cast("int").alias("salts")))
    salt = F.pmod(F.xxhash64(F.col("ids")[0]), F.col("salts")).cast("int").alias("salt")
    every = lambda m: F.sequence(F.lit(0), m - 1)
    rows = placed.join(salts, ["part", "value"]).select(
        "part", "value", salt, F.explode(every(F.lit(n_blocks))).alias("block"), "ids", "vector", "code"
    )

    def probes(i: int) -> DataFrame:
        """The queries with the leading bits that rows of part ``i`` may have within its radius."""
        own = _value(i, settings, leading)
        masks = F.filter(F.sequence(F.lit(0), F.lit(2**leading - 1)), lambda m: F.bit_count(m) <= radii[i])
        near = F.explode(F.transform(masks, lambda m: own.bitwiseXOR(m)))
        return asked.select(F.lit(i).alias("part"), near.alias("value"), "query_id", "vector", "code")

    reached = reduce(DataFrame.unionAll, map(probes, used))
    block = F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)).cast("int").alias("block")
    questions = reached.join(salts, ["part", "value"]).select(
        "part", "value", F.explode(every(F.col("salts"))).alias("salt"), block, "query_id", "vector", "code"
    )

    def run(questions: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if questions.num_rows and rows.num_rows:
            codes = lambda t: t.column("code").to_numpy().view(np.uint64)
            part = rows.column("part")[0].as_py()
            cell = Index(rows.column("ids").to_pylist(), matrix(rows.column("vector"), width), codes(rows), part, settings)
            ids = questions.column("query_id").to_pylist()
            for i, query, code in zip(ids, matrix(questions.column("vector"), width), codes(questions)):
                best = cell.best(i, query, cell.within(code, radius, radii))
                out[0] += [i] * len(best)
                out[1] += [x for _, x in best]
                out[2] += [d for d, _ in best]
        return pa.Table.from_batches([emit(FOUND, dict(zip(FOUND.names, out)))])

    key = ["part", "value", "salt", "block"]
    return questions.groupBy(*key).cogroup(rows.groupBy(*key)).applyInArrow(run, FOUND)


def nearest(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k nearest rows found for each query, ties by vec_id.

    ``vectors`` has vec_id and embedding. Rows without an id, and vectors that are null, all zero or hold
    a null or non-finite component take no part; of different vectors under one id the smallest counts;
    shorter vectors end in zeros. Score: the Euclidean distance of the vectors in doubles. A query gets k
    rows if there are that many others, else all of them; without others it has no rows.
    """
    spark = vectors.sparkSession
    rows = usable(vectors.select("vec_id", "embedding")).filter(F.exists("vector", lambda x: x != 0))
    rows = written(rows.select(F.col("vec_id").cast("long"), "vector"), "vectors")
    n, width = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if n < 2:
        return empty
    share = F.lit(min(1.0, settings.sample / n))
    drawn = F.pmod(F.xxhash64("vec_id", F.lit("sample")), F.lit(2**40)) < share * F.lit(float(2**40))
    drawn = rows.filter(drawn).orderBy("vec_id").select("vector").toArrow()
    sample = matrix(drawn.column("vector"), width) if drawn.num_rows else np.zeros((0, width))
    codes = Codes.learn(sample, settings.turns)
    radius = learned_radius(sample, codes.of(sample), settings)

    index = written(_coded(distinct_vectors(rows, settings.k), codes, width), "codes")
    asked = rows.filter(F.col("vec_id") % settings.every == 0).select(F.col("vec_id").alias("query_id"), "vector")
    asked = written(_coded(asked, codes, width), "questions")
    wanted = min(settings.k, n - 1)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    result = None
    for wider in sorted({radius, (radius + BITS) // 2, BITS}):
        found = _search(asked, index, n, width, wider, settings)
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= wanted)
        ranked = written(ranked.select("query_id", "rank", "vec_id", "score"), "ranked")
        served = ranked.filter(F.col("rank") == wanted).select("query_id")
        short = written(asked.join(served, "query_id", "left_anti"), "questions")
        # Of a query that is asked again only the last answer counts, which is a full one.
        kept = ranked.join(short.select("query_id"), "query_id", "left_anti")
        result = kept if result is None else result.unionAll(kept)
        asked = short
        if asked.isEmpty():
            break
    return result.select("query_id", "rank", "vec_id", "score")

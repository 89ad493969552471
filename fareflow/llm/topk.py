"""Exact top-k by inner product, with the threshold algorithm over sorted lists per dimension.

Queries and candidates are dealt into blocks; a cell is a block of queries with a block of
candidates. In a cell each dimension has a list of the candidates by value. A query reads all its
lists from the end its sign prefers, in steps; a candidate met for the first time is scored in full. No
candidate that has not been met can score more than the query times the values read last, so a query
stops when its k-th score is above that bound. The best of all cells are ranked at the end.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from fareflow.llm.common import emit, struct
from pyspark.sql.pandas.types import to_arrow_schema


@dataclass(frozen=True)
class Settings:
    k: int = 20
    #: Components become floor(scale * x).
    scale: int = 64
    #: Rows whose id is divisible by this are queries.
    every: int = 20
    #: Rows of a block, about.
    queries: int = 1024
    candidates: int = 8192
    #: Entries of each list read in the first step; each step reads as many again as all before.
    step: int = 32


FOUND = struct(query_id=T.LongType(), vec_id=T.LongType(), score=T.LongType())
LEAST, MOST = -(2**63), 2**63 - 1


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, vector (array of double) of the rows that take part, one per id.

    Left out: rows without an id, null vectors, vectors with a null or non-finite component. Of
    different vectors under one id the smallest counts.
    """
    value = F.col("embedding").cast("array<double>")
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad)
    return rows.groupBy("vec_id").agg(F.min(value).alias("vector"))


def matrix(column: pa.ChunkedArray, width: int, scale: int) -> np.ndarray:
    """The vectors as rows of whole numbers; missing components at the end are 0.

    As doubles if every inner product is exact in them, else as Python's numbers.
    """
    vectors = column.to_pylist()
    out = np.zeros((len(vectors), width))
    for row, vector in zip(out, vectors):
        row[: len(vector)] = vector
    with np.errstate(over="ignore"):
        out = np.floor(out * scale)
    out = np.clip(out, -1e300, 1e300)
    most = float(np.abs(out).max(initial=0))
    if most * most * max(width, 1) < 2**52:
        return out
    return np.array([[int(x) for x in row] for row in out.tolist()], object).reshape(out.shape)


class Lists:
    """The candidates of a cell, with a list of them by value for each dimension."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        self.order = np.argsort(self.values, axis=0, kind="stable").T.copy()

    def best(self, query_id: int, query: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best candidates, best first, ties by id."""
        n = len(self.ids)
        met = self.ids == query_id
        found, scores = np.empty(0, np.int64), np.empty(0, self.values.dtype)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        read, step = 0, settings.step
        while read < n:
            end = min(read + step, n)
            near = [self.order[up, n - end : n - read].ravel(), self.order[down, read:end].ravel()]
            fresh = np.zeros(n, bool)
            fresh[np.concatenate(near)] = True
            fresh = np.flatnonzero(fresh & ~met) if len(up) + len(down) else np.flatnonzero(~met)
            met[fresh] = True
            found = np.concatenate([found, fresh])
            scores = np.concatenate([scores, self.values[fresh] @ query])
            # Candidates stand in the order of their ids, so their places break ties.
            top = np.lexsort((found, -scores))[: settings.k]
            found, scores = found[top], scores[top]
            last = self.values[self.order[up, n - end], up] @ query[up]
            last += self.values[self.order[down, end - 1], down] @ query[down]
            if met.all() or (len(scores) == settings.k and scores[-1] > last):
                break
            read, step = end, end
        return self.ids[found], scores


def top_k(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k best other rows; all, if fewer.

    The work is queries times rows by its nature; a block is shuffled once per block of the other
    side. Scores beyond 64 bits are given as the nearest that fits. Shorter vectors end in zeros.
    """
    rows = usable(vectors)
    n, asked, width = rows.agg(
        F.count(F.lit(1)), F.count(F.when(F.col("vec_id") % settings.every == 0, 1)),
        F.coalesce(F.max(F.size("vector")), F.lit(0)),
    ).first()
    query_blocks, blocks = -(-asked // settings.queries) or 1, -(-n // settings.candidates) or 1
    place = F.xxhash64("vec_id")
    upto = lambda m: F.sequence(F.lit(0), F.lit(m - 1))
    asking = rows.filter(F.col("vec_id") % settings.every == 0).select(
        F.pmod(place, F.lit(query_blocks)).cast("int").alias("q"), F.explode(upto(blocks)).alias("c"),
        F.lit(0).alias("side"), "vec_id", "vector",
    )
    asked_for = rows.select(
        F.explode(upto(query_blocks)).alias("q"), F.pmod(place, F.lit(blocks)).cast("int").alias("c"),
        F.lit(1).alias("side"), "vec_id", "vector",
    )

    def run(cell: pa.Table) -> pa.Table:
        side, ids = cell.column("side").to_numpy(), cell.column("vec_id").to_numpy()
        values = matrix(cell.column("vector"), width, settings.scale)
        lists = Lists(ids[side == 1], values[side == 1])
        out: list[list] = [[], [], []]
        if len(lists.ids):
            for query_id, query in zip(ids[side == 0].tolist(), values[side == 0]):
                found, scores = lists.best(query_id, query, settings)
                out[0] += [query_id] * len(found)
                out[1] += found.tolist()
                out[2] += [min(max(int(s), LEAST), MOST) for s in scores]
        batch = emit(FOUND, dict(zip(FOUND.names, out)))
        return pa.Table.from_batches([batch], to_arrow_schema(FOUND))

    found = asking.unionAll(asked_for).groupBy("q", "c").applyInArrow(run, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= settings.k)
    return ranked.select("query_id", "rank", "vec_id", "score")

"""Near-duplicates: MinHash bands for candidates, Bayesian pruning in batches, exact verification.

Texts with the same shingle set are one node. Nodes that share a band of their signatures are
candidates. A candidate pair's signatures are compared batch by batch, and the pair is dropped as
soon as the posterior probability that its similarity reaches the threshold falls below a chosen miss
probability. What survives is confirmed on the full shingle sets.

Pairs of a bucket are never all listed. First each node is paired with the smallest one of its
buckets, which links a group of near copies with one pair per member. Then only pairs that cross
components matter: in a bucket with several components, the members outside its largest one meet
all members, in cells of bounded size. A cell passes on the members that have a partner left after
pruning; these are compared on their full sets, cell by cell, and a cell gives the links that merge its
components: fewer than it has members, however many pairs it holds.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.llm.common import struct, emit, map_rows, written
from fareflow.llm.components import components
from fareflow.llm.shingles import MinHash, set_key, shingle_set


@dataclass(frozen=True)
class Settings:
    """With 25 bands of 5, a pair of similarity 0.85 shares no band with probability 4e-7."""

    #: Linked if 100 * intersection >= percent * union.
    percent: int = 85
    bands: int = 25
    rows: int = 5
    #: Hashes per batch, and the probability at which a pair that should be linked may be dropped.
    batch: int = 25
    miss: float = 1e-6
    #: Members of either side of a cell, about.
    cell: int = 256

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


@lru_cache(maxsize=8)
def least_matches(settings: Settings) -> list[tuple[int, int]]:
    """After n hashes of a pair, how many must have matched for it to go on: (n, matches).

    With a uniform prior the similarity after m of n matches has a beta(m + 1, n - m + 1) posterior;
    its upper tail at t is the chance that n + 1 trials of probability t succeed at most m times.
    """
    t, out = settings.percent / 100, []
    for n in [*range(settings.batch, settings.hashes, settings.batch), settings.hashes]:
        tail, m = 0.0, 0
        while m <= n:
            tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if tail >= settings.miss:
                break
            m += 1
        out.append((n, m))
    return out


def prune(left: np.ndarray, right: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of two signature matrices survive all batches, and their matches."""
    alive, matches, done = np.arange(len(left)), np.zeros(len(left), np.int32), 0
    for n, least in least_matches(settings):
        matches = matches + (left[alive, done:n] == right[alive, done:n]).sum(axis=1, dtype=np.int32)
        keep = matches >= least
        alive, matches, done = alive[keep], matches[keep], n
    return alive, matches


def _matrix(column: pa.Array, settings: Settings) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, settings.hashes)


def describe(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, n_shingles, and of non-empty documents the key of the set and the signature."""

    def make():
        minhash = MinHash(settings.hashes)

        def compute(batch: pa.RecordBatch):
            sizes, keys, signatures = [], [], []
            last = None, None
            for text in batch.column("text").to_pylist():
                if text != last[0] or last[1] is None:
                    found = shingle_set(text)
                    row = len(found), None, None
                    if len(found):
                        row = len(found), set_key(found), minhash.signature(found)
                    last = text, row
                for values, value in zip((sizes, keys, signatures), last[1]):
                    values.append(value)
            return {"n_shingles": sizes, "set_key": keys, "signature": signatures}

        return compute

    return map_rows(
        docs.select("doc_id", "text"), make, "n_shingles long, set_key binary, signature binary", ("text",)
    )


def _verify(texts: DataFrame, pairs: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; texts: node, text."""
    left = texts.join(pairs, F.col("node") == F.col("a")).select("a", "b", F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = left.join(right, "b").select("a", "b", "text_a", "text_b")

    def make():
        last: tuple[str | None, np.ndarray | None] = (None, None)

        def compute(batch: pa.RecordBatch):
            nonlocal last
            linked = []
            for x, y in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
                if last[1] is None or last[0] != y:
                    last = y, shingle_set(y)
                x, y = shingle_set(x), last[1]
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(common > 0 and 100 * common >= settings.percent * (len(x) + len(y) - common))
            return {"linked": linked}

        return compute

    judged = map_rows(both, make, "linked boolean", ("text_a", "text_b"), "text_a")
    return judged.filter("linked").select("a", "b")


def _centre_pairs(placed: DataFrame, nodes: DataFrame, settings: Settings) -> DataFrame:
    """Each node with the smallest node of each of its buckets, where the signatures allow a link."""
    pairs = placed.filter("node <> centre").select(F.col("centre").alias("b"), F.col("node").alias("a")).distinct()
    left = nodes.select(F.col("node").alias("a"), F.col("signature").alias("left"))
    right = nodes.select(F.col("node").alias("b"), F.col("signature").alias("right"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = _matrix(batch.column("left"), settings), _matrix(batch.column("right"), settings)
                yield batch.select(["a", "b"]).take(pa.array(prune(x, y, settings)[0]))

    return rows.mapInArrow(run, "a long, b long")


def _cells(members: DataFrame, nodes: DataFrame, roots: DataFrame, settings: Settings) -> DataFrame:
    """The members of buckets with several components, dealt out to cells of bounded size.

    Side 0 of a cell holds members outside the bucket's largest component, side 1 any members.
    """
    placed = members.join(roots, "node", "left").withColumn("component", F.coalesce("component", "node"))
    counts = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct("n", "component")
    mixed = counts.groupBy("bucket").agg(
        F.sum("n").alias("size"), F.max(order).alias("top"), F.count(F.lit(1)).alias("parts")
    )
    mixed = mixed.filter("parts > 1").select(
        "bucket", F.col("top.component").alias("largest"),
        F.ceil((F.col("size") - F.col("top.n")) / settings.cell).alias("rows"),
        F.ceil(F.col("size") / settings.cell).alias("columns"),
    )
    rows = placed.join(mixed, "bucket")
    spread = F.xxhash64("node", F.lit(7))
    upto = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    column = F.pmod(spread, F.col("columns"))
    all_members = rows.withColumn("row", F.explode(upto("rows"))).withColumn("column", column)
    minority = rows.filter("component <> largest").withColumn("column", F.explode(upto("columns")))
    minority = minority.withColumn("row", F.pmod(spread, F.col("rows")))
    keep = ["bucket", "row", "column", "side", "node", "component"]
    sides = (
        minority.withColumn("side", F.lit(0)).select(*keep)
        .unionAll(all_members.withColumn("side", F.lit(1)).select(*keep))
    )
    return sides.join(nodes.select("node", "signature"), "node").select(*keep, "signature")


MEMBER = struct(
    bucket=T.LongType(), row=T.LongType(), column=T.LongType(), side=T.IntegerType(), node=T.LongType(),
    component=T.LongType(),
)
EDGE = struct(a=T.LongType(), b=T.LongType())
CELL = ["bucket", "row", "column"]
#: Shingles whose occurrences in a cell's members are multiplied at a time.
COLUMNS = 8192


class _Cells:
    """Rows of cells as arrays, in the order of their cells."""

    def __init__(self, key, side, node, component, payload):
        self.fields = key, side, node, component, payload
        self.key, self.side, self.node, self.component, self.payload = self.fields

    @classmethod
    def read(cls, batch: pa.RecordBatch, payload: np.ndarray) -> _Cells:
        get = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
        key = np.stack([get(c) for c in CELL], axis=1)
        return cls(key, get("side"), get("node"), get("component"), payload)

    def after(self, held: _Cells) -> _Cells:
        return _Cells(*[np.concatenate(pair) for pair in zip(held.fields, self.fields)])

    def rows(self, at) -> _Cells:
        return _Cells(*[x[at] for x in self.fields])

    def bounds(self) -> np.ndarray:
        """Where cells begin, and the end."""
        changes = (self.key[1:] != self.key[:-1]).any(axis=1)
        return np.concatenate([[0], np.flatnonzero(changes) + 1, [len(self.key)]])


def _by_cell(rows: DataFrame, payload, work, schema: T.StructType) -> DataFrame:
    """``work`` on each cell of the rows; ``payload`` makes the array of what a batch's rows carry.

    ``work`` takes the cells and the bounds of those that are complete, and returns columns.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows:
                now = _Cells.read(batch, payload(batch))
                now = now.after(held) if held else now
                bounds = now.bounds()
                yield emit(schema, work(now, bounds[:-1]))
                held = now.rows(slice(bounds[-2], None))
        if held:
            yield emit(schema, work(held, np.array([0, len(held.key)])))

    return rows.repartition(*CELL).sortWithinPartitions(*CELL).mapInArrow(run, schema)


def _with_partners(cells: DataFrame, settings: Settings) -> DataFrame:
    """The members of cells that have a partner on the other side left after pruning."""
    first, least = least_matches(settings)[0]

    def partners(cell: _Cells) -> np.ndarray:
        matrix, component = cell.payload, cell.component
        x, y = np.flatnonzero(cell.side == 0), np.flatnonzero(cell.side == 1)
        found = np.zeros(len(matrix), bool)
        for i in x:
            others = y[component[y] != component[i]]
            others = others[(matrix[others, :first] == matrix[i, :first]).sum(axis=1) >= least]
            if len(others):
                mine = np.broadcast_to(matrix[i], (len(others), settings.hashes))
                others = others[prune(mine, matrix[others], settings)[0]]
                found[others] = True
                found[i] = len(others) > 0
        return found

    def work(cells: _Cells, bounds: np.ndarray) -> dict:
        parts = [partners(cells.rows(slice(a, b))) for a, b in zip(bounds, bounds[1:])]
        kept = cells.rows(np.flatnonzero(np.concatenate([*parts, np.zeros(len(cells.key) - bounds[-1], bool)])))
        values = (*kept.key.T, kept.side, kept.node, kept.component)
        return dict(zip(MEMBER.names, values))

    return _by_cell(cells, lambda batch: _matrix(batch.column("signature"), settings), work, MEMBER)


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of the sets share, as a matrix.

    Elements of one set only are left out; the others are multiplied out in blocks of columns.
    """
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1
    common = count[column] > 1
    owner, column = owner[common], number[column[common]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    shared = np.zeros((len(sets), len(sets)))
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        at = slice(*np.searchsorted(column, [start, start + COLUMNS]))
        block = np.zeros((len(sets), COLUMNS), np.float32)
        block[owner[at], column[at] - start] = 1
        shared += block @ block.T
    return shared


def _cell_links(members: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b) on full sets that join the components of each cell."""

    def links(cell: _Cells) -> list[tuple[int, int]]:
        nodes, first, at = np.unique(cell.node, return_index=True, return_inverse=True)
        sets = [shingle_set(text) for text in cell.payload[first]]
        size = np.array([len(x) for x in sets])
        shared = shared_counts(sets)
        near = (shared > 0) & (100 * shared >= settings.percent * (size[:, None] + size - shared))
        asked, met = (np.unique(at[cell.side == side]) for side in (0, 1))
        component = cell.component[first].tolist()
        root = {c: c for c in component}

        def find(c):
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        out = []
        for x, y in zip(*np.nonzero(near[np.ix_(asked, met)])):
            x, y = int(asked[x]), int(met[y])
            a, b = find(component[x]), find(component[y])
            if a != b:
                root[a] = b
                out.append((int(nodes[x]), int(nodes[y])))
        return out

    def work(cells: _Cells, bounds: np.ndarray) -> dict:
        found = [pair for a, b in zip(bounds, bounds[1:]) for pair in links(cells.rows(slice(a, b)))]
        return {"a": [max(p) for p in found], "b": [min(p) for p in found]}

    def payload(batch: pa.RecordBatch) -> np.ndarray:
        return np.array(batch.column("text").to_pylist(), object)

    return _by_cell(members.join(texts, "node").select(*MEMBER.names, "text"), payload, work, EDGE)


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links) and kept of each row.

    A document without words has an empty set, no links and itself as its component. A row without
    an id takes no part: component null, kept. Repeated rows get the same result. Rows with one id but
    different texts should not occur; they count as one document where that id stands for its set.
    """
    described = written(describe(docs, settings), "signatures")
    able = described.filter("n_shingles > 0 and doc_id is not null")
    sets = able.groupBy("set_key").agg(
        F.min("doc_id").alias("node"), F.first("signature").alias("signature"), F.count(F.lit(1)).alias("n")
    )
    sets = written(sets, "sets")
    nodes = sets.select("node", "signature")

    width = 4 * settings.rows
    bands = [
        F.xxhash64(F.lit(i), F.substring("signature", i * width + 1, width)) for i in range(settings.bands)
    ]
    banded = nodes.select("node", F.explode(F.array(*bands)).alias("bucket"))
    buckets = banded.groupBy("bucket").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("n"))
    buckets = buckets.filter("n > 1").select("bucket", "centre")
    placed = written(banded.join(buckets, "bucket"), "buckets")
    members = placed.select("bucket", "node")

    # Only the texts of nodes that have a candidate are looked at again.
    wanted = members.select(F.col("node").alias("doc_id")).distinct()
    texts = docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi")
    texts = written(texts.select(F.col("doc_id").alias("node"), "text"), "texts")

    edges = written(_verify(texts, _centre_pairs(placed, nodes, settings), settings), "links")
    roots = components(edges)
    left = written(_with_partners(_cells(members, nodes, roots, settings), settings), "members")
    more = written(_cell_links(left, texts, settings), "links")
    if not more.isEmpty():
        roots = components(edges.unionAll(more))

    # A set of one document without links is its own component: nothing to look up.
    named = sets.select("set_key", "node", "n").join(roots, "node", "left").filter("n > 1 or component is not null")
    named = named.select("set_key", F.coalesce("component", "node").alias("component"))
    rows = described.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    out = rows.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One document of each group of near-duplicates, with its columns as they are."""
    found = near_duplicates(docs.select("doc_id", "text"), settings).filter("doc_id is not null")
    ids = found.groupBy("doc_id").agg(F.min("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    ids = written(ids.filter("not kept or n > 1"), "changed")
    # Hashing the ids, not sorting the texts.
    rest = docs.join(ids.select("doc_id").hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns)
    # Rows that were repeated as they are: one of each id. Mostly there are none to look for.
    if ids.filter("kept").isEmpty():
        return rest
    repeated = docs.join(ids.filter("kept").select("doc_id"), "doc_id", "left_semi").select(*docs.columns)
    return rest.unionAll(repeated.dropDuplicates(["doc_id"]))

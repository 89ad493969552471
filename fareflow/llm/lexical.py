"""Ranked lexical search over bags of words, each distinct bag scored once.

A document's score for an item needs only the item's own words. So texts are cut down to the words
that any item has; what is left of a document, its counts of those words and its length factor m, is
its bag. Documents of one bag score alike for every item: a bag is scored once, and only then expanded
to its documents, smallest doc_id first. The corpus is read once; all further steps read the bags.

Items are dealt into blocks whose texts hold a bounded number of bytes. The words and the weights of
one block are sent to the tasks, so what is broadcast is bounded by BLOCK_BYTES (or by one item's
text, if that is longer) however many items there are; a corpus pass per block is the price.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.llm.common import emit, map_rows, struct, written

#: Bytes of a text by what they are in a term: ASCII letters in lower case, digits and all bytes of
#: other characters as they are, the rest of ASCII blank.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
#: A long text is cut into terms in pieces of about this many bytes.
PIECE_BYTES = 1024**2
COUNT = np.dtype([("term", "<i4"), ("tf", "<i4")])
EXACT = 2**53


@dataclass(frozen=True)
class Settings:
    k: int = 10
    #: Bytes of the items' texts in a block.
    block_bytes: int = 16 * 1024**2
    #: Cells of the table of scores that a task holds at a time.
    cells: int = 1_000_000


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of a bounded size (but for one longer term)."""
    data = text.encode("utf-8", "surrogatepass").translate(_FOLD) if text else b""
    at = 0
    while len(data) - at > PIECE_BYTES:
        end = data.find(b" ", at + PIECE_BYTES)
        if end < 0:
            break
        yield data[at:end].split(b" ")
        at = end + 1
    yield data[at:].split(b" ")


def item_rows(items: DataFrame) -> DataFrame:
    """item_id and text, one row per id: of several texts under one id the smallest counts."""
    return items.groupBy("item_id").agg(F.min("text").alias("text")).filter(F.col("text").isNotNull())


def blocks(items: DataFrame, settings: Settings) -> tuple[DataFrame, int]:
    """The items with their block, and how many blocks there are.

    Blocks are dealt by digest. Their number is doubled until each holds block_bytes or a single item.
    """
    size = F.octet_length("text").cast("long")
    total = items.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    n = max(1, -(-total // settings.block_bytes))
    while True:
        dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
        over = dealt.groupBy("block").agg(F.sum(size).alias("size"), F.count(F.lit(1)).alias("n"))
        if n == 1 or over.filter((F.col("size") > settings.block_bytes) & (F.col("n") > 1)).isEmpty():
            return dealt, n
        n *= 2


@dataclass
class Block:
    """The items of a block and the numbers of their words."""

    ids: list[int | None]
    #: Numbers of the words, in the order of their bytes.
    numbers: dict[bytes, int]
    #: For each word the items that have it: owners[starts[i]:starts[i + 1]].
    starts: np.ndarray
    owners: np.ndarray

    @classmethod
    def of(cls, items: list[tuple[int | None, str]]) -> Block:
        bags = [{t for part in terms(text) for t in part if t} for _, text in items]
        numbers = {t: i for i, t in enumerate(sorted(set().union(*bags)))}
        pairs = np.array([(numbers[t], i) for i, bag in enumerate(bags) for t in bag], np.int64).reshape(-1, 2)
        pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
        starts = np.searchsorted(pairs[:, 0], np.arange(len(numbers) + 1))
        return cls([i for i, _ in items], numbers, starts, pairs[:, 1].astype(np.int32))


def bags(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms of the text) and bag (the counts of the numbered terms, by number) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    def make():
        number = shared.value.get

        def bag(text: str | None) -> tuple[int, bytes]:
            n, found = 0, []
            for part in terms(text):
                n += len(part) - part.count(b"")
                found.append(np.fromiter((x for x in map(number, part) if x is not None), np.int32))
            term, tf = np.unique(np.concatenate(found), return_counts=True)
            out = np.empty(len(term), COUNT)
            out["term"], out["tf"] = term, tf
            return n, out.tobytes()

        def compute(batch: pa.RecordBatch):
            got = [bag(t) for t in batch.column("text").to_pylist()]
            return {"n": [n for n, _ in got], "bag": [b for _, b in got]}

        return compute

    return map_rows(docs.select("doc_id", "text"), make, "n long, bag binary", drop=("text",))


def weights(rows: DataFrame, n_terms: int, n_docs: int) -> np.ndarray:
    """floor(1000 ln((2N+2) / (2df+1))) of every numbered term, df counted over all rows of ``bag``."""
    found = struct(term=T.IntegerType(), n=T.LongType())

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            each = np.frombuffer(b"".join(batch.column("bag").to_pylist()), COUNT)
            df += np.bincount(each["term"], minlength=n_terms)
        held = np.flatnonzero(df)
        yield emit(found, {"term": held, "n": df[held]})

    df = rows.select("bag").mapInArrow(count, found).groupBy("term").agg(F.sum("n").alias("df"))
    ratio = F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double")
    weighed = df.select("term", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long").alias("w")).toArrow()
    out = np.zeros(n_terms, np.int64)
    out[weighed.column("term").to_numpy()] = weighed.column("w").to_numpy()
    return out


def classes(rows: DataFrame, n_docs: int, n_words: int, k: int) -> DataFrame:
    """m, bag, ids: every different bag with its length factor and the k smallest of its documents.

    Rows are dealt by a hash of bag and m; rows of one hash are one class only if both are equal. Each
    task keeps k documents of a class before the shuffle, so a class of a third of all rows is as small
    as any. Ids are structs that sort with the null id last.
    """
    m = F.expr(f"10 + (90 * CAST(n AS DECIMAL(18, 0)) * {n_docs}) div {n_words}").cast("long")
    keyed = rows.filter(F.length("bag") > 0).withColumn("m", m).withColumn("hash", F.xxhash64("bag", "m"))
    key = ["hash", "m", "bag"]
    order = Window.partitionBy(*key).orderBy(F.col("doc_id").asc_nulls_last())
    first = keyed.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
    member = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"))
    return first.groupBy(*key).agg(F.sort_array(F.collect_list(member)).alias("ids")).select("m", "bag", "ids")


class Best:
    """The k best classes of every item, of those seen so far."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.ones(n_items, np.int64)
        self.item, self.score = np.empty(0, np.int64), np.empty(0, np.int64)
        self.none, self.id = np.empty(0, bool), np.empty(0, np.int64)
        self.number = np.empty(0, np.int64)
        self.members: dict[int, list] = {}
        self.seen = 0

    def add(self, scores: np.ndarray, ids: list[list[dict]]) -> None:
        """scores: a row for each class, a column for each item; ids: the documents of each class."""
        row, item = np.nonzero(scores >= self.least)
        used = np.unique(row)
        none = np.array([x[0]["none"] for x in ids], bool)
        first = np.array([x[0]["id"] for x in ids], np.int64)
        self.members |= {self.seen + i: ids[i] for i in used.tolist()}
        self.item = np.concatenate([self.item, item])
        self.score = np.concatenate([self.score, scores[row, item]])
        self.none = np.concatenate([self.none, none[row]])
        self.id = np.concatenate([self.id, first[row]])
        self.number = np.concatenate([self.number, self.seen + row])
        self.seen += len(ids)
        self._cut()

    def _cut(self) -> None:
        order = np.lexsort((self.id, self.none, -self.score, self.item))
        item = self.item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        order = order[place < self.k]
        for name in ("item", "score", "none", "id", "number"):
            setattr(self, name, getattr(self, name)[order])
        kept = np.searchsorted(self.item, np.arange(len(self.least) + 1))
        full = np.flatnonzero(np.diff(kept) == self.k)
        self.least[full] = self.score[kept[full + 1] - 1]
        alive = set(self.number.tolist())
        self.members = {i: x for i, x in self.members.items() if i in alive}

    def rows(self) -> Iterator[tuple[int, int, dict]]:
        """item, score, document of the k best documents of each item."""
        for item in np.unique(self.item).tolist():
            here = np.flatnonzero(self.item == item).tolist()
            found = [(-self.score[i], d["none"], d["id"]) for i in here for d in self.members[int(self.number[i])]]
            for score, none, doc in sorted(found)[: self.k]:
                yield item, -int(score), None if none else doc


def score_classes(found: DataFrame, block: Block, w: np.ndarray, settings: Settings) -> DataFrame:
    """item_id, doc_id, score of each task's k best documents of every item."""
    spark = found.sparkSession
    shared = spark.sparkContext.broadcast((block.ids, block.starts, block.owners, w))
    scored = struct(item_id=T.LongType(), doc_id=T.LongType(), score=T.LongType())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_ids, starts, owners, weight = shared.value
        n_items, width = len(item_ids), np.diff(starts)
        best = Best(n_items, settings.k)
        step = max(1, settings.cells // max(n_items, 1))

        def scores(m: np.ndarray, each: list[bytes]) -> np.ndarray:
            """The scores of every class for every item, summed over their common terms."""
            counts = np.frombuffer(b"".join(each), COUNT)
            of = np.repeat(np.arange(len(each)), [len(x) // COUNT.itemsize for x in each])
            term, tf = counts["term"].astype(np.int64), counts["tf"].astype(np.int64)
            part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[of]))
            many = width[term]
            place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            cell = np.repeat(of * n_items, many) + owners[np.repeat(starts[term], many) + place]
            part = np.repeat(part, many)
            size = len(each) * n_items
            if part.sum(dtype=np.float64) < EXACT:
                return np.bincount(cell, part, size).astype(np.int64).reshape(len(each), n_items)
            out = np.zeros(size, np.int64)
            np.add.at(out, cell, part)
            return out.reshape(len(each), n_items)

        for batch in batches:
            m, each = batch.column("m").to_numpy(zero_copy_only=False), batch.column("bag").to_pylist()
            ids = batch.column("ids").to_pylist()
            for at in range(0, len(each), step):
                part = slice(at, at + step)
                best.add(scores(m[part], each[part]), ids[part])
        out = list(best.rows())
        yield emit(scored, {
            "item_id": [item_ids[i] for i, _, _ in out], "doc_id": [d for _, _, d in out], "score": [s for _, s, _ in out],
        })

    return found.mapInArrow(run, scored)


def search(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """item_id, rank (from 1), doc_id, score of the k best documents of every item; all above 0, if fewer.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns do not matter. A null or
    empty text has no terms. Every row of ``docs`` is a document, also a repeated one: each is counted
    and ranked. Rows of one item_id are one item. Equal scores are ranked by doc_id, a null one last.
    Without items or without documents there are no rows. Texts of any length are read whole.
    """
    spark = docs.sparkSession
    dealt, n_blocks = blocks(item_rows(items), settings)
    result = None
    for number in range(n_blocks):
        own = dealt.filter(F.col("block") == number).select("item_id", "text").collect()
        block = Block.of(sorted(((r[0], r[1]) for r in own), key=lambda x: (x[0] is None, x[0] or 0)))
        rows = written(bags(docs, block.numbers), "bags")
        n_docs, n_words = rows.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_words or not block.numbers:
            continue
        w = weights(rows, len(block.numbers), n_docs)
        found = written(classes(rows, n_docs, n_words, settings.k), "classes")
        best = score_classes(found, block, w, settings)
        result = best if result is None else result.unionAll(best)
    if result is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = result.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= settings.k)
    return ranked.select("item_id", "rank", "doc_id", "score")


"""Mixes sources to target weights by whole repetitions and one seeded coin per document."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import WORD, free_name, written


@dataclass(frozen=True)
class Settings:
    #: Weights of the sources by code point, null last, repeating.
    weights: tuple[int, ...] = (5, 2, 1)
    #: The targets' sum, in sizes of all documents, and the most of a source, in its sizes.
    share: float = 1.5
    most: int = 2
    seed: str = "mix-1"
    #: Targets are broadcast up to so many sources (about 100 bytes each), else joined by shuffle.
    broadcast_sources: int = 100_000


def size(text: str = "text") -> Column:
    """Words of a text; a null one has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def draw(seed: str) -> Column:
    """A number in [0, 1) that depends on the document and the seed alone.

    Rows without an id draw by their text.
    """
    parts = F.concat(
        F.lit(seed + "|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"),
        F.md5(F.coalesce(F.col("text"), F.lit(""))),
    )
    return F.conv(F.substring(F.md5(parts), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def _ranked(sources: DataFrame) -> DataFrame:
    """The sources with their rank from 0 in the order of their code points, null last.

    Sorted by ranges over all tasks; the driver sees one count per range.
    """
    order = F.col("source").asc_nulls_last()
    place = F.monotonically_increasing_id()
    placed = sources.repartitionByRange(order).sortWithinPartitions(order).withColumn("place", place)
    placed = written(placed, "sources")
    part, index = F.shiftright("place", 33), F.col("place").bitwiseAND(2**33 - 1)
    counts = sorted(placed.groupBy(part.alias("part")).count().collect())
    offsets, before = [], 0
    for row in counts:
        offsets.append((row["part"], before))
        before += row["count"]
    table = placed.sparkSession.createDataFrame(offsets or [(0, 0)], "part long, before long")
    ranked = placed.withColumn("part", part).join(F.broadcast(table), "part")
    return ranked.withColumn("rank", F.col("before") + index).drop("part", "before", "place")


def targets(sized: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, int]:
    """source, source_size and target of each source of rows (source, size), and how many there are.

    A target is its weight's part of the whole, at most ``most`` times its source; what is cut off goes
    to the other sources by weight. Each round cuts off the sources above their limit, over a table
    of sources; the driver holds sums.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    weights = F.array(*[F.lit(w) for w in settings.weights])
    weight = F.element_at(weights, (F.col("rank") % len(settings.weights) + 1).cast("int"))
    sources = written(_ranked(sources).withColumn("weight", weight).drop("rank"), "weights")
    limit = F.col("source_size") * settings.most
    total, n = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.count(F.lit(1))).first()
    level, cut_before = 0.0, -1
    while True:
        # Sources whose limit is below their part at this level are cut off and stay so.
        cut = limit < F.col("weight") * F.lit(level)
        held, rest, cut_now = sources.agg(
            F.coalesce(F.sum(F.when(cut, limit)), F.lit(0)),
            F.coalesce(F.sum(F.when(~cut, F.col("weight"))), F.lit(0)),
            F.count(F.when(cut, 1)),
        ).first()
        if cut_now == cut_before or not rest:
            break
        level, cut_before = (settings.share * total - held) / rest, cut_now
    target = F.least(limit.cast("double"), F.col("weight") * F.lit(level))
    return sources.select("source", "source_size", target.alias("target")), n


def _rated(rows: DataFrame, table: DataFrame, n: int, settings: Settings) -> tuple[DataFrame, dict[str, str]]:
    """The rows with their source's size and target and the number of copies, and the columns' names."""
    names = {c: free_name(rows.columns, f"mix_{c}") for c in ("source", "source_size", "target", "copies")}
    table = table.withColumnsRenamed({c: names[c] for c in table.columns})
    table = F.broadcast(table) if n <= settings.broadcast_sources else table
    rows = rows.join(table, rows["source"].eqNullSafe(table[names["source"]]))
    size, target = F.col(names["source_size"]), F.col(names["target"])
    rate = F.when(size > 0, target / size).otherwise(0.0)
    return rows.withColumn(names["copies"], rate), names


def _copies(rate: Column, chance: Column) -> Column:
    return F.floor(rate) + (chance < rate - F.floor(rate)).cast("long")


def mixed(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row.

    Texts that are null or empty have size 0 and take nothing; a source of such texts has target 0. Rows
    that are repeated share their draw.
    """
    columns = ["doc_id", "source", size().alias("size"), draw(settings.seed).alias("chance")]
    sized = written(docs.select(*columns), "sizes")
    rows, names = _rated(sized, *targets(sized.select("source", "size"), settings), settings)
    taken = F.col("size") * _copies(F.col(names["copies"]), F.col("chance"))
    return rows.select(
        "doc_id", "size", F.col(names["source_size"]).alias("source_size"),
        F.col(names["target"]).alias("target"), taken.alias("taken"),
    )


def mix(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with their columns as they are."""
    table, n = targets(docs.select("source", size().alias("size")), settings)
    rows, names = _rated(docs, table, n, settings)
    copies = _copies(F.col(names["copies"]), draw(settings.seed)).cast("int")
    each = F.explode(F.array_repeat(F.lit(True), copies))
    return rows.withColumn(names["copies"], each).select(*docs.columns)

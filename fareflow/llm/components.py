"""Connected components of a graph in tables, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of every node of ``edges`` (a, b long).

    Each round gives a node the smallest of itself and its neighbours and contracts the edges to
    those labels, until none is left: about log(n) rounds, one for a star. Minima are combined in
    each task before the shuffle; joins on a hub are left to adaptive splitting. Every round is a
    written table, so a lost executor costs one round at most.
    """
    edges = written(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    roots = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        labels = both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component"))
        labels = written(labels, "labels")
        if roots is None:
            roots = labels
        else:
            step = labels.select(F.col("node").alias("component"), F.col("component").alias("next"))
            joined = roots.join(step, "component", "left")
            roots = written(joined.select("node", F.coalesce("next", "component").alias("component")), "roots")
        of_a = labels.select(F.col("node").alias("a"), F.col("component").alias("x"))
        of_b = labels.select(F.col("node").alias("b"), F.col("component").alias("y"))
        contracted = edges.join(of_a, "a").join(of_b, "b").filter("x <> y")
        edges = contracted.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        edges = written(edges, "edges")
        if edges.isEmpty():
            return roots

"""Tables kept in buckets of a join key, and joins of two such tables that move no rows.

A bucket is one task's work, so a key that holds much of a table must not be in one. Rows of such hot
keys stand beside the buckets in a plain table. A join runs in three parts: buckets with buckets, in
place; the hot rows of the left with the right's rows of those keys; and the hot rows of the right with the left's.
In the last two the hot side stays where it is and the other is sent to all tasks if it is few rows, else
hot rows are salted, so that one key is the work of many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.sinks.tables import create_bucketed, replace_table

#: Rows that are sent to every task of a join at most.
FEW_ROWS = 100_000
SALT = "_salt"


@dataclass(frozen=True)
class Clustered:
    """A table in two: ``name`` has buckets of ``key``, ``hot`` the rows of the hot keys."""

    name: str
    hot: str
    key: str
    buckets: int
    hot_keys: tuple

    def is_hot(self) -> Column:
        """False for a null key."""
        return F.coalesce(F.col(self.key).isin(list(self.hot_keys)), F.lit(False)) if self.hot_keys else F.lit(False)

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name).unionByName(spark.table(self.hot))


def hot_keys(df: DataFrame, key: str, share: float) -> tuple:
    """The keys that hold more than ``share`` of the rows each: fewer than 1 / share of them. Null is none."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    found = counts.filter((F.col("n") > share * df.count()) & F.col(key).isNotNull()).select(key).collect()
    return tuple(sorted(row[0] for row in found))


def create_clustered(
    df: DataFrame,
    name: str,
    key: str,
    buckets: int,
    share: float | None = None,
    path: str | None = None,
    hot: str | None = None,
) -> Clustered:
    """Creates or replaces both tables, ``hot`` by default ``name`` with ``_hot`` behind it.

    A key is hot if it holds more than ``share`` of the rows, by default half a bucket's.
    """
    hot = hot or f"{name}_hot"
    found = Clustered(name, hot, key, buckets, hot_keys(df, key, share or 0.5 / buckets))
    create_bucketed(df.filter(~found.is_hot()), name, key, buckets, path)
    replace_table(df.filter(found.is_hot()), hot, f"{path}/_hot" if path else None)
    return found


def open_clustered(spark: SparkSession, name: str, key: str, buckets: int, hot: str | None = None) -> Clustered:
    """The tables of an earlier :func:`create_clustered`."""
    hot = hot or f"{name}_hot"
    keys = spark.table(hot).select(key).distinct().collect()
    return Clustered(name, hot, key, buckets, tuple(sorted(row[0] for row in keys)))


def join_clustered(spark: SparkSession, left: Clustered, right: Clustered, how: str = "inner") -> DataFrame:
    """Rows of both tables with equal keys, one key column; ``how`` is inner or left.

    Other columns must have different names. A null key joins nothing.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how: {how}")
    if (left.key, left.buckets) != (right.key, right.buckets):
        raise ValueError(f"buckets differ: {left}, {right}")
    key = left.key
    in_place = spark.table(left.name).filter(~right.is_hot()).join(spark.table(right.name).filter(~left.is_hot()), key, how)
    parts = [in_place]
    if left.hot_keys:
        parts.append(_hot(spark.table(left.hot), right.rows(spark).filter(left.is_hot()), key, how, left.buckets))
    if right.hot_keys:
        # Keys hot on both sides are in the part before.
        own = spark.table(right.hot).filter(~left.is_hot())
        others = spark.table(left.name).filter(right.is_hot())
        parts.append(_hot(own, others, key, "inner", left.buckets))
    return reduce(DataFrame.unionByName, parts)


def _hot(hot: DataFrame, others: DataFrame, key: str, how: str, salts: int) -> DataFrame:
    """The rows of a few keys with the other table's; ``how`` keeps rows of ``hot``."""
    if others.limit(FEW_ROWS + 1).count() <= FEW_ROWS:
        return hot.join(F.broadcast(others), key, how)
    salt = F.pmod(F.xxhash64(*hot.columns), F.lit(salts)).cast("int")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    joined = hot.withColumn(SALT, salt).join(others.withColumn(SALT, everywhere), [key, SALT], how)
    return joined.drop(SALT)

"""Kept sketches: the most frequent keys and the number of distinct ones, of any set of loads or months.

A sketch is a few hundred kilobytes for each load or month, written once. Sketches merge, so a
question about several of them does not read their rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.operators.reports import count_by

#: Keys that a sketch of frequent keys holds.
TRACKED = 10_000
STATE, ROWS, ITEM = "frequent", "sketched_rows", "_item"


def item(keys: Sequence[str]) -> Column:
    """One text for the values of some columns; different values have different texts."""
    return F.to_json(F.struct(*keys))


def frequent_states(df: DataFrame, keys: Sequence[str], by: Sequence[str | Column] = (), tracked: int = TRACKED) -> DataFrame:
    """A sketch of the most frequent values of ``keys`` for each group of ``by``, with the number of its rows."""
    rows = df.withColumn(ITEM, item(keys))
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias(ROWS), F.expr(f"approx_top_k_accumulate({ITEM}, {tracked})").alias(STATE)
    )


def unseen(rows: int, tracked: int = TRACKED) -> float:
    """The most rows that a key can have which merged sketches of ``rows`` rows do not name.

    A sketch has places for the next power of two above 4/3 of the keys tracked, and is off by at most
    3.5 rows for each of its places among ``rows``; it names the keys it is sure of, which leaves
    out those within twice that.
    """
    places = 1 << (-(-4 * tracked // 3) - 1).bit_length()
    return 2 * 3.5 / places * rows


def combined(states: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """One sketch of all rows; no row if there are no states.

    Grouped by a constant: without a group, a task that has no state fails.
    """
    state = F.expr(f"approx_top_k_combine({STATE}, {tracked})").alias(STATE)
    return states.groupBy(F.lit(0).alias("all")).agg(state).select(STATE)


def top_keys(
    states: DataFrame, df: DataFrame, keys: Sequence[str], n: int, name: str = "trips", tracked: int = TRACKED
) -> DataFrame:
    """The ``n`` most frequent values of ``keys`` in ``df``, exactly; ``states`` are its sketches.

    The sketches name the candidates, at most ``tracked``; only their rows are counted. Values that
    were not named have at most :func:`unseen` rows: if the last of the top has no more, all are counted.
    """
    spark, order = df.sparkSession, [F.desc(name), *keys]
    rows = states.agg(F.coalesce(F.sum(ROWS), F.lit(0))).first()[0]
    if not rows:
        return count_by(df, *keys, name=name).orderBy(*order).limit(n)
    named = combined(states, tracked).select(F.explode(F.expr(f"approx_top_k_estimate({STATE}, {tracked})")["item"]).alias(ITEM))
    # At most as many rows as a sketch tracks.
    likely = df.withColumn(ITEM, item(keys)).join(F.broadcast(named), ITEM, "left_semi")
    top = count_by(likely, *keys, name=name).orderBy(*order).limit(n).collect()
    if len(top) < n or top[-1][name] <= unseen(rows, tracked):
        return count_by(df, *keys, name=name).orderBy(*order).limit(n)
    return spark.createDataFrame(top, count_by(df.limit(0), *keys, name=name).schema)


#: The logarithm of the number of values up to which a sketch of distinct values is exact.
DISTINCT = 12
KEPT = "distinct_values"


def distinct_states(df: DataFrame, column: str, by: Sequence[str | Column], size: int = DISTINCT) -> DataFrame:
    """A sketch of the distinct values of a column for each group of ``by``; null is no value.

    Exact up to 2 ** ``size`` values, beyond that off by a few hundredths (one part in the root of that
    number as standard error).
    """
    return df.groupBy(*by).agg(F.theta_sketch_agg(column, size).alias(KEPT))


def distinct_in(states: DataFrame, by: Sequence[str | Column] = (), name: str = "distinct", size: int = DISTINCT) -> DataFrame:
    """Distinct values of all states of a group together."""
    return states.groupBy(*by).agg(F.theta_sketch_estimate(F.theta_union_agg(KEPT, size)).alias(name))


def distinct_changes(states: DataFrame, period: str, size: int = DISTINCT) -> DataFrame:
    """period, present, new (in no period before), back (also in one before), gone (in the one before only).

    One row for each period comes together in a task, with its sketch.
    """
    order = Window.orderBy(period)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = states.withColumns({
        "_before": F.theta_union_agg(KEPT, size).over(earlier), "_last": F.lag(KEPT).over(order),
    })
    count = F.theta_sketch_estimate
    return rows.select(
        period,
        count(KEPT).alias("present"),
        F.coalesce(count(F.theta_difference(KEPT, "_before")), count(KEPT)).alias("new"),
        F.coalesce(count(F.theta_intersection(KEPT, "_before")), F.lit(0)).alias("back"),
        F.coalesce(count(F.theta_difference("_last", KEPT)), F.lit(0)).alias("gone"),
    )

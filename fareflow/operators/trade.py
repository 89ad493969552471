"""Questions on foreign trade: who traded what, with whom, how it changed and where it is going.

Every input has the columns of a trade table; those that compare directions also have ``flow``
(``exports`` or ``imports``). Value (``fob``) and weight are whole numbers, so sums are exact.
Rankings run on grouped data, never on trade rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EXPORTS, IMPORTS = "exports", "imports"
MEASURES = ("fob", "net_weight")


def with_trade_date(trade: DataFrame) -> DataFrame:
    """Adds the first of the month as ``trade_date``, the column trade tables are partitioned by."""
    return trade.withColumn("trade_date", F.make_date("year", "month", F.lit(1)))


def traded_by(trade: DataFrame, *keys: str) -> DataFrame:
    """Value and weight by any columns."""
    return trade.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in MEASURES])


def by_place(trade: DataFrame) -> DataFrame:
    """Value and weight by home state, home city and partner country."""
    return traded_by(trade, "origin_state", "origin_city", "destination_country")


def year_span(trade: DataFrame) -> tuple[int, int]:
    """The first and last year with trade; reads the year alone. (0, 0) of a table without rows."""
    first, last = trade.agg(F.min("year"), F.max("year")).first()
    return (0, 0) if first is None else (first, last)


def full_years(trade: DataFrame) -> tuple[int, int]:
    """The first and the last year with trade in all twelve months; reads year and month. (0, 0) if there is none.

    The last year of a table is often cut off; to compare it with a whole one would show a fall everywhere.
    """
    months = trade.groupBy("year").agg(F.count_distinct("month").alias("months")).filter("months = 12")
    return year_span(months)


def yearly_changes(
    exports: DataFrame, place: Sequence[str], first_year: int, last_year: int
) -> DataFrame:
    """Value of each place and year against the calendar year before, from the second year on.

    A missing year counts as 0; a place and year without trade in either year has no line. Each
    yearly total is passed to its own year and to the next one, so neither a grid of all places
    and years nor an ordered window is needed.
    """
    yearly = (
        exports.filter(F.col("year").between(first_year, last_year))
        .groupBy(*place, "year")
        .agg(F.sum("fob").alias("fob"))
    )
    none = F.lit(0).cast("bigint")
    own = F.struct("year", F.col("fob").alias("current_fob"), none.alias("previous_fob"))
    next_ = F.struct(
        (F.col("year") + 1).alias("year"), none.alias("current_fob"), F.col("fob").alias("previous_fob")
    )
    return (
        yearly.select(*place, F.inline(F.array(own, next_)))
        .filter(F.col("year").between(first_year + 1, last_year))
        .groupBy(*place, "year")
        .agg(F.sum("previous_fob").alias("previous_fob"), F.sum("current_fob").alias("current_fob"))
        .withColumn("change_fob", F.col("current_fob") - F.col("previous_fob"))
    )


def biggest_changes(
    exports: DataFrame, place: Sequence[str], year: int, n: int = 5
) -> DataFrame:
    """The places whose value rose most and fell most against the calendar year before.

    A year without trade counts as 0. Only the two years are read, so a table partitioned by
    date is pruned to them; a place with no trade in either has no change to report. Each task
    passes on its first ``n`` places of either direction, so the ranking never gathers them all.
    """
    def value_of(y: int) -> Column:
        return F.sum(F.when(F.col("year") == y, F.col("fob")).otherwise(F.lit(0)))

    change = F.col("change_fob")
    per_place = (
        exports.filter(F.col("year").isin(year - 1, year))
        .groupBy(*place)
        .agg(value_of(year - 1).alias("previous_fob"), value_of(year).alias("current_fob"))
        .withColumn("change_fob", F.col("current_fob") - F.col("previous_fob"))
        .filter(change != 0)
        .withColumn("direction", F.when(change > 0, F.lit("increase")).otherwise(F.lit("decrease")))
    )
    order = Window.partitionBy("direction").orderBy(F.desc(F.abs(change)), *place)
    return per_place.withColumn("position", F.row_number().over(order)).filter(
        F.col("position") <= n
    )


def top_partners(trade: DataFrame, n: int = 3) -> DataFrame:
    """Partner countries of each year by value in both directions; equal values share a rank."""
    per_year = trade.groupBy("year", "destination_country").agg(F.sum("fob").alias("fob"))
    order = Window.partitionBy("year").orderBy(F.desc("fob"))
    return per_year.withColumn("position", F.rank().over(order)).filter(F.col("position") <= n)


def trade_balance(trade: DataFrame) -> DataFrame:
    """Exports, imports and their difference by year, and in total as period ``all``."""
    def value_of(flow: str) -> Column:
        return F.sum(F.when(F.col("flow") == flow, F.col("fob")).otherwise(F.lit(0))).alias(flow)

    per_year = trade.groupBy("year").agg(value_of(EXPORTS), value_of(IMPORTS))
    # Every year's line counts for its own period and for the total: one pass over the trade rows.
    periods = F.explode(F.array(F.col("year").cast("string"), F.lit("all")))
    return (
        per_year.select(periods.alias("period"), EXPORTS, IMPORTS)
        .groupBy("period")
        .agg(F.sum(EXPORTS).alias(EXPORTS), F.sum(IMPORTS).alias(IMPORTS))
        .withColumn("balance", F.col(EXPORTS) - F.col(IMPORTS))
    )


def partner_forecast(
    trade: DataFrame, first_year: int, last_year: int, n: int = 5
) -> DataFrame:
    """Countries by the value a least-squares line through their yearly totals gives next year.

    A year without trade counts as 0, as in the other questions. The line is solved from whole-number
    sums, so it does not depend on the order of rows; a span of one year keeps that year's value.
    """
    span = last_year - first_year + 1
    years = trade.filter(F.col("year").between(first_year, last_year))
    yearly = years.groupBy("destination_country", "year").agg(F.sum("fob").alias("fob"))
    # Whole numbers of up to 38 digits; these rows are one per country and year.
    x = (F.col("year") - F.lit(first_year)).cast("decimal(10,0)")
    y = F.col("fob").cast("decimal(20,0)")
    sums = yearly.groupBy("destination_country").agg(
        F.sum(y).cast("decimal(22,0)").alias("y"),
        F.sum(x * y).cast("decimal(24,0)").alias("xy"),
    )
    target = F.lit(last_year + 1 - first_year).cast("decimal(10,0)")
    # Sums over the years 0, 1, ..., span - 1 of the year and of its square.
    whole = lambda number: F.lit(number).cast("decimal(10,0)")
    of_x, of_xx = span * (span - 1) // 2, span * (span - 1) * (2 * span - 1) // 6
    base = span * of_xx - of_x * of_x
    rise = whole(span) * F.col("xy") - whole(of_x) * F.col("y")
    level = F.col("y") * whole(of_xx) - whole(of_x) * F.col("xy")
    value = F.col("y").cast("double")
    if base:
        value = (level + target * rise).cast("double") / F.lit(float(base))
    return (
        sums.select(
            "destination_country",
            F.lit(last_year + 1).alias("year"),
            F.round(value, 2).alias("forecast_fob"),
        )
        .orderBy(F.desc("forecast_fob"), "destination_country")
        .limit(n)
    )


def top_sections(trade: DataFrame, n: int = 5) -> DataFrame:
    """Product sections of each flow by value and by weight."""
    totals = traded_by(trade, "flow", "section_cd").unpivot(
        ["flow", "section_cd"], list(MEASURES), "measure", "total"
    )
    order = Window.partitionBy("flow", "measure").orderBy(F.desc("total"), "section_cd")
    return totals.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= n)


def section_share(trade: DataFrame) -> DataFrame:
    """Each section's share of its flow's value and weight.

    The window runs over the grouped rows: one per section and flow.
    """
    per_flow = Window.partitionBy("flow")
    return traded_by(trade, "flow", "section_cd").select(
        "flow",
        "section_cd",
        *[(F.col(m) / F.sum(m).over(per_flow)).alias(f"{m}_share") for m in MEASURES],
    )


def top_section_of(trade: DataFrame, *place: str) -> DataFrame:
    """The most traded section of each place and flow by value; a tie goes to the lower code.

    The minimum of (-value, code) finds it while grouping: no sort, and nothing of a hot place is
    gathered in one task.
    """
    per_section = trade.groupBy("flow", *place, "section_cd").agg(F.sum("fob").alias("fob"))
    best = F.min(F.struct((-F.col("fob")).alias("negative"), F.col("section_cd")))
    return (
        per_section.groupBy("flow", *place)
        .agg(best.alias("best"))
        .select("flow", *place, "best.section_cd", (-F.col("best.negative")).alias("fob"))
    )

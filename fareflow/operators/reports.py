"""Counts, maxima and top lists over trips. Every top list has a total order."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareflow.functions.moments import in_years, month_date
from fareflow.session import own_session


def row_count(df: DataFrame, name: str = "trips") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def count_by(df: DataFrame, *keys: str | Column, name: str = "trips") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_count(df: DataFrame, column: str, name: str, approximate: float | None = None) -> DataFrame:
    """Number of distinct values; exact unless a relative error is given."""
    if approximate is not None:
        return df.agg(F.approx_count_distinct(column, approximate).alias(name))
    return df.agg(F.count_distinct(column).alias(name))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def max_by_day(
    df: DataFrame, ts: str, value: str | Column, name: str, n: int | None = None
) -> DataFrame:
    """Largest value by day, largest first; the first ``n`` days if given."""
    value = F.col(value) if isinstance(value, str) else value
    ranked = (
        df.groupBy(F.to_date(ts).alias("pickup_date"))
        .agg(F.max(value).alias(name))
        .orderBy(F.desc(name), "pickup_date")
    )
    return ranked if n is None else ranked.limit(n)


def top_keys(df: DataFrame, key: str, n: int = 1, name: str = "trips") -> DataFrame:
    """The most frequent values of a column."""
    return count_by(df, key, name=name).orderBy(F.desc(name), key).limit(n)


def trips_per_month(df: DataFrame, ts: str, name: str = "trips") -> DataFrame:
    return count_by(df, month_date(ts).alias("month"), name=name).orderBy(F.desc(name), "month")


def service_share(trips: DataFrame, years: Sequence[int], ts: str = "pickup_datetime") -> DataFrame:
    """Trips by year and service with the share of the year's total.

    The window runs over the counts: one row per service in each year.
    """
    bounded = trips.filter(in_years(ts, min(years), max(years)))
    counts = count_by(bounded, F.year(ts).alias("year"), "service_type").filter(
        F.col("year").isin(list(years))
    )
    total = F.sum("trips").over(Window.partitionBy("year"))
    return counts.withColumn("share", F.col("trips") / total)


def rows_by_month(df: DataFrame, ts: str, months: Iterable[tuple[int, int]]) -> DataFrame:
    """Rows in each of the given months, and a ``total`` line over them.

    One pass: each month's count goes to its own line and to the total, which is there without rows too.
    """
    starts = [F.lit(f"{year:04d}-{month:02d}-01").cast("date") for year, month in months]
    one_of = F.lit(False)
    for start in starts:
        begin = start.cast("timestamp_ntz")
        end = F.add_months(start, 1).cast("timestamp_ntz")
        one_of = one_of | ((F.col(ts) >= begin) & (F.col(ts) < end))
    counts = count_by(
        df.filter(one_of), F.date_format(month_date(ts), "yyyy-MM").alias("period"), name="rows"
    )
    lines = counts.select(F.explode(F.array("period", F.lit("total"))).alias("period"), "rows")
    none = df.sparkSession.range(1).select(F.lit("total").alias("period"), F.lit(0).cast("long").alias("rows"))
    return lines.unionByName(none).groupBy("period").agg(F.sum("rows").alias("rows"))


def footer_report(spark: SparkSession, path: str, by: Sequence[str], extremes: Sequence[str]) -> DataFrame:
    """Rows, least and greatest value of some columns by partition column, from the footers of Parquet files.

    The scan itself answers, without reading a page: for whole numbers, doubles, booleans and dates, and
    without filters on other columns than those of the partitions. A column with NaN has no range in its
    footer and must not be asked for.
    """
    footers = own_session(spark, spark__sql__sources__useV1SourceList="", spark__sql__parquet__aggregatePushdown="true")
    asked = [f(c).alias(f"{name}_{c}") for c in extremes for name, f in (("min", F.min), ("max", F.max))]
    return footers.read.parquet(path).groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *asked)

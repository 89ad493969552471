"""Parquet and JDBC writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fareflow.session import remove_folder
from fareflow.sinks.manifest import LOAD, Change, Manifest, folder_name


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    files: int | None = None,
    compression: str | None = None,
    prefix: str | None = None,
) -> None:
    """Parquet files; by default an existing target is an error.

    ``files`` sets their number, ``prefix`` what their names start with.
    """
    rows = df.repartition(files) if files else df
    writer = rows.write.mode(mode)
    if prefix:
        writer = writer.option("mapreduce.output.basename", prefix)
    if compression:
        writer = writer.option("compression", compression)
    writer.parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """A grouped result as one file.

    The shuffle keeps the grouping parallel; only the finished report passes through one task.
    """
    write_parquet(df, path, mode="overwrite", files=1)


def spread_for(df: DataFrame, by: Sequence[str], sort_by: Sequence[str] = ()) -> DataFrame:
    """Rows brought together by partition value before a partitioned write.

    ``rebalance`` gives few files per value, and adaptive execution splits a value that holds
    more than its share and merges small ones. ``sort_by`` orders rows inside each task, so that
    a filter on those columns skips row groups by their minimum and maximum.
    """
    rows = df.hint("rebalance", *by)
    return rows.sortWithinPartitions(*by, *sort_by) if sort_by else rows


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], sort_by: Sequence[str] = ()) -> None:
    """One folder per value of ``by``, in a single job. What the path held before is replaced."""
    spread_for(df, by, sort_by).write.mode("overwrite").partitionBy(*by).parquet(path)


def write_load(df: DataFrame, path: str, by: Sequence[str], load: str, sort_by: Sequence[str] = ()) -> Change:
    """The rows of one load, in a folder per value of ``by`` and below it one of the load.

    A load replaces what it wrote itself, and nothing else: rows that fall on another load's dates
    stand beside that load's, and running a load again, corrected or not, leaves each of its
    rows once. The write replaces folders when it commits; a load cut short left the path as it was,
    but for folders that a corrected load no longer has, which go after the commit.

    The folders written are noted by the tasks that write them, and those of the last time are in the
    load's :class:`Manifest`: the input is read once, and the price does not grow with the table. One
    run of a load at a time.
    """
    spark = df.sparkSession
    manifest = Manifest(spark, path, load)
    before = manifest.begin(len(by))
    noted = Observation()
    values = F.struct(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(by)])
    # Observed where rows of a folder are together already, so that a task notes few of them.
    rows = spread_for(df, by, sort_by).observe(noted, F.collect_set(values).alias("folders"))
    (
        rows.withColumn(LOAD, F.lit(load))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by, LOAD)
        .parquet(path)
    )
    after = frozenset(folder_name({**dict(zip(by, row)), LOAD: load}) for row in noted.get["folders"])
    change = Change(before, after)
    for folder in change.removed:
        remove_folder(spark, f"{path}/{folder}")
    manifest.end(after)
    return change


def write_jdbc(
    df: DataFrame, url: str, table: str, replace: bool = False, batch_rows: int = 100_000, **options
) -> None:
    """A database table over JDBC: created anew or appended to, in batches from every task."""
    (
        df.write.format("jdbc")
        .mode("overwrite" if replace else "append")
        .options(url=url, dbtable=table, batchsize=batch_rows, **options)
        .save()
    )

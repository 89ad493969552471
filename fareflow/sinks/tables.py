"""Catalog tables: plain, partitioned by date, partitioned and ordered by a key.

Parquet tables have no hidden partitioning: a filter on the timestamp does not choose folders.
:func:`between_dates` therefore filters the partition column and the timestamp together. Month
folders are the default; day folders pay off only when a day holds many megabytes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.functions.moments import days_between, month_date
from fareflow.sinks.files import spread_for, write_load
from fareflow.sinks.manifest import EMPTY, LOAD


_BUCKET = "_bucket"
#: Partitions that one statement adds or drops.
PARTITIONS_A_STATEMENT = 500


@dataclass(frozen=True)
class DateLayout:
    """Partitioning by the day or month of a timestamp."""

    ts: str
    grain: str = "month"

    @property
    def column(self) -> str:
        return f"{self.ts}_{self.grain}"

    def of(self, value: Column | str) -> Column:
        return {"day": F.to_date, "month": month_date}[self.grain](value)


def _writer(df: DataFrame, path: str | None, mode: str):
    writer = df.write.format("parquet").mode(mode)
    return writer.option("path", path) if path else writer


def replace_table(df: DataFrame, name: str, path: str | None = None, **options) -> DataFrame:
    """Creates or replaces a table with these rows; ``path`` keeps its files outside the warehouse."""
    _writer(df, path, "overwrite").options(**options).saveAsTable(name)
    return df.sparkSession.table(name)


def append_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Adds rows to a table. Running the same load twice adds them twice; see :func:`load_table`."""
    _writer(df, path, "append").saveAsTable(name)
    return df.sparkSession.table(name)


def create_by_date(
    df: DataFrame,
    name: str,
    layout: DateLayout,
    cluster_by: Sequence[str] = (),
    path: str | None = None,
    **options,
) -> DataFrame:
    """Creates or replaces a table partitioned by date, its rows ordered by ``cluster_by``.

    A filter on the leading ``cluster_by`` column skips the row groups and pages whose range it
    misses. ``options`` go to the Parquet writer.
    """
    dated = df.withColumn(layout.column, layout.of(layout.ts))
    spread = spread_for(dated, [layout.column], cluster_by)
    writer = _writer(spread, path, "overwrite").options(**options)
    writer.partitionBy(layout.column).saveAsTable(name)
    return df.sparkSession.table(name)


def bloom_options(distinct: Mapping[str, int], wrong: float = 0.01) -> dict[str, str]:
    """Writer options for Bloom filters on columns that a table is not ordered by; column -> values in a row group.

    A lookup then skips the row groups that do not hold the value, where their range cannot say so.
    A row group that holds few enough values for a dictionary is skipped by that and gets no filter. A filter takes
    about 1.2 bytes a value at one wrong answer in a hundred.
    """
    options = {}
    for column, values in distinct.items():
        options[f"parquet.bloom.filter.enabled#{column}"] = "true"
        options[f"parquet.bloom.filter.expected.ndv#{column}"] = str(values)
        options[f"parquet.bloom.filter.fpp#{column}"] = str(wrong)
    return options


def create_load_table(df: DataFrame, name: str, by: Sequence[str], path: str) -> DataFrame:
    """An empty table with the columns of ``df``, partitioned by ``by`` and by load."""
    empty = df.limit(0).withColumn(LOAD, F.lit("").cast("string"))
    _writer(empty, path, "errorifexists").partitionBy(*by, LOAD).saveAsTable(name)
    return df.sparkSession.table(name)


def load_table(df: DataFrame, name: str, by: Sequence[str], load: str) -> DataFrame:
    """Loads rows into a table of :func:`create_load_table`, replacing what the same load wrote before.

    Rows of other loads stay, on whatever dates they fall; see :func:`write_load`. Columns go by name.
    The catalog learns of the folders that came and went, and of nothing else.
    """
    spark = df.sparkSession
    described = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first()
    rows = df.select(*[c for c in spark.table(name).columns if c != LOAD])
    change = write_load(rows, described["data_type"], by, load)
    for verb, folders in (("ADD IF NOT EXISTS", change.added), ("DROP IF EXISTS", change.removed)):
        joint = " " if verb.startswith("ADD") else ", "
        for at in range(0, len(folders), PARTITIONS_A_STATEMENT):
            some = joint.join(partition_clause(x) for x in folders[at : at + PARTITIONS_A_STATEMENT])
            spark.sql(f"ALTER TABLE {name} {verb} {some}")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def partition_clause(folder: str) -> str:
    """A partition folder (``year=2019/load=a``) as SQL names the partition."""
    parts = (unquote(part).partition("=") for part in folder.split("/"))
    values = ((column, "NULL" if value == EMPTY else _literal(value)) for column, _, value in parts)
    return f"PARTITION ({', '.join(f'`{column}` = {value}' for column, value in values)})"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_partitioned(
    df: DataFrame, name: str, by: Sequence[str], path: str | None = None
) -> DataFrame:
    """Creates or replaces a table partitioned by columns it already has."""
    _writer(spread_for(df, by), path, "overwrite").partitionBy(*by).saveAsTable(name)
    return df.sparkSession.table(name)


def create_bucketed(
    df: DataFrame, name: str, key: str, buckets: int, path: str | None = None
) -> DataFrame:
    """Creates or replaces a table hashed and sorted by a join key: joins on it need no shuffle.

    A writing task makes a file for each bucket it meets, so rows are brought together by bucket; a
    bucket that holds more than its share, as one with a hot key does, is split between tasks and has
    several files. Readers of a hot bucket still read it in one task; leave joins on a key that holds
    much of the table to adaptive execution.
    """
    bucket = F.pmod(F.hash(key), F.lit(buckets))
    rows = df.withColumn(_BUCKET, bucket).hint("rebalance", _BUCKET).drop(_BUCKET)
    _writer(rows, path, "overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def between_dates(table: DataFrame, layout: DateLayout, first: str, last: str) -> DataFrame:
    """Rows of whole days from a table partitioned by ``layout``, reading only its folders."""
    low, high = (layout.of(F.lit(day).cast("date")) for day in (first, last))
    return table.filter(F.col(layout.column).between(low, high)).filter(
        days_between(layout.ts, first, last)
    )


def partition_row_counts(table: DataFrame, column: str, name: str = "total_rows") -> DataFrame:
    """Rows in each partition, most first. No data column is read, only file footers."""
    return (
        table.groupBy(F.col(column).alias("partition_id"))
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.desc(name), "partition_id")
    )


def describe_columns(df: DataFrame) -> DataFrame:
    """The columns of a table by position: name and type as they stand in its DDL."""
    rows = [
        (i, field.name, field.dataType.simpleString()) for i, field in enumerate(df.schema, start=1)
    ]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")


def table_ddl(df: DataFrame, name: str) -> str:
    """A CREATE TABLE statement for the table's columns."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return f"CREATE TABLE {name} ({columns}) USING parquet"

"""CSV and Parquet readers. A path may be local or on any store Spark has a connector for."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.operators.cleaning import conform
from fareflow.schemas import FeedSpec
from fareflow.sources import census


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = None,
    parallelism: int | None = None,
) -> DataFrame:
    """CSV with a header; without a schema every column is a string.

    A schema's columns are found by their names in the header, wherever they stand; other columns
    are left out, a missing one is an error, and so is a file whose header differs from the first's.

    A gzip file is one task however large it is. ``parallelism`` spreads its rows over that many
    partitions, for work that is heavier than the decompression.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        rows = reader.csv(paths)
    else:
        header = reader.csv(paths).columns
        if missing := [name for name in schema.fieldNames() if name not in header]:
            raise ValueError(f"{paths} has no column {', '.join(missing)}: {header}")
        types = {field.name: field for field in schema}
        by_name = T.StructType([types.get(name, T.StructField(name, T.StringType())) for name in header])
        # Unlike the default, a header that does not agree is an error.
        rows = reader.option("enforceSchema", False).schema(by_name).csv(paths).select(*schema.fieldNames())
    return rows.repartition(parallelism) if parallelism else rows


def infer_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """CSV with types found by reading all of it."""
    return spark.read.option("header", True).option("inferSchema", True).csv(paths)


def read_parquet(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None
) -> DataFrame:
    """Parquet from files, folders or globs (``root/*/*``); footer schema, or an imposed one.

    An imposed schema also covers folders whose files differ by a lossless widening (int to long
    or double, float to double). For other differences see :func:`read_conformed`.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


def read_feed(spark: SparkSession, paths: str | Sequence[str], feed: FeedSpec) -> DataFrame:
    """A trip feed's files of any months under the feed's schema.

    Months differ in the types of some columns (a count may be a whole number in one and a double in
    the next). Tasks read the footers (:mod:`~fareflow.sources.census`); files whose types a scan can widen
    to common ones are one scan, whatever their number, others are read apart and all are cast and
    united. A value that does not fit its type is an error.
    """
    found = census.footers(spark, paths).cache()
    try:
        together = census.scans(census.census(spark, found))
        if len(together) == 1:
            groups = [[paths] if isinstance(paths, str) else list(paths)]
        else:
            groups = census.places(found, [[kind.digest for kind in kinds] for _, kinds in together])
    finally:
        found.unpersist()
    rows = spark.createDataFrame([], feed.schema)
    for (schema, _), group in zip(together, groups):
        rows = rows.unionAll(_under(read_parquet(spark, group, schema), feed.schema))
    return rows


def schema_groups(spark: SparkSession, paths: str | Sequence[str]) -> list[list[str]]:
    """The Parquet files behind some paths, in groups of equal schema: folders where all files agree."""
    found = census.footers(spark, paths).cache()
    try:
        return census.places(found, [[kind.digest] for kind in census.census(spark, found)])
    finally:
        found.unpersist()


def unite_groups(spark: SparkSession, groups: Iterable[Sequence[str]], schema: T.StructType) -> DataFrame:
    """Groups of files of one schema each, cast to ``schema``; a column a group lacks is null."""
    rows = spark.createDataFrame([], schema)
    for group in groups:
        rows = rows.unionAll(_under(spark.read.parquet(*group), schema))
    return rows


def _under(found: DataFrame, schema: T.StructType) -> DataFrame:
    lacking = [field for field in schema if field.name.lower() not in map(str.lower, found.columns)]
    found = found.withColumns({field.name: F.lit(None).cast(field.dataType) for field in lacking})
    return conform(found, schema, strict=True)


def read_conformed(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, strict: bool = True
) -> DataFrame:
    """Parquet with its own footer schema, cast column by column to ``schema``."""
    return conform(read_parquet(spark, paths), schema, strict=strict)


def read_dataset(spark: SparkSession, folder: str, dataset: str) -> DataFrame:
    """One dataset out of a folder that holds several, told apart by file name."""
    return spark.read.option("pathGlobFilter", f"{dataset}_tripdata*.parquet").parquet(folder)


def external_table(
    spark: SparkSession, name: str, paths: Iterable[str], root: str | None = None
) -> DataFrame:
    """A named view over one or more path prefixes; the files stay where they are.

    Where the prefixes are partition folders (``key=value``), ``root`` is the table they belong to.
    """
    reader = spark.read.option("basePath", root) if root else spark.read
    rows = reader.parquet(*paths)
    rows.createOrReplaceTempView(name)
    return spark.table(name)


def catalog_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """An external table in the catalog over one folder, with its partitions if it has any.

    Dropping the table leaves the files.
    """
    spark.catalog.createTable(name, path=path, source="parquet")
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def month_paths(root: str, years: Iterable[int], months: Iterable[int]) -> list[str]:
    """The folders of a ``year=/month=`` layout for the given years and months."""
    months = list(months)
    return [f"{root}/year={year}/month={month}" for year in years for month in months]

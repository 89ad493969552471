"""Schemas of many files: found by tasks, a row per schema on the driver, read in as few scans as can be."""

import pytest
from pyspark.sql import functions as F

from fareflow.schemas import FeedSpec, fields
from fareflow.sources import census
from fareflow.sources import files as sources
from tests.conftest import plan, rows

FEED = FeedSpec("x", "t", "t", fields(passenger_count="double", VendorID="long", fee="double"))


def month(spark, folder, count, vendor, n=4, files=2, fee=True):
    df = spark.range(0, n, 1, files).selectExpr(f"CAST(id AS {count}) AS passenger_count", f"CAST(7 AS {vendor}) AS VendorID")
    df = df.withColumn("fee", F.lit(1.5)) if fee else df
    df.write.mode("append").parquet(folder)


def test_a_thousand_files_are_a_row_for_each_schema(spark, folder):
    month(spark, f"{folder}/a", "int", "int", 700, 700)
    month(spark, f"{folder}/b", "double", "bigint", 300, 300)
    found = census.footers(spark, f"{folder}/*")
    assert found.rdd.getNumPartitions() > 1
    kinds = census.census(spark, found)
    assert [k.files for k in kinds] == [700, 300]
    assert [k.schema["VendorID"].dataType.simpleString() for k in kinds] == ["int", "bigint"]
    assert found.count() == 1000 and sources.read_feed(spark, f"{folder}/*", FEED).count() == 1000


def test_types_that_widen_are_one_scan(spark, folder):
    month(spark, f"{folder}/1", "int", "int")
    month(spark, f"{folder}/2", "double", "bigint", fee=False)
    month(spark, f"{folder}/3", "smallint", "int")
    read = sources.read_feed(spark, f"{folder}/*", FEED)
    assert plan(read).count("FileScan parquet") == 1
    assert rows(read) == sorted([(float(i), 7, fee) for i in range(4) for fee in (1.5, None, 1.5)], key=str)


def test_types_that_do_not_are_read_apart(spark, folder):
    """Long and double; folders that hold both are read file by file."""
    month(spark, f"{folder}/1", "bigint", "int")
    month(spark, f"{folder}/2", "double", "int")
    month(spark, f"{folder}/mixed", "bigint", "int")
    month(spark, f"{folder}/mixed", "double", "bigint")
    month(spark, f"{folder}/3", "int", "int")
    found = census.footers(spark, folder)
    together = census.scans(census.census(spark, found))
    assert len(together) == 2
    groups = census.places(found, [[k.digest for k in kinds] for _, kinds in together])
    named = [x.rsplit("/", 1)[-1] for group in groups for x in group]
    assert sorted(x for x in named if not x.endswith("parquet")) == ["1", "2", "3"] and len(named) == 3 + 4
    read = sources.read_feed(spark, f"{folder}/*", FEED)
    assert plan(read).count("FileScan parquet") == 2
    assert rows(read) == sorted([(float(i), 7, 1.5) for i in range(4) for _ in range(5)], key=str)


def test_files_beside_folders_are_read_once(spark, folder):
    month(spark, folder, "bigint", "int")
    month(spark, f"{folder}/sub", "double", "int")
    month(spark, f"{folder}/sub/deep er=1", "bigint", "int")
    found = census.footers(spark, folder)
    assert found.count() == 6
    groups = sources.schema_groups(spark, folder)
    assert sum(spark.read.option("recursiveFileLookup", True).parquet(x).count() for g in groups for x in g) == 12


def test_a_store_only_spark_opens_is_left_to_the_driver(spark, folder):
    month(spark, f"{folder}/1", "int", "int", files=1)
    month(spark, f"{folder}/2", "double", "int", files=1)
    by_driver = census._by_driver(spark, [r.path for r in census.listed(spark, folder).collect()])
    assert len(census.census(spark, by_driver)) == 2


@pytest.mark.parametrize(
    ("a", "b", "both"),
    [("int", "bigint", "bigint"), ("float", "int", "double"), ("bigint", "double", None), ("string", "int", None),
     ("smallint", "tinyint", "smallint"), ("date", "date", "date"), ("float", "bigint", None)],
)
def test_wider_types(a, b, both):
    assert census.wider(a, b) == census.wider(b, a) == both


def test_no_files(spark, folder):
    month(spark, folder, "int", "int")
    empty = census.footers(spark, folder).limit(0)
    assert census.census(spark, empty) == [] and census.scans([]) == []

"""Writers and table layouts: what they refuse, what a re-run changes, what a reader skips."""

import glob
import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from fareflow.schemas import FeedSpec, fields
from fareflow.session import new_folder, new_table
from fareflow.sinks import files, tables
from fareflow.sources import files as sources
from tests.conftest import plan, rows, setting

MONTHLY = tables.DateLayout("pickup_datetime", "month")
DAILY = tables.DateLayout("pickup_datetime", "day")


def trips(spark, n=3000, months=6):
    draw = random.Random(2)
    start = datetime(2019, 1, 1)
    data = [(i % 7, start + timedelta(minutes=draw.randrange(months * 43000)), float(i)) for i in range(n)]
    return spark.createDataFrame(data, "VendorID int, pickup_datetime timestamp_ntz, fare double")


def test_an_existing_target_is_an_error_by_default(spark, folder):
    files.write_parquet(spark.range(3), folder)
    with pytest.raises(AnalysisException):
        files.write_parquet(spark.range(3), folder)
    files.write_parquet(spark.range(5), folder, mode="overwrite")
    assert spark.read.parquet(folder).count() == 5


@pytest.mark.parametrize("n", [4, 12])
def test_number_of_files(spark, folder, n):
    files.write_parquet(trips(spark), folder, files=n)
    assert len(glob.glob(f"{folder}/*.parquet")) == n


def test_report_is_one_file(spark, folder):
    files.write_report(trips(spark).groupBy("VendorID").count(), folder)
    assert len(glob.glob(f"{folder}/*.parquet")) == 1


def test_gzip_files(spark, folder):
    files.write_parquet(spark.range(10), folder, compression="gzip")
    assert glob.glob(f"{folder}/*.gz.parquet")


def test_a_load_replaces_what_it_wrote_and_nothing_else(spark, folder):
    """The February file holds a ride of 31 January: January stays whole, and re-runs change nothing."""
    rows_ = trips(spark).withColumn("month", F.month("pickup_datetime"))
    january, february = rows_.filter("month = 1"), rows_.filter("month = 2")
    stray = january.limit(1)
    files.write_load(january, folder, ["month"], "2019-01")
    for _ in range(2):
        files.write_load(february.unionAll(stray), folder, ["month"], "2019-02 v/1")
        out = spark.read.parquet(folder)
        assert out.filter("month = 1").count() == january.count() + 1
        assert out.count() == january.count() + february.count() + 1
    # A corrected load without the stray ride takes its folder away.
    files.write_load(february.limit(5), folder, ["month"], "2019-02 v/1")
    out = spark.read.parquet(folder)
    assert rows(out.groupBy("month").count()) == [(1, january.count()), (2, 5)]
    files.write_load(rows_.limit(3).withColumn("month", F.lit(None).cast("int")), folder, ["month"], "2019-01")
    assert spark.read.parquet(folder).count() == 8
    files.write_partitioned(rows_.filter("month = 3"), folder, ["month"])
    assert spark.read.parquet(folder).select("month").distinct().count() == 1


def test_append_adds_and_load_replaces(spark):
    df, path = trips(spark), new_folder(spark, "t")
    name = new_table("append")
    tables.replace_table(df, name)
    assert tables.append_table(df, name).count() == 2 * df.count()
    assert tables.replace_table(df, name).count() == df.count()

    dated = new_table("load")
    df = df.withColumn(MONTHLY.column, MONTHLY.of("pickup_datetime"))
    tables.create_load_table(df, dated, [MONTHLY.column], path)
    for _ in range(2):
        loaded = tables.load_table(df, dated, [MONTHLY.column], "all")
    assert loaded.count() == df.count()
    february = df.filter(F.month("pickup_datetime") == 2)
    # Columns go by name, whatever their order.
    again = february.select(*reversed(february.columns))
    assert tables.load_table(again, dated, [MONTHLY.column], "more").count() == df.count() + february.count()
    assert tables.load_table(february, dated, [MONTHLY.column], "all").count() == 2 * february.count()
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


@pytest.mark.parametrize("layout", [MONTHLY, DAILY], ids=["month", "day"])
def test_date_filter_chooses_folders(spark, layout):
    df = trips(spark)
    table = tables.create_by_date(df, new_table("dated"), layout, ["VendorID"])
    chosen = tables.between_dates(table, layout, "2019-02-10", "2019-03-05")
    want = df.filter(F.to_date("pickup_datetime").between("2019-02-10", "2019-03-05"))
    assert chosen.count() == want.count() > 0
    text = plan(chosen)
    folders = text[text.index("PartitionFilters"):text.index("PushedFilters")]
    assert layout.column in folders and ">=" in folders
    assert "pickup_datetime" in text[text.index("PushedFilters"):]


def test_rows_are_ordered_by_key_within_a_file(spark):
    path = new_folder(spark, "ordered")
    tables.create_by_date(trips(spark), new_table("ordered"), MONTHLY, ["VendorID"], path)
    for file in glob.glob(f"{path}/*/*.parquet"):
        vendors = [r.VendorID for r in spark.read.parquet(file).collect()]
        assert vendors == sorted(vendors)


@pytest.mark.parametrize("sort_by", [(), ("VendorID",)])
def test_a_hot_date_is_split_between_tasks(spark, folder, sort_by):
    hot = spark.range(400_000, numPartitions=8).select(
        (F.col("id") % 7).alias("VendorID"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id") % 30).alias("day"),
    )
    with setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m"):
        files.write_partitioned(hot, folder, ["day"], sort_by)
    assert len(glob.glob(f"{folder}/day=1/*.parquet")) > 3
    assert len(glob.glob(f"{folder}/day=7/*.parquet")) <= 2
    assert spark.read.parquet(folder).count() == 400_000


def rows_scanned(df):
    """Rows of the row groups that the scan did not skip."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()


def test_bloom_filters_skip_row_groups_off_the_sort_order(spark):
    """Numbers in no order: the range of each row group spans all, only a Bloom filter can tell."""
    small = {"parquet.block.size": 65536, "parquet.page.size": 4096, "parquet.enable.dictionary": "false", "parquet.block.size.row.check.min": 100}
    df = spark.range(0, 60_000, 1, 1).select(
        (F.col("id") % 5).alias("VendorID"), (2 * F.pmod(F.xxhash64("id"), F.lit(2**40))).alias("trip"),
        F.lit(datetime(2019, 1, 5)).cast("timestamp_ntz").alias("pickup_datetime"),
    )
    some = df.first()["trip"]
    scanned = {}
    with setting(spark, "spark.sql.adaptive.enabled", "false"):
        for label, more in (("plain", {}), ("bloom", tables.bloom_options({"trip": 20_000}))):
            table = tables.create_by_date(df, new_table(label), MONTHLY, ["VendorID"], **small, **more)
            for key, n in ((some, 1), (some + 1, 0)):
                found = table.filter(F.col("trip") == key).select("trip", "VendorID")
                assert found.count() == n
                scanned[label, n] = rows_scanned(found)
    assert min(scanned["plain", 0], scanned["plain", 1]) > 59_000  # but for a page or two
    # A filter may be wrong about a row group or two.
    assert scanned["bloom", 0] < 15_000 and 0 < scanned["bloom", 1] < 23_000


def test_partition_row_counts_read_no_column(spark):
    df = trips(spark)
    table = tables.create_by_date(df, new_table("counted"), MONTHLY)
    counted = tables.partition_row_counts(table, MONTHLY.column)
    assert sum(r.total_rows for r in counted.collect()) == df.count()
    assert "ReadSchema: struct<>" in plan(counted)


def test_bucketed_tables_join_without_a_shuffle(spark):
    left = tables.create_bucketed(trips(spark), new_table("l"), "VendorID", 4)
    vendors = spark.range(7).select(F.col("id").cast("int").alias("VendorID"))
    right = tables.create_bucketed(vendors, new_table("r"), "VendorID", 4)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        joined = left.join(right, "VendorID")
        assert "Exchange" not in plan(joined)
        assert joined.count() == 3000


def test_a_hot_bucket_is_written_by_several_tasks(spark, folder):
    hot = spark.range(300_000, numPartitions=8).select(
        F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id")).alias("key"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    with setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m"):
        table = tables.create_bucketed(hot, new_table("hot"), "key", 4, folder)
    assert table.count() == 300_000
    assert len(glob.glob(f"{folder}/*.parquet")) > 6


def test_ddl(spark):
    df = trips(spark)
    assert tables.table_ddl(df, "t") == (
        "CREATE TABLE t (`VendorID` int, `pickup_datetime` timestamp_ntz, `fare` double) USING parquet"
    )
    assert rows(tables.describe_columns(df)) == [
        (1, "VendorID", "int"), (2, "pickup_datetime", "timestamp_ntz"), (3, "fare", "double"),
    ]


def test_csv_without_schema_is_text_and_gzip_is_spread(spark, folder):
    trips(spark).write.option("header", True).option("compression", "gzip").csv(folder)
    text = sources.read_csv(spark, folder)
    assert {kind for _, kind in text.dtypes} == {"string"}
    typed = fields(
    VendorID="integer", pickup_datetime="timestamp_ntz", fare="double",
)
    spread = sources.read_csv(spark, folder, typed, parallelism=6)
    assert spread.rdd.getNumPartitions() == 6
    assert spread.count() == 3000 and spread.dtypes[1] == ("pickup_datetime", "timestamp_ntz")


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Zone,LocationID,note,Borough\nAstoria,7,x,Queens\n")
    zones = fields(LocationID="long", Borough="string", Zone="string")
    assert rows(sources.read_csv(spark, str(tmp_path), zones)) == [(7, "Queens", "Astoria")]
    assert sources.read_csv(spark, str(tmp_path), zones).select("Zone").first()[0] == "Astoria"
    with pytest.raises(ValueError, match="Fare"):
        sources.read_csv(spark, str(tmp_path), fields(LocationID="long", Fare="double"))
    (tmp_path / "b.csv").write_text("LocationID,Zone,note,Borough\n8,Harlem,x,Manhattan\n")
    with pytest.raises(Exception, match="header"):
        sources.read_csv(spark, str(tmp_path), zones).collect()


def test_feed_of_months_with_different_types(spark, folder):
    """Whole numbers of either width, a missing column, and doubles, under one schema."""
    feed = FeedSpec("x", "t", "t", fields(passenger_count="double", VendorID="long", fee="double"))
    data = [("int", "int"), ("bigint", "bigint"), ("double", "int"), ("double", "int")]
    for i, (count, vendor) in enumerate(data):
        df = spark.range(2).selectExpr(f"CAST(id AS {count}) AS passenger_count", f"CAST({i} AS {vendor}) AS VendorID")
        (df.withColumn("fee", F.lit(1.5)) if i else df).write.parquet(f"{folder}/{i}")
    read = sources.read_feed(spark, f"{folder}/*", feed)
    assert read.dtypes == [("passenger_count", "double"), ("VendorID", "bigint"), ("fee", "double")]
    assert rows(read) == sorted([(float(j), i, 1.5 if i else None) for i in range(4) for j in range(2)], key=str)
    assert len(sources.schema_groups(spark, f"{folder}/*")) == 3


def test_imposed_schema_covers_files_that_differ_by_a_widening(spark, folder):
    spark.createDataFrame([(1, 2)], "PULocationID int, passenger_count int").write.parquet(f"{folder}/2019/01")
    spark.createDataFrame([(3, 4.0)], "PULocationID bigint, passenger_count double").write.parquet(f"{folder}/2019/02")
    df = sources.read_parquet(spark, f"{folder}/*/*", fields(PULocationID="long", passenger_count="double"))
    assert rows(df) == [(1, 2.0), (3, 4.0)]


def test_external_table_over_prefixes(spark, folder):
    for year in (2019, 2020, 2021):
        spark.range(year).write.parquet(f"{folder}/{year}")
    table = sources.external_table(spark, "ext_years", [f"{folder}/2019", f"{folder}/2020"])
    assert table.count() == 2019 + 2020


def test_catalog_table_finds_its_partitions(spark, folder):
    dated = trips(spark).withColumn("month", F.month("pickup_datetime"))
    files.write_partitioned(dated, folder, ["month"])
    table = sources.catalog_table(spark, new_table("external"), folder)
    assert table.count() == 3000
    text = plan(table.filter("month = 2"))
    assert "month" in text[text.index("PartitionFilters"):text.index("PushedFilters")]
    plain = f"{folder}-plain"
    files.write_parquet(trips(spark), plain)
    assert sources.catalog_table(spark, new_table("external"), plain).count() == 3000


def test_month_paths(spark, folder):
    dated = trips(spark).withColumns({"year": F.year("pickup_datetime"), "month": F.month("pickup_datetime")})
    files.write_partitioned(dated, folder, ["year", "month"])
    chosen = sources.read_parquet(spark, sources.month_paths(folder, [2019], [2, 3]))
    assert chosen.count() == dated.filter("month in (2, 3)").count()

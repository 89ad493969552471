from datetime import datetime

from pyspark.sql import functions as F

from fareflow.operators import reports
from tests.conftest import plan, rows


def trips(spark):
    data = [
        (datetime(2019, 2, 28, 23, 59, 59), "green", "B1", 5.0),
        (datetime(2019, 3, 1), "green", "B2", 9.0),
        (datetime(2019, 3, 31, 23), "yellow", "B2", 9.0),
        (datetime(2020, 2, 29, 12), "yellow", "B1", 1.0),
        (datetime(2021, 1, 1), "yellow", "B3", 4.0),
    ]
    return spark.createDataFrame(data, "pickup_datetime timestamp_ntz, service_type string, base string, miles double")


def test_top_lists_break_ties_by_key(spark):
    df = trips(spark)
    assert rows(reports.top_keys(df, "base")) == [("B1", 2)]
    days = [str(r.pickup_date) for r in reports.max_by_day(df, "pickup_datetime", "miles", "m", n=2).collect()]
    assert days == ["2019-03-01", "2019-03-31"]


def test_top_list_keeps_only_its_rows_per_task(spark):
    assert "TakeOrderedAndProject(limit=1" in plan(reports.top_keys(trips(spark), "base"))


def test_rows_by_month_adds_a_total_and_reads_once(spark):
    counted = reports.rows_by_month(trips(spark), "pickup_datetime", [(2019, 2), (2019, 3), (2020, 2), (2020, 12)])
    text = plan(counted)
    assert rows(counted) == [("2019-02", 1), ("2019-03", 2), ("2020-02", 1), ("total", 4)]
    assert text.count("ExistingRDD") + text.count("LocalTableScan") == 1, "one scan"


def test_rows_by_month_of_no_rows(spark):
    assert rows(reports.rows_by_month(trips(spark), "pickup_datetime", [(1990, 1)])) == [("total", 0)]


def test_service_share_is_of_the_year(spark):
    assert rows(reports.service_share(trips(spark), [2019, 2021])) == sorted(
        [(2019, "green", 2, 2 / 3), (2019, "yellow", 1, 1 / 3), (2021, "yellow", 1, 1.0)], key=str
    )


def test_distinct_count_exact_or_approximate(spark):
    df = trips(spark)
    assert reports.distinct_count(df, "base", "n").first()[0] == 3
    assert reports.distinct_count(df, "base", "n", approximate=0.05).first()[0] == 3


def test_footers_answer_without_a_page(spark, folder):
    df = spark.range(5000).selectExpr("id", "CAST(id % 7 AS INT) AS part", "CAST(id % 91 AS DOUBLE) AS x", "IF(id % 3 = 0, NULL, id) AS y")
    df.repartition(3).write.partitionBy("part").parquet(folder)
    found = reports.footer_report(spark, folder, ["part"], ["x", "y"])
    text = plan(found)
    assert "PushedAggregation: [COUNT(*)" in text and "MIN(y)" in text, text
    want = df.groupBy("part").agg(F.count("*"), F.min("x"), F.max("x"), F.min("y"), F.max("y"))
    assert rows(found) == rows(want)
    whole = reports.footer_report(spark, folder, [], ["y"])
    assert rows(whole) == [(5000, 1, 4999)] and "PushedAggregation: [COUNT(*)" in plan(whole)

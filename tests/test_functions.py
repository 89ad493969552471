"""Time and money expressions against plain Python."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fareflow.functions import moments as M
from fareflow.functions import money
from tests.conftest import plan, setting

SPAN = "start timestamp_ntz, end timestamp_ntz"


def spans(n=400, seed=3):
    draw = random.Random(seed)
    start = datetime(2024, 1, 1)
    return [
        (
            (a := start + timedelta(microseconds=draw.randrange(10**12))),
            a + timedelta(microseconds=draw.randrange(-3 * 10**11, 3 * 10**11)),
        )
        for _ in range(n)
    ] + [
        (start, start + timedelta(hours=25)),
        (start, start - timedelta(seconds=5)),
        (start, start - timedelta(microseconds=1)),
        (start, start),
    ]


def test_seconds_of_day_is_the_seconds_part_of_a_timedelta(spark):
    data = spans()
    df = spark.createDataFrame(data, SPAN).select(
        "start", "end", M.seconds_of_day("start", "end").alias("s"),
        M.seconds_of_day_udf("start", "end").alias("u"),
    )
    for row in df.collect():
        assert row.s == (row.end - row.start).seconds
        assert row.u == row.s


def test_seconds_of_day_wraps(spark):
    start = datetime(2024, 1, 1)
    data = [(start, start + timedelta(hours=25)), (start, start - timedelta(seconds=5)), (start, None)]
    df = spark.createDataFrame(data, SPAN)
    for expression in (M.seconds_of_day, M.seconds_of_day_udf):
        assert [r[0] for r in df.select(expression("start", "end")).collect()] == [3600, 86395, None]


def test_duration_counts_whole_elapsed_seconds(spark):
    df = spark.createDataFrame(spans(), SPAN)
    for row in df.select("start", "end", M.duration_seconds("start", "end").alias("s")).collect():
        assert row.s == int((row.end - row.start) / timedelta(seconds=1))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_truncation_does_not_depend_on_the_session_zone(spark, zone):
    times = [datetime(2024, 3, 10, 2, 30, 1), datetime(2024, 11, 3, 1, 59, 59), datetime(2024, 12, 31, 23, 0)]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    with setting(spark, "spark.sql.session.timeZone", zone):
        got = df.select("ts", M.hour_start("ts"), M.month_start("ts")).collect()
    for ts, hour, month in got:
        assert hour == ts.replace(minute=0, second=0)
        assert month == datetime(ts.year, ts.month, 1)


def test_day_bounds_include_the_last_day_and_moment_bounds_its_midnight(spark):
    times = [datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 2, 0, 0, 1), datetime(2024, 1, 3)]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    assert df.filter(M.days_between("ts", "2024-01-01", "2024-01-02")).count() == 3
    assert df.filter(M.moments_between("ts", "2024-01-01", "2024-01-02")).count() == 2


def test_day_and_year_filters_reach_the_file_scan(spark, folder):
    spark.createDataFrame([(datetime(2024, 5, 1), 1)], "ts timestamp_ntz, v int").write.parquet(folder)
    df = spark.read.parquet(folder)
    for condition in (M.on_day("ts", "2024-05-01"), M.in_year("ts", 2024), M.days_between("ts", "2024-01-01", "2024-06-01")):
        text = plan(df.filter(condition).select("v"))
        pushed = text[text.index("PushedFilters"):]
        assert "GreaterThanOrEqual(ts" in pushed and "LessThan" in pushed


def test_sums_are_exact_and_skip_missing_amounts(spark):
    draw = random.Random(5)
    cents = [draw.randrange(-10**9, 10**9) for _ in range(2000)]
    values = [(c / 100,) for c in cents] + [(None,), (float("nan"),)]
    df = spark.createDataFrame(values, "amount double").repartition(7)
    total, average, rows = df.agg(
        money.exact_sum("amount"), money.exact_avg("amount"), F.count(F.lit(1))
    ).first()
    assert total == float(Decimal(sum(cents)) / 100)
    assert average == total / len(cents)
    assert rows == len(cents) + 2


def test_sum_of_nothing_is_missing(spark):
    empty = spark.createDataFrame([(None,)], "amount double")
    assert tuple(empty.agg(money.exact_sum("amount"), money.exact_avg("amount")).first()) == (None, None)


def test_finer_values_lose_nothing(spark):
    values = [0.004, 0.004, 1.234, 2.5e-7, -3.3333333]
    df = spark.createDataFrame([(v,) for v in values], "amount double").repartition(3)
    total, average = df.agg(money.exact_sum("amount"), money.exact_avg("amount")).first()
    assert total == pytest.approx(sum(values), abs=1e-14)
    assert average == pytest.approx(sum(values) / 5, abs=1e-14)


def test_infinite_and_missing_values(spark):
    inf, nan = float("inf"), float("nan")
    for values, want, missing in (([1.0, inf], inf, 0), ([-inf, nan, 2.0], -inf, 1), ([inf, inf, None], inf, 1)):
        df = spark.createDataFrame([(v,) for v in values], "amount double")
        got = df.agg(money.exact_sum("amount"), money.exact_avg("amount"), money.unknown_count("amount")).first()
        assert tuple(got) == (want, want, missing)

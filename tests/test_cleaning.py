import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from fareflow.operators import cleaning
from fareflow.operators.feeds import union_feeds
from fareflow.schemas import GREEN, GREEN_FEED, SHARED_COLUMNS, YELLOW, YELLOW_FEED, fields
from tests.conftest import rows

NAN = float("nan")


def test_conform_orders_casts_and_drops(spark):
    df = spark.createDataFrame([(7, "x", 2.0)], "PUlocationID bigint, extra string, total double")
    out = cleaning.conform(df, fields(total="integer", PULocationID="integer"))
    assert out.dtypes == [("total", "int"), ("PULocationID", "int")]
    assert rows(out) == [(2, 7)]


def test_conform_names_a_missing_column(spark):
    with pytest.raises(KeyError, match="fare"):
        cleaning.conform(spark.range(1), fields(id="long", fare="double"))


def test_conform_fails_or_nulls_what_does_not_fit(spark):
    df = spark.createDataFrame([("12",), ("x",)], "id string")
    with pytest.raises(PySparkException):
        cleaning.conform(df, fields(id="integer")).collect()
    assert rows(cleaning.conform(df, fields(id="integer"), strict=False)) == [(12,), (None,)]
    big = spark.createDataFrame([(2**40,)], "id bigint")
    with pytest.raises(PySparkException):
        cleaning.conform(big, fields(id="integer")).collect()


def test_fix_timestamps(spark):
    df = spark.createDataFrame([("2021-01-01 00:30:10",), ("soon",)], "t string")
    with pytest.raises(PySparkException):
        cleaning.fix_timestamps(df, ["t"]).collect()
    out = cleaning.fix_timestamps(df, ["t"], strict=False)
    assert out.dtypes == [("t", "timestamp_ntz")]
    assert out.filter(F.col("t").isNull()).count() == 1


def test_zero_is_dropped_and_missing_stays(spark):
    df = spark.createDataFrame([(0.0,), (None,), (NAN,), (2.0,)], "passenger_count double")
    kept = [r[0] for r in cleaning.drop_zero(df).collect()]
    assert len(kept) == 3 and None in kept and 2.0 in kept


def test_missing_becomes_zero(spark):
    df = spark.createDataFrame([(None,), (NAN,), (2.0,)], "passenger_count double")
    assert sorted(r[0] for r in cleaning.fill_zero(df).collect()) == [0.0, 0.0, 2.0]


def test_quality_counters(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (None,), (NAN,), (2.0,)], "passenger_count double")
    assert rows(cleaning.quality_counters(df)) == sorted(
        [("read", 5, 2, 2), ("zero_dropped", 3, 2, 0), ("missing_filled", 5, 0, 4)], key=str
    )
    whole = spark.createDataFrame([(0,), (None,)], "passenger_count int")
    assert ("read", 2, 1, 1) in rows(cleaning.quality_counters(whole))


def test_counters_can_ride_along(spark):
    df = spark.createDataFrame([(0.0,), (None,), (NAN,), (2.0,)], "passenger_count double")
    seen = Observation("quality")
    assert cleaning.observe_quality(df, "passenger_count", seen).count() == 4
    assert seen.get == {"rows": 4, "missing": 2, "zero": 1}


def test_union_widens_and_tags(spark):
    green = spark.createDataFrame([tuple([None] * len(GREEN))], GREEN).withColumn("payment_type", F.lit(2.0))
    yellow = spark.createDataFrame([tuple([None] * len(YELLOW))], YELLOW).withColumn("payment_type", F.lit(1).cast("long"))
    out = union_feeds([(green, GREEN_FEED), (yellow, YELLOW_FEED)])
    assert out.columns == [*SHARED_COLUMNS, "service_type"]
    assert dict(out.dtypes)["payment_type"] == "double"
    assert rows(out.select("payment_type", "service_type")) == [(1.0, "yellow"), (2.0, "green")]


def test_feed_schemas_share_the_eighteen_columns():
    for feed in (GREEN_FEED, YELLOW_FEED):
        common = {feed.pickup: "pickup_datetime", feed.dropoff: "dropoff_datetime"}
        names = {common.get(n, n) for n in feed.schema.fieldNames()}
        assert len(feed.schema) == 19 and set(SHARED_COLUMNS) <= names

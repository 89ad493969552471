"""Whole jobs on feeds with their full schemas."""

import json
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fareflow import jobs, schemas
from fareflow.streaming import counts, runner
from tests.conftest import rows
from tests.test_streams import envelope, ride


def feed_rows(feed, n):
    out = []
    for i in range(n):
        row = dict.fromkeys(feed.schema.fieldNames())
        row.update({name: float(i % 5) + 0.25 for name in schemas.REVENUE_MEASURES})
        row[feed.pickup] = datetime(2020, 1 + i % 3, 1) + timedelta(minutes=37 * i)
        row[feed.dropoff] = row[feed.pickup] + timedelta(minutes=5)
        row.update(PULocationID=i % 4 or None, trip_distance=float(i % 9), passenger_count=float(i % 3) if i % 7 else None)
        out.append(tuple(row.values()))
    return out


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    data = {}
    for feed, n in ((schemas.GREEN_FEED, 200), (schemas.YELLOW_FEED, 300)):
        data[feed.service] = feed_rows(feed, n)
        df = spark.createDataFrame(data[feed.service], feed.schema)
        for month in (1, 2, 3):
            df.filter(F.month(feed.pickup) == month).write.parquet(f"{root}/raw/{feed.service}/2020/{month:02d}")
    spark.createDataFrame([(1, "Q", "Astoria"), (2, "M", "Harlem")], schemas.ZONES).write.option("header", True).csv(f"{root}/zones")
    return root, data


def raw(root, service):
    return f"{root}/raw/{service}/2020/*"


def test_monthly_revenue(spark, lake, folder):
    root, data = lake
    jobs.main(["monthly-revenue", "--green", raw(root, "green"), "--yellow", raw(root, "yellow"), "--output", folder])
    report = spark.read.parquet(folder)
    assert report.columns == [
        "revenue_zone", "revenue_month", "service_type", *schemas.REVENUE_MEASURES.values(),
        *schemas.AVERAGE_MEASURES.values(),
    ]
    assert len(report.inputFiles()) == 1
    want, people = defaultdict(float), defaultdict(list)
    for feed in (schemas.GREEN_FEED, schemas.YELLOW_FEED):
        names = feed.schema.fieldNames()
        for values in data[feed.service]:
            row = dict(zip(names, values))
            key = (row["PULocationID"], row[feed.pickup].replace(day=1, hour=0, minute=0), feed.service)
            want[key] += row["tolls_amount"]
            if row["passenger_count"] is not None:
                people[key].append(row["passenger_count"])
    got = {tuple(r)[:3]: r for r in report.collect()}
    assert {k: r.revenue_monthly_tolls_amount for k, r in got.items()} == pytest.approx(want)
    assert {k: r.avg_montly_passenger_count for k, r in got.items()} == pytest.approx(
        {k: sum(v) / len(v) for k, v in people.items()}
    )


def test_zone_revenue(spark, lake, folder):
    root, _ = lake
    jobs.zone_revenue(spark, raw(root, "green"), raw(root, "yellow"), f"{root}/zones", "2020-02-01", folder)
    out = spark.read.parquet(folder)
    assert out.filter("hour < '2020-02-01'").count() == 0 and out.count() > 0
    assert {r.Zone for r in out.select("Zone").distinct().collect()} == {"Astoria", "Harlem"}


def test_monthly_layout_can_be_run_again(spark, lake, folder):
    root, data = lake
    for _ in range(2):
        jobs.monthly_layout(spark, "yellow", raw(root, "yellow"), folder, "2020-q1")
    out = spark.read.parquet(folder)
    assert out.count() == 300
    assert rows(out.groupBy("year", "month").count()) == [(2020, 1, 100), (2020, 2, 100), (2020, 3, 100)]


def test_layout_of_overlapping_loads(spark, tmp_path):
    """January's file, then February's with one ride of 31 January, the second twice."""
    feed, out = schemas.YELLOW_FEED, str(tmp_path / "out")
    names = feed.schema.fieldNames()

    def file(name, *days):
        data = []
        for day in days:
            row = dict.fromkeys(names)
            row[feed.pickup] = day
            data.append(tuple(row.values()))
        spark.createDataFrame(data, feed.schema).write.parquet(str(tmp_path / name))

    file("01", *[datetime(2020, 1, d) for d in range(1, 21)])
    file("02", *[datetime(2020, 2, d) for d in range(1, 11)], datetime(2020, 1, 31, 23, 59))
    for name in ("01", "02", "02"):
        jobs.monthly_layout(spark, "yellow", str(tmp_path / name), out, f"2020-{name}")
    assert rows(spark.read.parquet(out).groupBy("year", "month").count()) == [(2020, 1, 21), (2020, 2, 10)]


@pytest.mark.parametrize("service", ["yellow", "hvfhv", "fhv"])
def test_csv_to_clean_files_to_layout(spark, tmp_path, service):
    feed = jobs.ALL_FEEDS[service]
    row = dict.fromkeys(feed.schema.fieldNames())
    row.update({feed.pickup: "2020-02-03 04:05:06", "PULocationID": "7"})
    names = list(row)[::-1]
    (tmp_path / "in.csv").write_text(",".join(names) + "\n" + ",".join(str(row[n] or "") for n in names) + "\n")
    clean, out = str(tmp_path / "clean"), str(tmp_path / "out")
    jobs.main(["clean-csv", "--feed", service, "--input", str(tmp_path / "in.csv"), "--output", clean])
    assert spark.read.parquet(clean).schema.fieldNames() == feed.schema.fieldNames()
    jobs.main(["monthly-layout", "--feed", service, "--input", clean, "--output", out, "--load", "a"])
    (got,) = spark.read.parquet(out).collect()
    assert (got["year"], got["month"], got["PULocationID"], got[feed.pickup]) == (2020, 2, 7, datetime(2020, 2, 3, 4, 5, 6))


def test_load_table_fills_missing_counts(spark, lake, folder):
    root, data = lake
    for _ in range(2):
        jobs.load_table(spark, "green", raw(root, "green"), folder, "2020")
    out = spark.read.parquet(folder)
    assert out.count() == 200 and out.filter("passenger_count is null").count() == 0


def test_both_flows_in_one_table(spark, tmp_path):
    names = "abcdefghij"
    out, report = str(tmp_path / "out"), str(tmp_path / "report")
    for flow, fob in (("exports", 10), ("imports", 4), ("exports", 10)):
        values = ["1997", "2", "Chile", "South", "Santos", "SP", "01", "Animals", str(fob), "3"]
        text = json.dumps({"data": {"list": [dict(zip(names, values))]}}, indent=2)
        (tmp_path / f"{flow}.json").write_text(text)
        jobs.main(["load-trade", "--input", str(tmp_path / f"{flow}.json"), "--fields", ",".join(names), "--flow", flow,
                   "--output", out, "--load", flow, "--multiline"])
    jobs.main(["trade-balance", "--input", out, "--output", report])
    assert rows(spark.read.parquet(report)) == [("1997", 10, 4, 6), ("all", 10, 4, 6)]
    with pytest.raises(Exception, match="multiline"):
        jobs.load_trade(spark, str(tmp_path / "exports.json"), ",".join(names), "exports", out, "x")


def test_load_trade(spark, tmp_path):
    record = dict(zip("abcdefghij", ["1997", "2", "Chile", "South", "Santos", "SP", "01", "Animals", "10", "3"]))
    (tmp_path / "in.json").write_text(json.dumps({"data": {"list": [record, {**record, "b": "3"}]}}))
    out = str(tmp_path / "out")
    jobs.load_trade(spark, str(tmp_path / "in.json"), "a,b,c,d,e,f,g,h,i,j", "exports", out, "1997")
    assert sorted(str(r.trade_date) for r in spark.read.parquet(out).collect()) == ["1997-02-01", "1997-03-01"]


def test_ride_jobs(spark, tmp_path):
    topic = str(tmp_path / "topic")
    envelope(spark, [ride(1, 50.0), ride(1, 5.0), ride(2, 1.0), "bad"]).write.parquet(topic)
    for job in ("route", "count"):
        run = {"route": jobs.route_rides, "count": jobs.count_vendors}[job]
        run(spark, topic, str(tmp_path / f"{job}-checkpoint"), str(tmp_path / job))
    assert spark.read.parquet(str(tmp_path / "route")).groupBy("topic").count().count() == 3
    assert rows(runner.read_current(spark, str(tmp_path / "count"), counts.VENDOR_COUNTS)) == [(1, 2), (2, 1)]

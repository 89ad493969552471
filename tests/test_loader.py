"""Files loaded as they arrive: each once, late ones too, a batch cut short again."""

import glob
import os
from datetime import datetime

import pytest

from fareflow import jobs
from fareflow.schemas import FeedSpec, fields
from fareflow.session import set_age
from fareflow.sinks.manifest import read_manifest
from fareflow.streaming import loader
from tests.conftest import rows

FEED = FeedSpec("x", "t", "t", fields(t="timestamp_ntz", n="double"))


def arrive(spark, folder, name, values, kind="double"):
    """One file: a trip for each (month, n)."""
    data = [(datetime(2020, month, 1), n) for month, n in values]
    df = spark.createDataFrame(data, "t timestamp_ntz, n int").selectExpr("t", f"CAST(n AS {kind}) AS n")
    df.coalesce(1).write.parquet(f"{folder}/raw/{name}")


def load(spark, folder, files=1000):
    loader.load_feed_arrivals(spark, FEED, f"{folder}/raw/*", f"{folder}/out", f"{folder}/checkpoint", files_per_batch=files)
    return rows(spark.read.parquet(f"{folder}/out").select("month", "n"))


def test_each_file_once(spark, folder):
    arrive(spark, folder, "a", [(1, 1), (2, 2)])
    assert load(spark, folder) == [(1, 1.0), (2, 2.0)]
    assert load(spark, folder) == [(1, 1.0), (2, 2.0)]
    arrive(spark, folder, "b", [(1, 3)], "bigint")
    arrive(spark, folder, "late", [(2, 4)], "int")
    for file in glob.glob(f"{folder}/raw/late/*.parquet"):
        set_age(spark, file, days=400)
    assert load(spark, folder) == [(1, 1.0), (1, 3.0), (2, 2.0), (2, 4.0)]
    assert rows(read_manifest(spark, f"{folder}/out").select("load").distinct()) == [("arrivals-000000000",), ("arrivals-000000001",)]


def test_several_batches_in_a_run(spark, folder):
    for i in range(5):
        arrive(spark, folder, f"f{i}", [(1, i)])
    assert load(spark, folder, files=2) == [(1, float(i)) for i in range(5)]
    assert read_manifest(spark, f"{folder}/out").count() == 3


@pytest.mark.parametrize("moment", ["before the write", "after the write"])
def test_a_batch_cut_short_is_replaced(spark, folder, monkeypatch, moment):
    arrive(spark, folder, "a", [(1, 1), (2, 2)])
    write = loader.write_load

    def cut(*args):
        if moment == "after the write":
            write(*args)
        raise RuntimeError("cut short")

    with monkeypatch.context() as patch:
        patch.setattr(loader, "write_load", cut)
        with pytest.raises(Exception, match="cut short"):
            load(spark, folder)
    arrive(spark, folder, "b", [(1, 3)])
    assert load(spark, folder) == [(1, 1.0), (1, 3.0), (2, 2.0)]


def test_a_batch_repeated_after_its_write(spark, folder):
    """As if the run had died between the write and the stream's own commit."""
    arrive(spark, folder, "a", [(1, 1)])
    load(spark, folder)
    for file in glob.glob(f"{folder}/checkpoint/commits/*") + glob.glob(f"{folder}/checkpoint/commits/.*.crc"):
        if os.path.basename(file).lstrip(".").startswith("0"):
            os.remove(file)
    assert load(spark, folder) == [(1, 1.0)]


def test_only_paths_go_through_the_stream(spark, folder):
    """The content of a file is not read to learn that it has come."""
    os.makedirs(f"{folder}/raw/big")
    with open(f"{folder}/raw/big/x.bin", "wb") as file:
        file.truncate(3 * 1024**3)  # more than a row of Spark can hold
    seen = []
    loader.each_arrival(spark, f"{folder}/raw/*", f"{folder}/checkpoint", lambda paths, n: seen.append((paths, n)))
    assert [(len(paths), n) for paths, n in seen] == [(1, 0)] and seen[0][0][0].endswith("x.bin")


def test_the_job(spark, folder):
    feed = jobs.ALL_FEEDS["fhv"]
    df = spark.createDataFrame([("B1", datetime(2021, 5, 1), None, 1, 2, 3, None)], feed.schema) if len(feed.schema) == 7 else None
    assert df is not None
    df.write.parquet(f"{folder}/raw/05")
    for _ in range(2):
        jobs.load_arrivals(spark, "fhv", f"{folder}/raw/*", f"{folder}/checkpoint", f"{folder}/out")
    assert rows(spark.read.parquet(f"{folder}/out").select("year", "month")) == [(2021, 5)]

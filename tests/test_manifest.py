"""Loads know their folders: what a load changes, what it looks at, and what happens after one cut short."""

import glob
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from fareflow.session import new_table
from fareflow.sinks import files, manifest, tables
from tests.conftest import rows


def numbers(spark, n, months=4):
    return spark.range(n).select("id", (F.col("id") % months).cast("int").alias("month"))


def unread(path):
    """The folders below ``path``, each marked as not read since it was changed."""
    found = [d for d, *_ in os.walk(path)]
    for d in found:
        os.utime(d, (1, os.stat(d).st_mtime))
    return found


def listed(found):
    """Those that have been read since. Folders that went count as read."""
    return [d for d in found if not os.path.exists(d) or os.stat(d).st_atime > 1e9]


def test_the_price_of_a_load_does_not_grow_with_the_table(spark, folder):
    """A load of two months in a table of 2,000 folders reads no folder of another load."""
    wide = numbers(spark, 2000, 2000)
    name = new_table("wide")
    tables.create_load_table(wide, name, ["month"], folder)
    tables.load_table(wide.coalesce(1), name, ["month"], "big")
    assert len(glob.glob(f"{folder}/month=*")) == 2000
    small = numbers(spark, 6, 2).withColumn("month", F.col("month") + 5000)
    tables.load_table(small, name, ["month"], "small")
    found = unread(folder)
    os.listdir(f"{folder}/month=7")
    assert listed(found) == [f"{folder}/month=7"], "this file system does not tell which folders are read"
    found = unread(folder)
    tables.load_table(small.filter("month = 5001"), name, ["month"], "small")
    seen = [x for x in listed(found) if "/month=" in x]
    assert seen and all("month=500" in x for x in seen)
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 2001
    assert spark.table(name).count() == 2003


def test_the_input_is_read_once(spark, folder):
    """Also where the load has folders of the last time to take away."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = numbers(spark, 100)
    files.write_load(df, folder, ["month"], "a")
    change = files.write_load(df.filter("month < 3").mapInArrow(count, df.schema), folder, ["month"], "a")
    assert seen.value == 75
    assert change.removed == ["month=3/load=a"] and change.added == []
    assert spark.read.parquet(folder).count() == 75


ODD = ["2019-02 v/1", "it's", 'a"b', "x=y", "100%", "[a]*{b}?", "ü\\n", "^#:"]


def test_odd_names_and_values(spark, folder):
    """Folder names are those Spark writes, whatever the values."""
    values = [*ODD, None, ""]
    df = spark.createDataFrame(list(enumerate(values)), "id int, part string")
    name = new_table("odd")
    tables.create_load_table(df, name, ["part"], folder)
    for load in ODD:
        tables.load_table(df, name, ["part"], load)
    assert spark.table(name).count() == len(ODD) * len(values)
    kept = manifest.read_manifest(spark, folder)
    assert kept.count() == len(ODD) * (len(values) - 1)
    for row in kept.collect():
        assert os.path.isdir(f"{folder}/{row.folder}"), row.folder
    for load in ODD:
        tables.load_table(df.filter("id = 0"), name, ["part"], load)
    assert spark.table(name).count() == len(ODD) and spark.read.parquet(folder).count() == len(ODD)
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == len(ODD)


def test_dates_and_numbers_as_partitions(spark, folder):
    df = spark.sql("SELECT id, DATE'2020-01-31' + INTERVAL 1 DAY * CAST(id AS INT) AS day, id % 2 = 0 AS even FROM range(4)")
    df = df.withColumn("day", F.col("day").cast("date"))
    name = new_table("typed")
    tables.create_load_table(df, name, ["day", "even"], folder)
    loaded = tables.load_table(df, name, ["day", "even"], "1")
    assert loaded.filter(F.col("day") == date(2020, 2, 1)).count() == 1
    assert tables.load_table(df.filter("even"), name, ["day", "even"], "1").count() == 2


@pytest.mark.parametrize("moment", ["before the write", "after the write"])
def test_a_load_cut_short_is_mended_by_the_next(spark, folder, monkeypatch, moment):
    """A run that ended between its write and its list leaves folders that no list names."""
    df = numbers(spark, 40)
    files.write_load(df.filter("month < 2"), folder, ["month"], "a")
    files.write_load(df, folder, ["month"], "b")
    with monkeypatch.context() as patch:
        if moment == "after the write":
            patch.setattr(manifest.Manifest, "end", lambda *_: 1 / 0)
        else:
            patch.setattr(files, "spread_for", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            files.write_load(df.filter("month in (0, 3)"), folder, ["month"], "a")
    files.write_load(df.filter("month < 1"), folder, ["month"], "a")
    out = spark.read.parquet(folder)
    assert rows(out.groupBy("load", "month").count()) == [("a", 0, 10), *(("b", m, 10) for m in range(4))]
    assert not glob.glob(f"{folder}/_loads/*/*.open")


def test_a_load_without_rows(spark, folder):
    df = numbers(spark, 8)
    files.write_load(df, folder, ["month"], "a")
    files.write_load(df, folder, ["month"], "b")
    change = files.write_load(df.limit(0), folder, ["month"], "a")
    assert len(change.removed) == 4 and not change.after
    assert spark.read.parquet(folder).count() == 8
    assert rows(manifest.read_manifest(spark, folder).select("load").distinct()) == [("b",)]
    assert manifest.read_manifest(spark, f"{folder}-none").count() == 0

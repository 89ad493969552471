"""What the queries assume about the test tables and the session."""

import pytest
from pyspark.sql import functions as F

from fareflow import session
from fareflow.plans import bindings as B
from tests.conftest import SMALL, plan

KEYS = [
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_every_key_resolves_once(spark, sf):
    """So a join that adds no wanted column neither drops nor repeats a row."""
    root = SMALL.replace("sf0.001", sf)
    for table, key, other, other_key in KEYS:
        left, right = B.table(spark, root, table), B.table(spark, root, other)
        assert left.join(right, left[key] == right[other_key], "left_anti").count() == 0
        assert right.count() == right.select(other_key).distinct().count()


def test_only_needed_tables_are_read(spark):
    text = plan(B.trips(spark, SMALL, "VendorID", "pickup_datetime"))
    assert text.count("FileScan") == 2
    assert plan(B.trips(spark, SMALL, "passenger_count")).count("FileScan") == 1
    assert plan(B.trips(spark, SMALL)).count("FileScan") == 4


def test_bindings_exercise_missing_and_unknown_values(spark):
    root = SMALL.replace("sf0.001", "sf0.01")
    trips = B.trips(spark, root)
    missing = trips.agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in ("PULocationID", "DOLocationID", "passenger_count")],
        F.count_if(F.col("passenger_count") == 0).alias("zero"),
        F.count_if(F.col("PULocationID") >= 20).alias("unknown"),
    ).first()
    assert all(n > 0 for n in missing)


class Conf(dict):
    def set(self, key, value):
        self[key] = value


class FakeSession:
    """Just the parts of a session that the working folder depends on."""

    def __init__(self, master, **conf):
        self.conf = Conf(conf)
        self.sparkContext = type("Context", (), {"master": master})


def test_working_folder_is_the_one_the_cluster_names(monkeypatch):
    monkeypatch.setattr(session, "_open", [])
    named = FakeSession("yarn", **{"spark.checkpoint.dir": "hdfs://store/shared/"})
    assert session.shared_folder(named) == "hdfs://store/shared"
    first, second = session.new_folder(named, "x"), session.new_folder(named, "x")
    assert first != second and first.startswith("hdfs://store/shared/")


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(FakeSession("yarn"))


def test_a_local_session_gets_a_folder_of_its_own():
    local = FakeSession("local[2]")
    assert session.shared_folder(local) == session.shared_folder(local)


def test_shuffles_are_cut_to_task_memory():
    assert session.shuffle_partitions(10**9) == 200
    assert session.shuffle_partitions(40 * 10**12) == 298_024


def test_a_session_of_its_own_shares_tables_and_not_settings(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    own = session.own_session(spark, spark__sql__autoBroadcastJoinThreshold=7)
    assert (own.conf.get(key), spark.conf.get(key)) == ("7", before)


def test_a_workspace_leaves_nothing(spark, tmp_path):
    """Of queries that write folders, tables and views, nothing is there after the block."""
    from fareflow.plans import QUERIES

    def there():
        names = {t.name for t in spark.catalog.listTables()}
        return names, set(session.folders(spark, f"{session.shared_folder(spark)}/fareflow/*"))

    before = there()
    with session.workspace(spark):
        for name in ("external_table_scan", "table_append_idempotent", "ctas_plain", "stream_restart"):
            QUERIES[name].run(spark, SMALL).collect()
        during = there()
        assert len(during[0]) > len(before[0]) and len(during[1]) > len(before[1])
    assert there() == before


def test_an_orphan_line_counts_everywhere(spark, tmp_path):
    """An order line without its order, supplier or part is a ride in every query that counts rides."""
    from fareflow.plans import bindings as B

    for name in ("orders", "customer", "supplier", "part", "nation", "region", "lineitem"):
        df = spark.read.parquet(f"{SMALL}/{name}.parquet")
        if name == "lineitem":
            df = df.unionAll(df.limit(1).withColumns(
                {c: F.lit(10**9).cast(df.schema[c].dataType) for c in ("l_orderkey", "l_suppkey", "l_partkey")}
            ))
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    lines = spark.read.parquet(f"{tmp_path}/lineitem.parquet").count()
    columns = ("VendorID", "pickup_datetime", "PULocationID", "DOLocationID", "total_amount")
    for chosen in (columns[:1], columns[:2], columns[:3], columns, ("DOLocationID",)):
        assert B.trips(spark, str(tmp_path), *chosen).count() == lines
    assert B.fhv(spark, str(tmp_path)).count() == lines

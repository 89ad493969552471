import os
import sys
from contextlib import contextmanager

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fareflow.session import build_session, workspace  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions=4,
        spark__driver__memory="6g",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@contextmanager
def setting(spark, key, value):
    """A session setting that holds for the block only."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@pytest.fixture(autouse=True)
def tidy(spark):
    """What a test's queries write is removed after it."""
    with workspace(spark):
        yield


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "out")


def plan(df) -> str:
    """The physical plan as planned, before any stage has run."""
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)

"""The kept report equals one computed from all trips, whatever loads came in what order."""

import glob
import os
from datetime import datetime

import pytest

from fareflow.operators import kept as K
from fareflow.operators.revenue import monthly_revenue
from tests.conftest import rows

SUMS, AVERAGES = {"fare": "fares"}, {"people": "avg_people"}
NAN, INF = float("nan"), float("inf")


def trips(spark, values):
    """values: (zone, month, service, fare, people)."""
    data = [(z, m and datetime(2020, m, 5), s, f, p) for z, m, s, f, p in values]
    return spark.createDataFrame(data, "PULocationID long, pickup_datetime timestamp_ntz, service_type string, fare double, people double")


JANUARY = [(1, 1, "green", 1.1, 1.0), (1, 1, "green", 2.2, None), (2, 1, "yellow", 0.1, NAN), (None, 1, "green", 1.005, 3.0)]
FEBRUARY = [(1, 2, "green", 3.3, 2.0), (1, 1, "green", 0.3, 5.0), (1, None, "green", 9.0, 1.0), (2, 2, None, INF, 1.0)]


@pytest.fixture
def report(folder):
    return K.KeptReport(f"{folder}/states", f"{folder}/report", SUMS, AVERAGES)


def want(spark, values):
    return rows(monthly_revenue(trips(spark, values), SUMS, AVERAGES))


def test_loads_corrections_and_strays(spark, report):
    assert report.load(trips(spark, JANUARY[:2]), "jan") == ["month=2020-01-01"]
    assert rows(report.read(spark)) == want(spark, JANUARY[:2])
    report.load(trips(spark, FEBRUARY), "feb")
    assert rows(report.read(spark)) == want(spark, JANUARY[:2] + FEBRUARY)
    report.load(trips(spark, JANUARY), "jan")
    assert rows(report.read(spark)) == want(spark, JANUARY + FEBRUARY)
    assert len(report.load(trips(spark, FEBRUARY[:1]), "feb")) == 3, "also months the load has left"
    assert rows(report.read(spark)) == want(spark, JANUARY + FEBRUARY[:1])
    report.load(trips(spark, []), "feb")
    assert rows(report.read(spark)) == want(spark, JANUARY)


def test_other_months_are_left_alone(spark, report, folder):
    for month in (1, 2, 3):
        report.load(trips(spark, [(1, month, "green", 1.0, 1.0)]), f"m{month}")
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/report/*/*.parquet")}
    report.load(trips(spark, [(1, 2, "green", 5.0, 1.0)]), "m2")
    after = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/report/*/*.parquet")}
    assert len(before.items() & after.items()) == 2 and len(after) == 3


@pytest.mark.parametrize("moment", ["write_load", "refresh"])
def test_a_run_cut_short_is_made_up_for(spark, report, monkeypatch, moment):
    report.load(trips(spark, FEBRUARY), "feb")
    with monkeypatch.context() as patch:
        if moment == "refresh":
            patch.setattr(K.KeptReport, "refresh", lambda *_: 1 / 0)
        else:
            patch.setattr(K, "write_load", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            report.load(trips(spark, FEBRUARY[:1]), "feb")
    report.load(trips(spark, JANUARY), "jan")
    kept = FEBRUARY[:1] if moment == "refresh" else FEBRUARY
    assert rows(report.read(spark)) == want(spark, JANUARY + kept)
    assert report.refresh(spark) == []

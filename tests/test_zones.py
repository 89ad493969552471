"""Zone joins on a small fixture, broadcast and shuffled, with a hot zone and missing ids."""

from collections import Counter

import pytest

from fareflow.operators import revenue
from fareflow.operators import zones as Z
from tests.conftest import plan, rows, setting

ZONES = [(1, "Q", "Astoria"), (2, "M", "Harlem"), (3, "M", "Harlem"), (4, "B", "Bay")]
TRIPS = [(1, 2, 0.5)] * 60 + [(1, 9, 3.5), (1, None, 1.0), (None, 1, 9.0), (2, 3, 0.1), (3, 2, 0.2), (9, 9, 0.3)]


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.createDataFrame(ZONES, "LocationID bigint, Borough string, Zone string")


@pytest.fixture(scope="module")
def trips(spark):
    return spark.createDataFrame(TRIPS, "PULocationID bigint, DOLocationID bigint, tip_amount double")


@pytest.fixture(params=["10m", "-1"], ids=["broadcast", "shuffled"])
def threshold(spark, request):
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", request.param), setting(
        spark, "spark.sql.adaptive.autoBroadcastJoinThreshold", request.param
    ):
        yield request.param


NAME = {i: zone for i, _, zone in ZONES}


def test_trips_per_zone(threshold, trips, lookup):
    want = Counter(NAME[pu] for pu, _, _ in TRIPS if pu in NAME)
    got = [tuple(r) for r in Z.trips_per_zone(trips, lookup).collect()]
    assert got == sorted(want.items(), key=lambda item: (-item[1], item[0]))


def test_top_pairs_merge_ids_of_one_name_and_label_the_unknown(threshold, trips, lookup):
    want = Counter(f"{NAME.get(pu, 'Unknown')} / {NAME.get(do, 'Unknown')}" for pu, do, _ in TRIPS)
    top = sorted(want.items(), key=lambda item: (-item[1], item[0]))[:3]
    assert [tuple(r) for r in Z.top_zone_pairs(trips, lookup, n=3).collect()] == top


def test_max_tip_keeps_unknown_dropoffs(threshold, trips, lookup):
    want = {}
    for pu, do, tip in TRIPS:
        if NAME.get(pu) == "Astoria":
            want[NAME.get(do)] = max(tip, want.get(NAME.get(do), 0))
    got = [tuple(r) for r in Z.max_tip_from_zone(trips, lookup, "Astoria").collect()]
    assert dict(got) == want and got[0] == (None, 3.5)


def test_known_zone_trips_keeps_duplicates(threshold, trips, lookup):
    want = [t for t in TRIPS if t[0] in NAME and t[1] in NAME]
    assert Z.known_zone_trips(trips, lookup).count() == len(want)


def test_outer_join_leaves_rows_without_zone_apart(spark, lookup):
    schema = "hour timestamp_ntz, zone bigint, amount double, number_records bigint"
    from datetime import datetime

    hour = datetime(2024, 1, 1, 5)
    green = spark.createDataFrame([(hour, 1, 1.0, 1), (hour, None, 2.0, 1)], schema)
    yellow = spark.createDataFrame([(hour, 1, 5.0, 2), (hour, None, 6.0, 1), (hour, 4, 7.0, 1)], schema)
    both = revenue.combine_feeds(green, yellow)
    assert rows(both.drop("hour")) == sorted(
        [(1, 1.0, 1, 5.0, 2), (None, 2.0, 1, None, None), (None, None, None, 6.0, 1), (4, None, None, 7.0, 1)],
        key=str,
    )
    named = Z.revenue_by_zone_named(both, lookup)
    assert named.columns == [
        "hour", "green_amount", "green_number_records", "yellow_amount", "yellow_number_records",
        "Borough", "Zone",
    ]
    assert rows(named.select("Zone", "yellow_amount")) == [("Astoria", 5.0), ("Bay", 7.0)]


def test_facts_are_grouped_before_names_are_joined(trips, lookup):
    text = plan(Z.top_zone_pairs(trips, lookup))
    assert text.index("TakeOrderedAndProject") == text.index("Take")
    joins, scan = text.index("Join"), text.rindex("partial_count(1)")
    assert joins < scan, "the count by id lies below the joins"


def test_lookup_beyond_the_threshold_is_not_broadcast(spark, trips, lookup):
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        assert "BroadcastHashJoin" not in plan(Z.known_zone_trips(trips, lookup))

"""Stream jobs over several batches, with bad messages, restarts and a repeated batch."""

import glob
import json
import os

import pytest

from fareflow.schemas import COUNTER, ENVELOPE
from fareflow.session import folders, new_folder, own_session, set_age
from fareflow.sources.topics import read_recorded_topic
from fareflow.streaming import counts, messages, routing, runner
from tests.conftest import plan, rows


def ride(vendor, amount=10.0, **changes):
    value = dict(vendorId=vendor, passenger_count=1, trip_distance=1.5, payment_type=1, total_amount=amount)
    value.update(changes)
    return json.dumps({k: v for k, v in value.items() if v is not ...})


def envelope(spark, values, topic="rides"):
    data = [(f"k{i}", v, topic, 0, i) for i, v in enumerate(values)]
    return spark.createDataFrame(data, ENVELOPE)


VALUES = [
    ride(1, 40.0), ride(1, 39.99), ride(2, 400.0), ride(3, 0.0),
    "not json", "", None, ride(1, ...), ride(1, "much"), ride("x"), ride(1, None), "[1, 2]",
    ride(1) + " trailing", ride(1) + ride(2), ride(1) + "," + ride(2), ride(1, float("nan")), ride(1, float("inf")),
    ride(1) + "]", "{}", ride(1) + '],"z":[', ride(1) + '],"end":true}', ride(1) + '],"end":true} garbage',
    ride(1) + '],"record":[' + ride(2), ride(1) + "]} garbage", ride(1) + '],"end":[]}',
]
GOOD = 4


def test_invalid_messages_are_rejected_whole(spark):
    decoded = messages.decode(envelope(spark, VALUES))
    assert messages.records(decoded).count() == GOOD
    bad = messages.rejects(decoded)
    assert bad.columns == ENVELOPE.fieldNames()
    assert sorted(map(str, (r.value for r in bad.collect()))) == sorted(map(str, VALUES[GOOD:]))


def test_a_message_is_parsed_once(spark):
    decoded = messages.decode(envelope(spark, VALUES))
    for result in (messages.records(decoded), routing.route_by_amount(decoded), counts.vendor_counts(decoded)):
        assert plan(result).count("from_json") == 1


def test_routing(spark):
    topics = routing.AmountTopics(high="high", low="low", reject="bad")
    routed = routing.route_by_amount(messages.decode(envelope(spark, VALUES)), topics)
    got = {r.key: r.topic for r in routed.collect()}
    assert [got[f"k{i}"] for i in range(len(VALUES))] == ["high", "low", "high", "low"] + ["bad"] * (len(VALUES) - GOOD)
    assert {r.value for r in routed.collect()} == set(VALUES)


def test_required_fields_can_be_chosen(spark):
    decoded = messages.decode(envelope(spark, [ride(1, ...), ride(2)]), required=["vendorId"])
    assert messages.records(decoded).count() == 2


def test_counter_messages(spark):
    decoded = messages.decode(envelope(spark, ['{"number": 0}', '{"number": 7}', '{}']), COUNTER)
    assert rows(messages.records(decoded)) == [(0,), (7,)]


def test_prices(spark):
    values = ['{"data": {"amount": "27123.45"}}', '{"data": {"amount": "n/a"}}', '{"data": {}}', "x"]
    got = {r.amount: (r.line, r.price and float(r.price)) for r in messages.prices(envelope(spark, values)).collect()}
    assert got == {"27123.45": ("Bitcoin price: 27123.45", 27123.45), "n/a": ("Bitcoin price: n/a", None)}


def add_messages(spark, folder, values):
    envelope(spark, values).coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def base(spark):
    return new_folder(spark, "stream-test")


def run_counts(spark, base):
    few = own_session(spark, spark__sql__shuffle__partitions=2)
    decoded = messages.decode(read_recorded_topic(few, f"{base}/topic", files_per_batch=1))
    counted = counts.vendor_counts(decoded)
    runner.write_changes(counted, f"{base}/changes", f"{base}/checkpoint-changes")
    runner.write_current(counted, f"{base}/out", f"{base}/checkpoint", ["vendorId"])
    changes = spark.read.schema("vendorId int, rides bigint, batch_id int").parquet(f"{base}/changes")
    return changes, rows(runner.read_current(spark, f"{base}/out", counts.VENDOR_COUNTS))


def test_counts_over_batches_and_restarts(spark, base):
    assert rows(runner.read_current(spark, f"{base}/out", counts.VENDOR_COUNTS)) == []
    add_messages(spark, f"{base}/topic", [ride(1), ride(1), ride(2)])
    add_messages(spark, f"{base}/topic", [ride(1), "bad"])
    changes, got = run_counts(spark, base)
    assert got == [(1, 3), (2, 1)]
    assert changes.select("batch_id").distinct().count() == 2
    assert rows(changes.filter("batch_id = 1").select("vendorId", "rides")) == [(1, 3)], "only what changed"

    assert run_counts(spark, base)[1] == got, "nothing new"
    add_messages(spark, f"{base}/topic", [ride(2), ride(3)])
    assert run_counts(spark, base)[1] == [(1, 3), (2, 2), (3, 1)]
    for _ in range(3):
        add_messages(spark, f"{base}/topic", [ride(3)])
    assert run_counts(spark, base)[1] == [(1, 3), (2, 2), (3, 4)]
    assert len(glob.glob(f"{base}/out/snapshot-*")) == 2, "the current snapshot and the one before"


def test_a_repeated_batch_replaces_its_first_attempt(spark, base):
    add_messages(spark, f"{base}/topic", [ride(1), ride(2)])
    add_messages(spark, f"{base}/topic", [ride(1)])
    run_counts(spark, base)
    # As if the run had died after writing batch 1 and before committing it.
    for kind in ("checkpoint", "checkpoint-changes"):
        for file in glob.glob(f"{base}/{kind}/commits/1") + glob.glob(f"{base}/{kind}/commits/.1.crc"):
            os.remove(file)
    changes, got = run_counts(spark, base)
    assert got == [(1, 2), (2, 1)]
    assert changes.filter("batch_id = 1").count() == 1


def test_a_late_file_is_read(spark, base):
    add_messages(spark, f"{base}/topic", [ride(1)])
    assert run_counts(spark, base)[1] == [(1, 1)]
    before = set(folders(spark, f"{base}/topic/*.parquet"))
    add_messages(spark, f"{base}/topic", [ride(2)])
    for path in set(folders(spark, f"{base}/topic/*.parquet")) - before:
        set_age(spark, path, days=30)
    assert run_counts(spark, base)[1] == [(1, 1), (2, 1)]


def test_routed_files_are_written_once(spark, base):
    values = VALUES * 3
    add_messages(spark, f"{base}/topic", values)

    def run():
        decoded = messages.decode(read_recorded_topic(spark, f"{base}/topic"))
        routed = routing.route_by_amount(decoded)
        runner.append_to_files(routed, f"{base}/out", f"{base}/checkpoint", ["topic"])
        return spark.read.parquet(f"{base}/out").groupBy("topic").count()

    want = sorted([("yellow_taxi_rides.high_amount", 6), ("yellow_taxi_rides.low_amount", 6),
                   ("rejects", 3 * (len(VALUES) - GOOD))], key=str)
    assert rows(run()) == want
    assert rows(run()) == want
    add_messages(spark, f"{base}/topic", [ride(5, 99.0)])
    assert dict(rows(run()))["yellow_taxi_rides.high_amount"] == 7


def test_hot_vendor_is_counted_before_the_shuffle(spark):
    text = plan(counts.vendor_counts(messages.decode(envelope(spark, VALUES))))
    assert text.index("Exchange") < text.index("partial_count")


def test_recorded_rides_are_picked_by_position(spark):
    from fareflow.plans.streams import RECORDED

    values = [str(i) for i in range(17)]
    df = spark.createDataFrame([tuple(values)], RECORDED)
    row = messages.encode_recorded_rides(df).first()
    assert json.loads(row.key) == {"vendorId": 0}
    assert json.loads(row.value) == {
        "vendorId": 0, "passenger_count": 3, "trip_distance": 4.0, "payment_type": 9, "total_amount": 16.0,
    }


def test_counts_from_the_state(spark, base):
    def run():
        few = own_session(spark, spark__sql__shuffle__partitions=2)
        decoded = messages.decode(read_recorded_topic(few, f"{base}/topic", files_per_batch=1))
        runner.until_used_up(counts.vendor_counts(decoded), f"{base}/checkpoint", runner.discard)
        return rows(runner.read_state(spark, f"{base}/checkpoint", counts.VENDOR_COUNTS))

    assert rows(runner.read_state(spark, f"{base}/checkpoint", counts.VENDOR_COUNTS)) == []
    add_messages(spark, f"{base}/topic", [ride(1), ride(1), ride(2), "bad"])
    assert run() == [(1, 2), (2, 1)]
    for _ in range(2):
        add_messages(spark, f"{base}/topic", [ride(3), ride(1)])
    assert run() == [(1, 4), (2, 1), (3, 2)]
    assert run() == [(1, 4), (2, 1), (3, 2)], "nothing new"
    found = runner.read_state(spark, f"{base}/checkpoint", counts.VENDOR_COUNTS)
    assert found.schema.fieldNames() == counts.VENDOR_COUNTS.fieldNames()

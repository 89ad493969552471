"""Ride-stream jobs, each run over all messages until its source is used up."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.functions.money import exact_sum
from fareflow.plans import bindings as B
from fareflow.plans import sql as S
from fareflow.plans.registry import query
from fareflow.schemas import ENVELOPE, YELLOW, YELLOW_FEED
from fareflow.session import folders, new_folder, own_session, set_age
from fareflow.sources.topics import read_file_stream, read_recorded_topic
from fareflow.streaming import counts, messages, routing, runner
from fareflow.streaming.loader import load_feed_arrivals

# The state of a count is one number per vendor: a few parts hold it.
STATE_PARTITIONS = 8

# A recorded ride file has the yellow columns up to the amount, all read as text.
RECORDED = T.StructType([T.StructField(f.name, T.StringType()) for f in YELLOW][:17])


def _events(spark, sf_dir):
    # A glob, so that the table may be one file or a folder of files.
    return read_file_stream(spark, f"{sf_dir}/events.parquet*", B.EVENTS)


def _run(spark, stream, label, partition_by=()):
    """The stream's output once it is used up."""
    folder = new_folder(spark, label)
    runner.append_to_files(stream, f"{folder}/out", f"{folder}/checkpoint", partition_by)
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def _counting(spark):
    """A session whose streams keep their state in few parts."""
    return own_session(spark, spark__sql__shuffle__partitions=STATE_PARTITIONS)


def _decoded(spark, sf_dir):
    return messages.decode(B.ride_messages(_events(spark, sf_dir), clean=False))


def _plain(rides):
    return rides.withColumn("trip_distance", F.col("trip_distance").cast("double"))


_RIDE = "vendorId, passenger_count, trip_distance, payment_type, total_amount"
_KEY = """'{"vendorId":' || CAST(vendorId AS VARCHAR) || '}'"""


@query(S.with_(S.RIDES) + f"SELECT {_RIDE} FROM rides WHERE ok")
def stream_decode_json(spark, sf_dir):
    return _plain(_run(spark, messages.records(_decoded(spark, sf_dir)), "decode"))


@query(
    S.with_(S.RIDES)
    + f"""SELECT 'yellow_taxi_rides' AS topic, CAST(event_id % 4 AS INTEGER) AS "partition",
                 event_id // 4 AS "offset", {_KEY} AS key, vendorId, total_amount FROM rides"""
)
def stream_envelope(spark, sf_dir):
    stream = B.ride_messages(_events(spark, sf_dir))
    stored = _run(spark, stream, "envelope")
    record = F.from_json("value", messages.RIDE_MESSAGE)
    return stored.select("topic", "partition", "offset", "key", record.alias("r")).select(
        "topic", "partition", "offset", "key", "r.vendorId", "r.total_amount"
    )


@query(
    S.with_(S.RIDES)
    + f"""SELECT {_KEY} AS key, CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 4 AS "offset",
                 event_id % 100 = 0 AS not_json
          FROM rides WHERE NOT ok"""
)
def stream_rejects(spark, sf_dir):
    stored = _run(spark, messages.rejects(_decoded(spark, sf_dir)), "rejects")
    return stored.select(
        "key", "partition", "offset", (F.col("value") == "not json").alias("not_json")
    )


@query(
    S.with_(S.RIDES)
    + f"""SELECT CASE WHEN NOT ok THEN 'rejects'
                      WHEN total_amount >= 40.0 THEN 'yellow_taxi_rides.high_amount'
                      ELSE 'yellow_taxi_rides.low_amount' END AS topic,
                 {_KEY} AS key, count(*) AS rides,
                 CAST(sum(CASE WHEN ok THEN CAST(total_amount AS DECIMAL(18,2)) END) AS DOUBLE) AS amount
          FROM rides GROUP BY 1, 2"""
)
def stream_branch_amount(spark, sf_dir):
    routed = routing.route_by_amount(_decoded(spark, sf_dir))
    stored = _run(spark, routed, "branch", partition_by=["topic"])
    accepted = F.col("topic") != routing.AmountTopics().reject
    amount = F.when(accepted, F.from_json("value", messages.RIDE_MESSAGE)["total_amount"])
    return stored.groupBy("topic", "key").agg(
        F.count(F.lit(1)).alias("rides"), exact_sum(amount).alias("amount")
    )


_COUNTS = S.with_(S.RIDES) + "SELECT vendorId, count(*) AS rides FROM rides WHERE {} GROUP BY vendorId"


@query(_COUNTS.format("ok"))
def stream_vendor_counts(spark, sf_dir):
    folder = new_folder(spark, "counts")
    stream = counts.vendor_counts(_decoded(_counting(spark), sf_dir))
    runner.write_current(stream, f"{folder}/out", f"{folder}/checkpoint", ["vendorId"])
    return runner.read_current(spark, f"{folder}/out", counts.VENDOR_COUNTS)


@query(_COUNTS.format("true"))
def stream_restart(spark, sf_dir):
    """Messages arrive in two parts; the third run finds nothing new."""
    folder = new_folder(spark, "restart")
    topic = B.ride_messages(B.events(spark, sf_dir))
    odd = F.col("partition").isin(1, 3)
    for arrived in (topic.filter(odd), topic.filter(~odd), None):
        if arrived is not None:
            arrived.write.mode("append").parquet(f"{folder}/topic")
        decoded = messages.decode(read_recorded_topic(_counting(spark), f"{folder}/topic"))
        runner.write_current(
            counts.vendor_counts(decoded), f"{folder}/out", f"{folder}/checkpoint", ["vendorId"]
        )
    return runner.read_current(spark, f"{folder}/out", counts.VENDOR_COUNTS)


@query(_COUNTS.format("true"))
def stream_counts_from_state(spark, sf_dir):
    """The counts as the checkpoint holds them, after messages have arrived in two parts; no snapshot is written."""
    folder = new_folder(spark, "state")
    topic = B.ride_messages(B.events(spark, sf_dir))
    odd = F.col("partition").isin(1, 3)
    for arrived in (topic.filter(odd), topic.filter(~odd)):
        arrived.write.mode("append").parquet(f"{folder}/topic")
        decoded = messages.decode(read_recorded_topic(_counting(spark), f"{folder}/topic"))
        runner.until_used_up(counts.vendor_counts(decoded), f"{folder}/checkpoint", runner.discard)
    return runner.read_state(spark, f"{folder}/checkpoint", counts.VENDOR_COUNTS)


@query(
    S.with_(S.RIDES)
    + f"""SELECT CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 4 AS "offset" FROM rides"""
)
def stream_late_files(spark, sf_dir):
    """A file that is a year older than those already read arrives after them, and is read."""
    folder = new_folder(spark, "late")
    topic = B.ride_messages(B.events(spark, sf_dir))
    late = F.col("partition") == 2
    for arrived in (topic.filter(~late), topic.filter(late)):
        known = set(folders(spark, f"{folder}/topic/*.parquet"))
        arrived.write.mode("append").parquet(f"{folder}/topic")
        if known:
            for path in set(folders(spark, f"{folder}/topic/*.parquet")) - known:
                set_age(spark, path, days=365)
        runner.append_to_files(
            read_recorded_topic(spark, f"{folder}/topic"), f"{folder}/out", f"{folder}/checkpoint"
        )
    return spark.read.schema(ENVELOPE).parquet(f"{folder}/out").select("partition", "offset")


@query(
    """SELECT CAST(value AS VARCHAR) AS amount, 'Bitcoin price: ' || CAST(value AS VARCHAR) AS line,
              CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS price FROM events"""
)
def stream_price_extract(spark, sf_dir):
    stored = _run(spark, messages.prices(B.price_messages(_events(spark, sf_dir))), "prices")
    return stored.withColumn("price", F.col("price").cast("double"))


@query(S.with_(S.RIDES) + f"SELECT {_KEY} AS key, {_RIDE} FROM rides")
def stream_encode_keyed(spark, sf_dir):
    folder = new_folder(spark, "recorded")
    _, ride = B.ride_columns()
    filled = {name: F.col("value").cast("string") for name in RECORDED.fieldNames()}
    for name, position in messages.RIDE_POSITIONS.items():
        filled[RECORDED.fieldNames()[position]] = ride[name].cast("string")
    B.events(spark, sf_dir).select(*[c.alias(n) for n, c in filled.items()]).write.option(
        "header", True
    ).csv(f"{folder}/rides")
    recorded = read_file_stream(spark, f"{folder}/rides", RECORDED, kind="csv", header=True)
    stored = _run(spark, messages.encode_recorded_rides(recorded), "encoded")
    record = F.from_json("value", messages.RIDE_MESSAGE)
    return _plain(stored.select("key", record.alias("r")).select("key", "r.*"))


@query(
    S.with_(S.TRIPS)
    + f"""SELECT CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month,
                 count(*) AS trips, {S.money('fare_amount')} AS fares, CAST(sum(payment_type) AS BIGINT) AS payments
          FROM trips WHERE service_type = 'yellow' GROUP BY 1, 2"""
)
def load_arrivals(spark, sf_dir):
    """Yellow trips in files that arrive twice, in two types, one of them late; then nothing comes."""
    folder = new_folder(spark, "arrivals")
    columns = ("VendorID", "pickup_datetime", "passenger_count", "trip_distance", "fare_amount", "payment_type")
    trips = B.yellow_feed(spark, sf_dir, *columns)
    vendor = F.col("VendorID") % 3
    first, second, late = (trips.filter(vendor == i) for i in range(3))
    second = second.withColumn("payment_type", F.col("payment_type").cast("int"))
    second = second.withColumn("passenger_count", F.col("passenger_count").cast("long"))
    for arrived, days in ((first, 0), (second, 0), (late, 365), (None, 0)):
        known = set(folders(spark, f"{folder}/raw/*.parquet"))
        if arrived is not None:
            arrived.write.mode("append").parquet(f"{folder}/raw")
        for path in set(folders(spark, f"{folder}/raw/*.parquet")) - known if days else ():
            set_age(spark, path, days=days)
        load_feed_arrivals(spark, YELLOW_FEED, f"{folder}/raw", f"{folder}/out", f"{folder}/checkpoint")
    loaded = spark.read.parquet(f"{folder}/out")
    return loaded.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("trips"), exact_sum("fare_amount").alias("fares"), F.sum("payment_type").alias("payments")
    )

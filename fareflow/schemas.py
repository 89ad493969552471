"""Row shapes of the feeds, tables and messages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Feed times are wall-clock times without a zone.
TIMESTAMP = T.TimestampNTZType()


def fields(**columns: str) -> T.StructType:
    """A schema of nullable fields from names and Spark's type names."""
    schema = T.StructType()
    for name, kind in columns.items():
        schema.add(name, kind)
    return schema


# Column names, order and types of the public trip feeds.
GREEN = fields(
    VendorID="long", lpep_pickup_datetime="timestamp_ntz", lpep_dropoff_datetime="timestamp_ntz",
    store_and_fwd_flag="string", RatecodeID="double", PULocationID="long", DOLocationID="long",
    passenger_count="double", trip_distance="double", fare_amount="double", extra="double",
    mta_tax="double", tip_amount="double", tolls_amount="double", improvement_surcharge="double",
    total_amount="double", payment_type="double", trip_type="double",
    congestion_surcharge="double",
)

YELLOW = fields(
    VendorID="long", tpep_pickup_datetime="timestamp_ntz", tpep_dropoff_datetime="timestamp_ntz",
    passenger_count="double", trip_distance="double", RatecodeID="double",
    store_and_fwd_flag="string", PULocationID="long", DOLocationID="long", payment_type="long",
    fare_amount="double", extra="double", mta_tax="double", tip_amount="double",
    tolls_amount="double", improvement_surcharge="double", total_amount="double",
    congestion_surcharge="double", airport_fee="double",
)

HIGH_VOLUME = fields(
    hvfhs_license_num="string", dispatching_base_num="string", originating_base_num="string",
    request_datetime="timestamp_ntz", on_scene_datetime="timestamp_ntz",
    pickup_datetime="timestamp_ntz", dropoff_datetime="timestamp_ntz", PULocationID="long",
    DOLocationID="long", trip_miles="double", trip_time="long", base_passenger_fare="double",
    tolls="double", bcf="double", sales_tax="double", congestion_surcharge="double",
    airport_fee="double", tips="double", driver_pay="double", shared_request_flag="string",
    shared_match_flag="string", access_a_ride_flag="string", wav_request_flag="string",
    wav_match_flag="string",
)

FOR_HIRE = fields(
    dispatching_base_num="string", pickup_datetime="timestamp_ntz",
    dropoff_datetime="timestamp_ntz", PULocationID="integer", DOLocationID="integer",
    SR_Flag="string", Affiliated_base_number="string",
)

ZONES = fields(LocationID="long", Borough="string", Zone="string")

# Positional names of a trade payload record and the columns a trade table keeps.
TRADE_PAYLOAD = (
    "year", "month", "destination_country", "trade_bloc", "origin_city", "origin_state",
    "section_cd", "section_ds", "fob", "net_weight",
)
TRADE = fields(
    year="integer", month="integer", destination_country="string", origin_city="string",
    origin_state="string", section_cd="string", section_ds="string", fob="long", net_weight="long",
)

# Message shapes of the streams.
RIDE_KEY = fields(vendorId="integer")
RIDE = fields(
    vendorId="integer", passenger_count="integer", trip_distance="float", payment_type="integer",
    total_amount="float",
)
PRICE = T.StructType([T.StructField("data", fields(amount="string"), True)])
COUNTER = fields(number="integer")
ENVELOPE = fields(
    key="string", value="string", topic="string", partition="integer", offset="long",
)

# The 18 columns green and yellow trips share, and the report measures over them.
SHARED_COLUMNS = (
    "VendorID", "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag", "RatecodeID",
    "PULocationID", "DOLocationID", "passenger_count", "trip_distance", "fare_amount", "extra",
    "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
    "payment_type", "congestion_surcharge",
)
REVENUE_MEASURES = {
    "fare_amount": "revenue_monthly_fare",
    "extra": "revenue_monthly_extra",
    "mta_tax": "revenue_monthly_mta_tax",
    "tip_amount": "revenue_monthly_tip_amount",
    "tolls_amount": "revenue_monthly_tolls_amount",
    "improvement_surcharge": "revenue_monthly_improvement_surcharge",
    "total_amount": "revenue_monthly_total_amount",
    "congestion_surcharge": "revenue_monthly_congestion_surcharge",
}
AVERAGE_MEASURES = {
    "passenger_count": "avg_montly_passenger_count",
    "trip_distance": "avg_montly_trip_distance",
}


@dataclass(frozen=True)
class FeedSpec:
    """What differs from feed to feed: its service name, time columns and schema."""

    service: str
    pickup: str
    dropoff: str
    schema: T.StructType


GREEN_FEED = FeedSpec("green", "lpep_pickup_datetime", "lpep_dropoff_datetime", GREEN)
YELLOW_FEED = FeedSpec("yellow", "tpep_pickup_datetime", "tpep_dropoff_datetime", YELLOW)
FOR_HIRE_FEED = FeedSpec("fhv", "pickup_datetime", "dropoff_datetime", FOR_HIRE)
HIGH_VOLUME_FEED = FeedSpec("hvfhv", "pickup_datetime", "dropoff_datetime", HIGH_VOLUME)

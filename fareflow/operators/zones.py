"""Joins with the zone lookup.

No join here is hinted: Spark broadcasts the lookup where its statistics put it below the
broadcast threshold and joins by shuffle beyond that. Facts are grouped by zone id before names
are joined wherever the result allows, so the join sees one row per id, however hot a zone is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PICKUP, DROPOFF = "PULocationID", "DOLocationID"


def with_zone_name(
    df: DataFrame, zones: DataFrame, key: str, name: str, how: str = "left"
) -> DataFrame:
    """Adds the zone name of the id in ``key`` as ``name``."""
    lookup = zones.select(
        F.col("LocationID").alias("_zone_id"), F.col("Zone").alias(name)
    )
    return df.join(lookup, F.col(key) == F.col("_zone_id"), how).drop("_zone_id")


def revenue_by_zone_named(revenue: DataFrame, zones: DataFrame) -> DataFrame:
    """Revenue rows of known zones, with the lookup's columns in place of the ids.

    Dropped by reference: by name, case-blind matching would drop the lookup's ``Zone`` as well.
    """
    named = revenue.join(zones, revenue["zone"] == zones["LocationID"])
    return named.drop(revenue["zone"], zones["LocationID"])


def trips_per_zone(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips by pickup zone name, most first; trips of unknown zones are left out."""
    per_id = trips.groupBy(PICKUP).agg(F.count(F.lit(1)).alias("n"))
    return (
        with_zone_name(per_id, zones, PICKUP, "Zone", how="inner")
        .groupBy("Zone")
        .agg(F.sum("n").alias("trips"))
        .orderBy(F.desc("trips"), "Zone")
    )


def top_zone_pairs(
    trips: DataFrame, zones: DataFrame, n: int = 5, unknown: str = "Unknown"
) -> DataFrame:
    """The most common ``pickup / dropoff`` names."""
    per_pair = trips.groupBy(PICKUP, DROPOFF).agg(F.count(F.lit(1)).alias("n"))
    named = with_zone_name(per_pair, zones, PICKUP, "pickup_zone")
    named = with_zone_name(named, zones, DROPOFF, "dropoff_zone")
    label = F.concat(
        F.coalesce("pickup_zone", F.lit(unknown)),
        F.lit(" / "),
        F.coalesce("dropoff_zone", F.lit(unknown)),
    )
    return (
        named.groupBy(label.alias("pickup_dropoff"))
        .agg(F.sum("n").alias("trips"))
        .orderBy(F.desc("trips"), "pickup_dropoff")
        .limit(n)
    )


def max_tip_from_zone(trips: DataFrame, zones: DataFrame, pickup_zone: str) -> DataFrame:
    """Largest tip by dropoff zone name over trips picked up in a zone; the name may be missing."""
    start = zones.filter(F.col("Zone") == pickup_zone)
    per_id = (
        with_zone_name(trips, start, PICKUP, "pickup_zone", how="inner")
        .groupBy(DROPOFF)
        .agg(F.max("tip_amount").alias("tip"))
    )
    return (
        with_zone_name(per_id, zones, DROPOFF, "dropoff_zone")
        .groupBy("dropoff_zone")
        .agg(F.max("tip").alias("max_tip_amount"))
        .orderBy(F.desc("max_tip_amount"), "dropoff_zone")
    )


def known_zone_trips(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips whose pickup and dropoff zones are both known, with the names added."""
    named = with_zone_name(trips, zones, PICKUP, "pickup_zone", how="inner")
    return with_zone_name(named, zones, DROPOFF, "dropoff_zone", how="inner")

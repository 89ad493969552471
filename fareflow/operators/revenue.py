"""Revenue reports by zone and time."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.functions.moments import hour_start, month_start
from fareflow.functions.money import exact_avg, exact_sum
from fareflow.schemas import AVERAGE_MEASURES, REVENUE_MEASURES


def monthly_revenue(
    trips: DataFrame,
    sums: Mapping[str, str] = REVENUE_MEASURES,
    averages: Mapping[str, str] = AVERAGE_MEASURES,
) -> DataFrame:
    """Sums and averages by pickup zone, month and service; maps give column -> result name."""
    return trips.groupBy(
        F.col("PULocationID").alias("revenue_zone"),
        month_start("pickup_datetime").alias("revenue_month"),
        "service_type",
    ).agg(
        *[exact_sum(column).alias(name) for column, name in sums.items()],
        *[exact_avg(column).alias(name) for column, name in averages.items()],
    )


def hourly_revenue(trips: DataFrame, pickup: str, since: str) -> DataFrame:
    """Amount and number of trips by pickup hour and zone, from a moment on."""
    recent = trips.filter(F.col(pickup) >= F.lit(since).cast("timestamp_ntz"))
    return recent.groupBy(
        hour_start(pickup).alias("hour"), F.col("PULocationID").alias("zone")
    ).agg(
        exact_sum("total_amount").alias("amount"),
        F.count(F.lit(1)).alias("number_records"),
    )


def combine_feeds(green: DataFrame, yellow: DataFrame) -> DataFrame:
    """Hourly revenue of both feeds side by side; an hour and zone may have only one of them.

    Both sides come grouped by the join keys, so the join needs no further shuffle. Rows without
    a zone match nothing and stay apart.
    """
    def prefixed(df: DataFrame, service: str) -> DataFrame:
        return df.withColumnsRenamed(
            {"amount": f"{service}_amount", "number_records": f"{service}_number_records"}
        )

    return prefixed(green, "green").join(
        prefixed(yellow, "yellow"), on=["hour", "zone"], how="outer"
    )

"""Running counts by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.schemas import fields


def vendor_counts(decoded: DataFrame) -> DataFrame:
    """Rides per vendor so far. State holds one number per vendor.

    Spark counts inside each task before it shuffles by vendor, so a vendor with most of the
    rides sends one row per task, not its rides.
    """
    return (
        decoded.filter("valid")
        .groupBy(F.col("record.vendorId").alias("vendorId"))
        .agg(F.count(F.lit(1)).alias("rides"))
    )


#: The rows of :func:`vendor_counts`.
VENDOR_COUNTS = fields(vendorId="integer", rides="long")

"""Trip feeds with their own column names made one table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.schemas import SHARED_COLUMNS, FeedSpec


def unify_feed(df: DataFrame, feed: FeedSpec, columns: Sequence[str] = SHARED_COLUMNS) -> DataFrame:
    """The shared columns of one feed under common time names, tagged with its service."""
    renamed = df.withColumnsRenamed(
        {feed.pickup: "pickup_datetime", feed.dropoff: "dropoff_datetime"}
    )
    return renamed.select(*columns).withColumn("service_type", F.lit(feed.service))


def union_feeds(
    feeds: Sequence[tuple[DataFrame, FeedSpec]], columns: Sequence[str] = SHARED_COLUMNS
) -> DataFrame:
    """All rows of all feeds. A column that is long in one feed and double in another is double."""
    unified = [unify_feed(df, feed, columns) for df, feed in feeds]
    return reduce(DataFrame.unionByName, unified)

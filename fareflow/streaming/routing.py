"""Messages sent on by what they say."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class AmountTopics:
    """Where rides go. Fixed value: the limit, in currency units."""

    limit: float = 40.0
    high: str = "yellow_taxi_rides.high_amount"
    low: str = "yellow_taxi_rides.low_amount"
    reject: str = "rejects"


def route_by_amount(decoded: DataFrame, topics: AmountTopics = AmountTopics()) -> DataFrame:
    """Key and value unchanged under the topic their amount belongs to, invalid ones to ``reject``.

    The topic is a column: a broker sink sends each row to the topic it names, a file sink writes
    one folder per topic. One pass over the stream feeds all topics, and one commit covers them.
    """
    topic = (
        F.when(~F.col("valid"), F.lit(topics.reject))
        .when(F.col("record.total_amount") >= topics.limit, F.lit(topics.high))
        .otherwise(F.lit(topics.low))
    )
    return decoded.select("key", "value", topic.alias("topic"))

"""Topics as streaming DataFrames of (key, value, topic, partition, offset)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fareflow.schemas import ENVELOPE

#: A file age that none reaches.
NEVER = "36500d"
ENVELOPE_COLUMNS = tuple(ENVELOPE.fieldNames())


def read_broker_topic(
    spark: SparkSession, servers: str, topic: str, start: str = "earliest", **options
) -> DataFrame:
    """A broker topic from its ``earliest`` or ``latest`` offset; needs Spark's Kafka connector."""
    messages = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", start)
        .options(**options)
        .load()
    )
    return messages.selectExpr(
        "CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value", "topic", "partition", "offset"
    )


def read_file_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    kind: str = "parquet",
    pattern: str | None = None,
    files_per_batch: int = 1000,
    max_file_age: str = NEVER,
    **options,
) -> DataFrame:
    """New files of a folder as a stream, oldest first.

    Spark leaves out files that are older than the newest one by more than ``max_file_age``, and
    forgets which files it has read after that time. By default it never does either, so a late file is
    read; what a stream remembers then grows by a line per file, which Spark compacts.
    """
    reader = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", max_file_age)
        .options(**options)
    )
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.format(kind).load(folder)


def read_recorded_topic(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """A topic kept as Parquet files of whole messages, from its beginning."""
    return read_file_stream(spark, folder, ENVELOPE, files_per_batch=files_per_batch)

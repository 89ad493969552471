"""Streams run until their source is used up, each from its own checkpoint.

Run again on the same checkpoint, a stream goes on where it stopped: messages already handled
are not handled again, and a batch cut short is written anew in place of its first attempt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.session import folders, remove_folder


def append_to_files(
    stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> None:
    """Every row of the stream once, as Parquet; ``partition_by`` makes one folder per value."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.start(path).awaitTermination()


def append_to_broker(stream: DataFrame, servers: str, checkpoint: str, **options):
    """Rows of (key, value, topic) to a broker, until stopped; needs Spark's Kafka connector."""
    return (
        stream.writeStream.format("kafka")
        .outputMode("append")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
        .options(**options)
        .start()
    )


def write_changes(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Each batch's changed rows of a running aggregate, in a folder per batch.

    A repeated batch replaces its folder. The state is kept in as many parts as the stream's session has
    shuffle partitions; the first run on a checkpoint fixes it.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    until_used_up(stream, checkpoint, write)


def until_used_up(stream: DataFrame, checkpoint: str, write, mode: str = "update") -> None:
    """``write(batch, batch_id)`` for every batch until nothing is left."""
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()


def write_current(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str]) -> None:
    """The current rows of a running aggregate whose numbers only grow, as one snapshot folder.

    Each batch merges its changes into the snapshot before it and writes the next; the one before
    stays until then, so a batch that is repeated starts from the same rows. Older ones go.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = [i for i in _snapshots(spark, path) if i < batch_id]
        rows = batch
        if before:
            rows = batch.unionByName(spark.read.schema(batch.schema).parquet(f"{path}/{_SNAPSHOT}{before[-1]}"))
        numbers = [F.max(c).alias(c) for c in batch.columns if c not in keys]
        rows.groupBy(*keys).agg(*numbers).write.mode("overwrite").parquet(f"{path}/{_SNAPSHOT}{batch_id}")
        for old in before[:-1]:
            remove_folder(spark, f"{path}/{_SNAPSHOT}{old}")

    until_used_up(stream, checkpoint, write)


_SNAPSHOT = "snapshot-"


def _snapshots(spark: SparkSession, path: str) -> list[int]:
    """The batches whose snapshots are complete, in order."""
    done = folders(spark, f"{path}/{_SNAPSHOT}*/_SUCCESS")
    return sorted(int(file.split("/")[-2].removeprefix(_SNAPSHOT)) for file in done)


def read_current(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The last snapshot of :func:`write_current`; no rows before the first."""
    found = _snapshots(spark, path)
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{_SNAPSHOT}{found[-1]}")


def discard(batch: DataFrame, batch_id: int) -> None:
    """Computes a batch and keeps only its state."""
    batch.write.format("noop").mode("overwrite").save()


def read_state(spark: SparkSession, checkpoint: str, schema: T.StructType) -> DataFrame:
    """The rows of a running aggregate as its checkpoint holds them, after the last batch that is done.

    The state has the group's columns as key and the aggregates in their order as value; ``schema`` names
    both. No rows before the first batch. Nothing but the checkpoint is read, and nothing need be written for it.
    """
    if not folders(spark, f"{checkpoint}/commits/[0-9]*"):
        return spark.createDataFrame([], schema)
    state = spark.read.format("statestore").option("path", checkpoint).load()
    return state.select("key.*", "value.*").toDF(*schema.fieldNames())

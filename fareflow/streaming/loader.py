"""Files loaded as they arrive, each once.

A file stream keeps account of the files it has seen; only their paths go through it. The files of a
batch are then read as any others, so months of differing types are no matter, and written as one
load: a batch that was cut short is the same load when it is repeated, and replaces what it had written.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.schemas import FeedSpec
from fareflow.sinks.files import write_load
from fareflow.sources.files import read_feed
from fareflow.sources.topics import read_file_stream
from fareflow.streaming.runner import until_used_up

#: Fixed value: the columns of a file read as a whole. Only the path is asked for, so nothing else is read.
WHOLE_FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)
#: Files of a batch at most: their paths come to the driver.
FILES_PER_BATCH = 1000


def each_arrival(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    handle: Callable[[list[str], int], None],
    pattern: str | None = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Calls ``handle`` with the paths of new files and the number of their batch, until all are handled.

    A file is new if its path is; how old it is does not matter. If a call fails, the next run repeats
    it with the same paths and number.
    """
    files = read_file_stream(spark, folder, WHOLE_FILE, "binaryFile", pattern, files_per_batch)

    def write(batch: DataFrame, batch_id: int) -> None:
        paths = sorted(row["path"] for row in batch.distinct().collect())
        if paths:
            handle(paths, batch_id)

    until_used_up(files.select("path"), checkpoint, write, "append")


def load_feed_arrivals(
    spark: SparkSession,
    feed: FeedSpec,
    folder: str,
    path: str,
    checkpoint: str,
    by: Sequence[str] = ("year", "month"),
    name: str = "arrivals",
    pattern: str | None = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """New files of a feed into a table of loads, by year and month of pickup; a batch is a load.

    ``name`` tells the loads of several loaders apart; each needs a checkpoint of its own.
    """

    def handle(paths: list[str], number: int) -> None:
        trips = read_feed(spark, paths, feed).withColumns({"year": F.year(feed.pickup), "month": F.month(feed.pickup)})
        write_load(trips, path, by, f"{name}-{number:09d}")

    each_arrival(spark, folder, checkpoint, handle, pattern, files_per_batch)

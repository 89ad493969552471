"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


# A shuffle partition of this size is sorted in the memory of one task.
PARTITION_BYTES = 128 * 1024**2


# Partitions a shuffle starts with where nothing else is known: 250 GB at the size above. Of more than
# 2000, tasks report an average size, and adaptive execution cannot see a hot one.
INITIAL_PARTITIONS = 2000


def shuffle_partitions(shuffle_bytes: int, at_least: int = 200) -> int:
    """How many partitions keep a shuffle of this many bytes in task memory."""
    return max(at_least, -(-shuffle_bytes // PARTITION_BYTES))


def build_session(
    app: str = "fareflow", master: str | None = None, shuffle_bytes: int | None = None, **conf
) -> SparkSession:
    """A session with the settings the jobs are written for.

    Adaptive execution merges small shuffle partitions and splits skewed joins and rebalanced
    writes, but it does not add partitions to an evenly large shuffle: ``shuffle_bytes``, the size
    of the largest one, sets how many there are to begin with. ``conf`` overrides any setting
    (dots written as ``__``).
    """
    settings = {
        # So that hot partitions are reported as such also where there are more than 2000.
        "spark.shuffle.accurateBlockSkewedFactor": "5",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
    }
    if shuffle_bytes:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(shuffle_bytes))
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    if "spark.sql.shuffle.partitions" not in settings and SparkSession.getActiveSession() is None:
        # Many small partitions to begin with; adaptive execution merges them to its target size.
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(INITIAL_PARTITIONS)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without it; it then gets a temporary folder of its own.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="fareflow-")
    spark.conf.set(CHECKPOINT_KEY, folder)
    return folder


#: What has been made in each workspace that is open, the innermost last.
_open: list[list[tuple[str, str]]] = []


def _made(kind: str, name: str) -> str:
    if _open:
        _open[-1].append((kind, name))
    return name


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return _made("folder", f"{shared_folder(spark)}/fareflow/{label}-{uuid.uuid4().hex}")


def new_table(label: str) -> str:
    """A table or view name that no other run uses."""
    return _made("table", f"ff_{label}_{uuid.uuid4().hex[:12]}")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of any store Spark reads; a missing one is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a glob finds on any store Spark reads, sorted."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target) or []
    return sorted(status.getPath().toString() for status in found)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file on any store Spark reads; it is there whole or not at all."""
    target, part = (spark._jvm.org.apache.hadoop.fs.Path(x) for x in (path, f"{path}.part"))
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = store.create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not store.rename(part, target):
        raise OSError(f"{path} cannot be written")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file of any store Spark reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def set_age(spark: SparkSession, path: str, days: int) -> None:
    """Gives a file a modification time that long ago, as one that was copied late has."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    modified = int(time.time() - days * 86_400) * 1000
    target.getFileSystem(spark._jsc.hadoopConfiguration()).setTimes(target, modified, -1)


def own_session(spark: SparkSession, **settings) -> SparkSession:
    """A session beside this one, with the same catalog and settings of its own (dots as ``__``)."""
    own = spark.newSession()
    for key, value in settings.items():
        own.conf.set(key.replace("__", "."), str(value))
    return own


@contextmanager
def workspace(spark: SparkSession) -> Iterator[None]:
    """Removes the folders, tables and views made inside when the block ends.

    Results that are read lazily must have been read by then.
    """
    made: list[tuple[str, str]] = []
    _open.append(made)
    try:
        yield
    finally:
        _open.remove(made)
        for kind, name in reversed(made):
            if kind == "folder":
                remove_folder(spark, name)
            else:
                spark.catalog.dropTempView(name)
                spark.sql(f"DROP TABLE IF EXISTS {name}")

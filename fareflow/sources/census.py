"""The schemas of many Parquet files, found by tasks.

Paths are dealt to tasks, each of which reads the footers of its files; digests of the schemas are then
grouped, so the driver gets one row for each different schema, however many files there are. Spark
itself is asked for the types of one file of each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Files whose footers a task reads.
FILES_A_TASK = 256
FOOTER_THREADS = 16
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
FOUND = "path string, digest string"

#: Types that a Parquet scan reads as a wider one without loss.
WIDER = {
    "tinyint": ("smallint", "int", "bigint", "double"),
    "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
}


@dataclass(frozen=True)
class Kind:
    """Files of one schema: how many there are, one of them, and what Spark reads it as."""

    digest: str
    files: int
    example: str
    schema: T.StructType


def file_uri(path: str) -> str:
    """A path as Spark writes it, nothing escaped and ``file:/a`` for a local one, as a URI."""
    scheme, colon, rest = path.partition(":/")
    if not colon:
        return quote(path)
    return f"{scheme}://{'' if rest.startswith('/') else '/'}{quote(rest.removeprefix('/'), safe='/:@')}"


def footer_digest(path: str) -> str:
    """A digest of a file's columns and types, and of those Spark noted when it wrote the file."""
    store, name = fs.FileSystem.from_uri(file_uri(path))
    with store.open_input_file(name) as file:
        parquet = pq.ParquetFile(file)
        # The first line names the object.
        text = str(parquet.schema).partition("\n")[2]
        noted = (parquet.metadata.metadata or {}).get(SPARK_SCHEMA, b"")
    return hashlib.sha256(text.encode() + b"\n" + noted).hexdigest()


def listed(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """path of every file behind some paths. Nothing of the files is read."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return reader.load(paths).select("path").distinct()


def footers(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """path, digest of every file behind some paths.

    Tasks open the files themselves. A store that only Spark can open is left to threads of the driver.
    """
    found = listed(spark, paths)
    first = found.first()
    if first is None:
        return spark.createDataFrame([], FOUND)
    try:
        fs.FileSystem.from_uri(file_uri(first["path"]))
    except pa.ArrowInvalid:
        return _by_driver(spark, [row["path"] for row in found.toLocalIterator()])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = batch.column("path").to_pylist()
            with ThreadPoolExecutor(FOOTER_THREADS) as threads:
                digests = list(threads.map(footer_digest, each))
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(digests, pa.string())], ["path", "digest"])

    n = found.count()
    return found.repartition(-(-n // FILES_A_TASK)).mapInArrow(run, FOUND)


def _by_driver(spark: SparkSession, paths: list[str]) -> DataFrame:
    with ThreadPoolExecutor(FOOTER_THREADS) as threads:
        schemas = list(threads.map(lambda path: spark.read.parquet(path).schema.json(), paths))
    digests = [hashlib.sha256(schema.encode()).hexdigest() for schema in schemas]
    return spark.createDataFrame(list(zip(paths, digests)), FOUND)


def census(spark: SparkSession, found: DataFrame) -> list[Kind]:
    """The different schemas of :func:`footers`, the most frequent first."""
    counted = found.groupBy("digest").agg(F.count(F.lit(1)).alias("files"), F.min("path").alias("example"))
    kinds = [Kind(*row, spark.read.parquet(row["example"]).schema) for row in counted.collect()]
    return sorted(kinds, key=lambda k: (-k.files, k.digest))


def wider(a: str, b: str) -> str | None:
    """The type as which a scan reads both without loss, if there is one."""
    if a == b or b in WIDER.get(a, ()):
        return b
    if a in WIDER.get(b, ()):
        return a
    common = [t for t in WIDER.get(a, ()) if t in WIDER.get(b, ())]
    return common[0] if common else None


def merged(a: T.StructType, b: T.StructType) -> T.StructType | None:
    """The schema under which one scan reads files of both, null where a column is missing; or None."""
    fields = {f.name.lower(): f for f in a}
    for field in b:
        known = fields.get(field.name.lower())
        if known is None:
            fields[field.name.lower()] = field
        elif known.dataType != field.dataType:
            kind = wider(known.dataType.simpleString(), field.dataType.simpleString())
            if kind is None:
                return None
            fields[field.name.lower()] = T.StructField(known.name, T._parse_datatype_string(kind))
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields.values()])


def scans(kinds: Iterable[Kind]) -> list[tuple[T.StructType, list[Kind]]]:
    """The kinds that can be read together, with the schema for each such scan."""
    out: list[tuple[T.StructType, list[Kind]]] = []
    for kind in kinds:
        for at, (schema, members) in enumerate(out):
            if (both := merged(schema, kind.schema)) is not None:
                out[at] = (both, [*members, kind])
                break
        else:
            out.append((kind.schema, [kind]))
    return out


def places(found: DataFrame, groups: Sequence[Sequence[str]]) -> list[list[str]]:
    """What to read for each group of digests: folders that hold files of that group only, else files.

    A row for each folder comes to the driver, and one for each file of a folder that holds several groups.
    """
    spark = found.sparkSession
    numbers = spark.createDataFrame([(d, i) for i, group in enumerate(groups) for d in group], "digest string, of int")
    dealt = found.join(F.broadcast(numbers), "digest").withColumn("folder", F.regexp_replace("path", "/[^/]*$", ""))
    folders = dealt.groupBy("folder").agg(F.min("of").alias("least"), F.max("of").alias("most")).collect()
    pure = {row["folder"]: row["least"] for row in folders if row["least"] == row["most"]}
    # A folder above another would be read with it.
    above = {"/".join(row["folder"].split("/")[:n]) for row in folders for n in range(1, row["folder"].count("/") + 1)}
    pure = {folder: group for folder, group in pure.items() if folder not in above}
    out: list[list[str]] = [[] for _ in groups]
    for folder, group in pure.items():
        out[group].append(folder)
    if len(pure) < len(folders):
        alone = [row["folder"] for row in folders if row["folder"] not in pure]
        rest = dealt.join(F.broadcast(spark.createDataFrame([(x,) for x in alone], "folder string")), "folder")
        for row in rest.select("path", "of").toLocalIterator():
            out[row["of"]].append(row["path"])
    return [sorted(x) for x in out]

"""Which folders each load of a table holds, in small files beside them.

``<table>/_loads/<load>/<attempt>.json`` lists the folders of a load, a line each with load, attempt and
folder; readers of the table do not see it, as its name begins with an underscore. A load says that it
has begun (``<attempt>.open``) before it writes, and lists its folders when it is done. So a load that is run again
knows the folders of the last time without looking through the table, and if the last time was cut short, that it has to look.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fareflow.session import folders, read_text, remove_folder, write_text

#: The partition column that says which load wrote a row.
LOAD = "load"
MANIFEST = "_loads"
ROWS = T.StructType([T.StructField(x, T.StringType()) for x in ("load", "attempt", "folder")])

# The folder name of rows without a partition value, and what is escaped in folder names.
EMPTY = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = {*map(chr, range(1, 32)), *"\"#%'*/:=?\\{[]^", "\x7f"}


def folder_name(values: Mapping[str, str | None]) -> str:
    """The partition folder of some values, in the order of the columns: ``year=2019/month=1``."""
    return "/".join(f"{_escaped(column)}={_escaped(value or EMPTY)}" for column, value in values.items())


def _escaped(text: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in text)


@dataclass(frozen=True)
class Change:
    """The folders of a load before and after it was run again, relative to the table."""

    before: frozenset[str]
    after: frozenset[str]

    @property
    def added(self) -> list[str]:
        return sorted(self.after - self.before)

    @property
    def removed(self) -> list[str]:
        return sorted(self.before - self.after)


class Manifest:
    """The entries of one load of a table."""

    def __init__(self, spark: SparkSession, path: str, load: str):
        self.spark, self.path, self.load = spark, path, load
        self.folder = f"{path}/{MANIFEST}/{quote(load, safe='')}"
        self.attempt = uuid.uuid4().hex

    def begin(self, depth: int) -> frozenset[str]:
        """Says that the load has begun; the folders it holds now.

        They stand in the list of the last run. Only if a run was cut short the table's folders, ``depth``
        columns above those of the loads, are searched for this load's.
        """
        known: set[str] = set()
        for entry in folders(self.spark, f"{glob_safe(self.folder)}/*.json"):
            known |= {json.loads(line)["folder"] for line in read_text(self.spark, entry).splitlines()}
        if folders(self.spark, f"{glob_safe(self.folder)}/*.open"):
            own = folder_name({LOAD: self.load})
            pattern = "/".join([glob_safe(self.path), *["*"] * depth, glob_safe(own)])
            known |= {"/".join(found.split("/")[-1 - depth :]) for found in folders(self.spark, pattern)}
        write_text(self.spark, f"{self.folder}/{self.attempt}.open", "")
        return frozenset(known)

    def end(self, held: Iterable[str]) -> None:
        """Lists the folders that the load holds from now on, in place of all earlier lists and marks."""
        done = f"{self.folder}/{self.attempt}.json"
        lines = [json.dumps({"load": self.load, "attempt": self.attempt, "folder": x}) for x in sorted(held)]
        write_text(self.spark, done, "".join(f"{line}\n" for line in lines))
        for entry in folders(self.spark, f"{glob_safe(self.folder)}/*"):
            if not entry.endswith(f"{self.attempt}.json"):
                remove_folder(self.spark, entry)


def glob_safe(path: str) -> str:
    """A path as a pattern that finds just itself."""
    return "".join(f"\\{c}" if c in "*?[]{}\\" else c for c in path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """load, attempt, folder: every folder of a table that a finished load holds."""
    if not folders(spark, f"{glob_safe(path)}/{MANIFEST}/*/*.json"):
        return spark.createDataFrame([], ROWS)
    return spark.read.schema(ROWS).json(f"{glob_safe(path)}/{MANIFEST}/*/*.json")

"""A revenue report kept up to date by loads: each load's partial sums are stored, and only months that a
load touches are computed anew, from the partial sums of all loads. Trips are read once, by their own load.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.functions.moments import month_date
from fareflow.functions.money import merged_avg, merged_sum, partial_sums
from fareflow.schemas import AVERAGE_MEASURES, REVENUE_MEASURES
from fareflow.session import folders, read_text, remove_folder, write_text
from fareflow.sinks.files import spread_for, write_load
from fareflow.sinks.manifest import LOAD, glob_safe, read_manifest

MONTH = "month"
KEYS = ("revenue_zone", MONTH, "service_type")
PENDING = "_pending"


@dataclass(frozen=True)
class KeptReport:
    """Where partial sums and report are, and what the report sums and averages (column -> result)."""

    states: str
    report: str
    sums: Mapping[str, str] = field(default_factory=lambda: REVENUE_MEASURES)
    averages: Mapping[str, str] = field(default_factory=lambda: AVERAGE_MEASURES)

    def partial(self, trips: DataFrame) -> DataFrame:
        """The partial sums of some trips by zone, month and service."""
        columns = {*self.sums, *self.averages}
        keys = (F.col("PULocationID").alias("revenue_zone"), month_date("pickup_datetime").alias(MONTH), "service_type")
        return trips.groupBy(*keys).agg(*[c for name in sorted(columns) for c in partial_sums(name, name)])

    def merged(self, states: DataFrame) -> DataFrame:
        return states.groupBy(*KEYS).agg(
            *[merged_sum(column).alias(name) for column, name in self.sums.items()],
            *[merged_avg(column).alias(name) for column, name in self.averages.items()],
        )

    def load(self, trips: DataFrame, load: str) -> list[str]:
        """Stores the partial sums of a load in place of those it stored before; the months computed anew.

        A run that is cut short leaves a note of the load; the next run of any load, or :meth:`refresh`,
        computes what it has left.
        """
        spark = trips.sparkSession
        held = read_manifest(spark, self.states).filter(F.col(LOAD) == load).select("folder").collect()
        note = json.dumps({"load": load, "folders": [row["folder"] for row in held]})
        write_text(spark, f"{self.states}/{PENDING}/{uuid.uuid4().hex}.json", note)
        write_load(self.partial(trips), self.states, [MONTH], load)
        return self.refresh(spark)

    def refresh(self, spark: SparkSession) -> list[str]:
        """Computes the months that loads have touched since the last time; their folders."""
        notes = folders(spark, f"{glob_safe(self.states)}/{PENDING}/*.json")
        found = [json.loads(read_text(spark, note)) for note in notes]
        loads = [entry["load"] for entry in found]
        now = read_manifest(spark, self.states).filter(F.col(LOAD).isin(loads)).select("folder").collect()
        touched = [x for entry in found for x in entry["folders"]] + [row["folder"] for row in now]
        months = sorted({folder.split("/")[0] for folder in touched})
        left = [x for x in months if folders(spark, f"{glob_safe(self.states)}/{glob_safe(x)}/{LOAD}=*")]
        if left:
            kept = spark.read.schema(self._states_schema(spark)).option("basePath", self.states)
            states = kept.parquet(*[f"{glob_safe(self.states)}/{glob_safe(x)}" for x in left])
            # Only the folders of these months are replaced.
            spread = spread_for(self.merged(states), [MONTH]).write.mode("overwrite")
            spread.option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(self.report)
        for gone in set(months) - set(left):
            remove_folder(spark, f"{self.report}/{gone}")
        for note in notes:
            remove_folder(spark, note)
        return months

    def _states_schema(self, spark: SparkSession):
        """The schema that :meth:`partial` writes, without a look at the files."""
        columns = sorted({*self.sums, *self.averages})
        trips = ", ".join(["PULocationID long", "pickup_datetime timestamp_ntz", "service_type string", *[f"`{c}` double" for c in columns]])
        return self.partial(spark.createDataFrame([], trips)).withColumn(LOAD, F.lit("")).schema

    def read(self, spark: SparkSession) -> DataFrame:
        """The report: zone, month, service, sums and averages."""
        names = [*self.sums.values(), *self.averages.values()]
        kinds = ", ".join(["revenue_zone long", f"{MONTH} date", "service_type string", *[f"`{x}` double" for x in names]])
        rows = spark.read.schema(kinds).parquet(self.report)
        month = F.col(MONTH).cast("timestamp_ntz").alias("revenue_month")
        return rows.select("revenue_zone", month, "service_type", *names)

"""Schemas made equal, text made time, missing and zero values handled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types.

    Names match without regard to case, other columns are left out, a missing column is an error.
    ``strict`` casts fail on a value that does not fit (under ANSI); otherwise it becomes null.
    """
    present = {name.lower(): name for name in df.columns}
    missing = [f.name for f in schema if f.name.lower() not in present]
    if missing:
        raise KeyError(f"columns not found: {', '.join(missing)}")

    def cast(field: T.StructField) -> Column:
        column = F.col(f"`{present[field.name.lower()]}`")
        typed = column.cast(field.dataType) if strict else column.try_cast(field.dataType)
        return typed.alias(field.name)

    return df.select(*[cast(field) for field in schema])


def fix_timestamps(df: DataFrame, columns: Sequence[str], strict: bool = True) -> DataFrame:
    """Text columns as timestamps; text that is none fails the job, or becomes null if not strict."""
    def parse(name: str) -> Column:
        return F.col(name).cast("timestamp_ntz") if strict else F.col(name).try_cast("timestamp_ntz")

    return df.withColumns({name: parse(name) for name in columns})


def is_missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN where the column can hold it."""
    missing = F.col(column).isNull()
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        missing = missing | F.isnan(column)
    return missing


def not_zero(column: str) -> Column:
    """Everything but zero; a missing value is not zero and stays."""
    return ~F.col(column).eqNullSafe(F.lit(0))


def drop_zero(df: DataFrame, column: str = "passenger_count") -> DataFrame:
    return df.filter(not_zero(column))


def fill_zero(df: DataFrame, column: str = "passenger_count") -> DataFrame:
    """Missing values become zero."""
    return df.fillna(0, subset=[column])


def observe_quality(df: DataFrame, column: str, name: str | Observation) -> DataFrame:
    """The same rows, counting rows, missing and zero values on their way.

    The counts belong to the job that reads the rows anyway; a stream reports them per batch.
    """
    return df.observe(
        name,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(is_missing(df, column)).alias("missing"),
        F.count_if(F.col(column).eqNullSafe(F.lit(0))).alias("zero"),
    )


def quality_counters(df: DataFrame, column: str = "passenger_count") -> DataFrame:
    """Rows, missing and zero values as read, after :func:`drop_zero` and after :func:`fill_zero`.

    All nine counters come from one pass over the one column.
    """
    missing, kept = is_missing(df, column), not_zero(column)
    zero = F.col(column).eqNullSafe(F.lit(0))
    filled = F.when(missing, F.lit(0)).otherwise(F.col(column))
    states: Mapping[str, tuple[Column, Column, Column]] = {
        "read": (F.lit(True), missing, zero),
        "zero_dropped": (kept, kept & missing, kept & zero),
        "missing_filled": (F.lit(True), filled.isNull(), filled.eqNullSafe(F.lit(0))),
    }
    counts = df.agg(
        *[
            F.struct(
                F.lit(state).alias("state"),
                F.count_if(rows).alias("rows"),
                F.count_if(absent).alias("missing"),
                F.count_if(zeros).alias("zero"),
            ).alias(state)
            for state, (rows, absent, zeros) in states.items()
        ]
    )
    return counts.select(F.inline(F.array(*states)))

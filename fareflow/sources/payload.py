"""Nested trade payloads: ``{"data": {"list": [record, ...]}}``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.operators.cleaning import conform
from fareflow.schemas import TRADE, TRADE_PAYLOAD

#: The text of a document that is not JSON of the expected shape.
CORRUPT = "_corrupt_document"


def payload_schema(record_fields: Sequence[str]) -> T.StructType:
    record = T.StructType([T.StructField(name, T.StringType(), True) for name in record_fields])
    data = T.StructType([T.StructField("list", T.ArrayType(record), True)])
    return T.StructType([T.StructField("data", data), T.StructField(CORRUPT, T.StringType())])


def _documents(spark, paths, record_fields, multiline) -> DataFrame:
    reader = spark.read.schema(payload_schema(record_fields)).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.option("multiLine", multiline).json(paths)


def _unusable(record_fields: Sequence[str]) -> Column:
    """Why a document cannot be used; null if it can.

    A record none of whose names are the expected ones has only nulls.
    """
    empty = F.exists("data.list", lambda r: F.coalesce(*[r[name] for name in record_fields]).isNull())
    return (
        F.when(F.col(CORRUPT).isNotNull(), F.lit("not a document of one line; see multiline"))
        .when(F.col("data.list").isNull(), F.lit("no data.list"))
        .when(empty, F.lit("a record has none of the fields"))
    )


def read_trade_payload(
    spark: SparkSession,
    paths: str | Sequence[str],
    record_fields: Sequence[str],
    keep_bloc: bool = False,
    multiline: bool = False,
    on_error: str = "fail",
) -> DataFrame:
    """Flat trade rows from payload files.

    ``record_fields`` are the names the payload uses, in the order year, month, country, bloc,
    city, state, section code, section name, value, weight; they are renamed by position.
    One document per line can be split between tasks. A document spread over lines
    (``multiline``) is read by one task per file.

    A document that is not JSON, has no list or a record without any of the fields fails the read;
    with ``on_error="skip"`` it is left out, to be found in :func:`payload_rejects`.
    """
    if on_error not in ("fail", "skip"):
        raise ValueError(f"on_error: {on_error}")
    documents, reason = _documents(spark, paths, record_fields, multiline), _unusable(record_fields)
    if on_error == "skip":
        documents = documents.filter(reason.isNull())
        records = documents.select(F.inline("data.list"))
    else:
        # The error stands in the list itself, so no optimisation can leave it out.
        checked = F.when(reason.isNull(), F.col("data.list")).otherwise(
            F.raise_error(F.concat(F.lit("payload: "), reason)).cast(documents.schema["data"].dataType["list"].dataType)
        )
        records = documents.select(F.inline(checked))
    records = records.toDF(*TRADE_PAYLOAD)
    rows = conform(records, TRADE)
    if keep_bloc:
        rows = conform(records, T.StructType([*TRADE.fields, T.StructField("trade_bloc", T.StringType())]))
    return rows


def payload_rejects(
    spark: SparkSession, paths: str | Sequence[str], record_fields: Sequence[str], multiline: bool = False
) -> DataFrame:
    """file, reason and text of every document that cannot be used."""
    documents = _documents(spark, paths, record_fields, multiline)
    text = F.coalesce(F.col(CORRUPT), F.to_json("data"))
    rows = documents.select(
        F.input_file_name().alias("file"), _unusable(record_fields).alias("reason"), text.alias("text")
    )
    return rows.filter("reason is not null")

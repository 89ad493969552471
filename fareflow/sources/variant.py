"""Payloads whose fields come and go: known fields typed, all others kept beside them.

A document is parsed once into a VARIANT, whatever is in it. A known field is cast to its type from text or
number; what has another name, or a value that does not fit, stays in ``more``, so nothing of a record is lost.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.schemas import TRADE, TRADE_PAYLOAD

MORE = "more"
#: Types of the known fields.
TYPES = {**{f.name: f.dataType.simpleString() for f in TRADE}, "trade_bloc": "string"}


def with_document(lines: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the document of a text as a VARIANT; null unless the text is one document and nothing else.

    The parser itself does not look beyond the end of a document, so the text is parsed as the only
    element of a list in another document, of which it must leave the end as it is. The parse sits in a
    one-element explode, so that it is done once, whatever is asked of the document.
    """
    end = uuid.uuid4().hex
    whole = F.concat(F.lit('{"document":['), F.col(text), F.lit(f'],"{end}":[]}}'))
    parsed = F.from_json(whole, "map<string, array<variant>>", {"allowNonNumericNumbers": "false"})

    def only(found: Column) -> Column:
        documents = F.element_at(F.map_values(found), 1)
        intact = F.map_keys(found) == F.array(F.lit("document"), F.lit(end))
        return F.when(intact & (F.size(documents) == 1), F.get(documents, F.lit(0)))

    return lines.select("*", F.explode(F.transform(F.array(parsed), only)).alias(name))


def read_trade_variant(
    spark: SparkSession, paths: str | Sequence[str], record_fields: Sequence[str], keep_more: bool = True
) -> DataFrame:
    """Trade rows of documents, one a line: the columns of :data:`TRADE_PAYLOAD` and ``more`` (name -> JSON text).

    ``record_fields`` are the names the payload uses, in the order of :data:`TRADE_PAYLOAD`. Lines that are no
    document or have no list have no rows; :func:`variant_rejects` has them. A record that is no object
    has a row of nulls with the record in ``more`` under an empty name.
    """
    documents = _documents(spark, paths)
    # A one-element explode, so that a record is taken apart once and not for every column.
    records = documents.select(F.explode("list").alias("record"))
    known = dict(zip(TRADE_PAYLOAD, record_fields))
    typed = {name: F.try_variant_get("record", f"$['{field}']", TYPES[name]) for name, field in known.items()}
    if not keep_more:
        return records.select(*[c.alias(name) for name, c in typed.items()])
    parts = F.try_variant_get("record", "$", "map<string, variant>").alias("parts")
    rows = records.select(*[c.alias(name) for name, c in typed.items()], "record", parts)

    def is_more(key: Column, value: Column) -> Column:
        taken = F.lit(False)
        for name, field in known.items():
            taken = taken | ((key == field) & (F.col(name).isNotNull() | F.is_variant_null(value)))
        return ~taken

    more = F.transform_values(F.map_filter("parts", is_more), lambda _, value: F.to_json(value))
    odd = F.create_map(F.lit(""), F.to_json("record"))
    return rows.select(*TRADE_PAYLOAD, F.coalesce(more, odd).alias(MORE))


def variant_rejects(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """file and text of the lines without a list of records."""
    return _lines(spark, paths).filter(F.col("list").isNull()).select(F.input_file_name().alias("file"), "value")


def _lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    lines = spark.read.text([paths] if isinstance(paths, str) else list(paths))
    records = F.try_variant_get("document", "$.data.list", "array<variant>")
    return with_document(lines, "value", "document").withColumn("list", records)


def _documents(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return _lines(spark, paths).filter(F.col("list").isNotNull())

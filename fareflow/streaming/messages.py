"""Messages to records and back."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.schemas import PRICE, RIDE, RIDE_KEY

# The amount is compared with a limit, so it is not narrowed to float.
RIDE_MESSAGE = T.StructType(
    [T.StructField(f.name, T.DoubleType()) if f.name == "total_amount" else f for f in RIDE]
)

# Columns of a recorded ride file, by position, that make up a ride message.
RIDE_POSITIONS = {
    "vendorId": 0,
    "passenger_count": 3,
    "trip_distance": 4,
    "payment_type": 9,
    "total_amount": 16,
}


def encode(
    df: DataFrame, key: Mapping[str, Column], value: Mapping[str, Column], *others: str | Column
) -> DataFrame:
    """JSON ``key`` and ``value`` text built from named columns."""
    def text(columns: Mapping[str, Column]) -> Column:
        return F.to_json(F.struct(*[column.alias(name) for name, column in columns.items()]))

    return df.select(text(key).alias("key"), text(value).alias("value"), *others)


def encode_recorded_rides(recorded: DataFrame, *others: str | Column) -> DataFrame:
    """Ride messages keyed by vendor from text columns picked by position."""
    def pick(field: T.StructField) -> Column:
        return F.col(recorded.columns[RIDE_POSITIONS[field.name]]).cast(field.dataType)

    value = {field.name: pick(field) for field in RIDE_MESSAGE}
    return encode(recorded, {name: value[name] for name in RIDE_KEY.fieldNames()}, value, *others)


def decode(
    messages: DataFrame, schema: T.StructType = RIDE_MESSAGE, required: Sequence[str] | None = None
) -> DataFrame:
    """Adds the parsed ``record`` and whether it is ``valid``.

    Text that is not JSON, a field of the wrong type and a field that is absent all parse to
    null, so a record is valid when every required field (by default all) is there. NaN and infinity
    are no JSON numbers, and text after the document makes it invalid: the value is parsed as the only
    element of a list inside a document, which is read to its end. A value that closes the list itself
    adds a key to that document or takes away its last, whose name it cannot know. The raw value stays
    beside it. The parse sits in a one-element explode, which the optimizer does not copy into every
    later use of a field: each message is parsed once.
    """
    end = uuid.uuid4().hex
    whole = F.concat(F.lit('{"record":['), F.col("value"), F.lit(f'],"{end}":[]}}'))
    shape = T.MapType(T.StringType(), T.ArrayType(schema))
    parsed = F.from_json(whole, shape, {"allowNonNumericNumbers": "false"})

    def only_record(found: Column) -> Column:
        record = F.element_at(F.map_values(found), 1)
        whole = F.map_keys(found) == F.array(F.lit("record"), F.lit(end))
        return F.when(whole & (F.size(record) == 1), F.get(record, F.lit(0)))

    parsed = messages.select("*", F.explode(F.transform(F.array(parsed), only_record)).alias("record"))
    names = schema.fieldNames() if required is None else required
    valid = F.lit(True)
    for name in names:
        valid = valid & F.col(f"record.{name}").isNotNull()
    return parsed.withColumn("valid", valid)


def records(decoded: DataFrame) -> DataFrame:
    """The fields of the valid records."""
    return decoded.filter("valid").select("record.*")


def rejects(decoded: DataFrame) -> DataFrame:
    """The messages that are not valid records, as they came."""
    return decoded.filter(~F.col("valid")).drop("record", "valid")


def prices(messages: DataFrame, label: str = "Bitcoin price: ") -> DataFrame:
    """The amount inside ``data`` as text, as a labelled line and as a number (null if it is none)."""
    decoded = decode(messages, PRICE, required=["data.amount"])
    amount = F.col("record.data.amount")
    return decoded.filter("valid").select(
        amount.alias("amount"),
        F.concat(F.lit(label), amount).alias("line"),
        amount.try_cast("decimal(18,2)").alias("price"),
    )

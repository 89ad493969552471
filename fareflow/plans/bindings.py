"""The feeds, lookups and topics, as views of the driver's test tables (see FIXTURES.md).

A ride is an order line; what its order, customer or supplier would say is null where that is missing
(left joins on unique keys). A builder takes the columns a query needs and joins only the tables those
columns come from: an unused lookup could neither add nor drop a row. The check SQL always joins
everything, which tests that claim on each run.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.functions.moments import in_years
from fareflow.schemas import RIDE_KEY
from fareflow.streaming.messages import encode

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
HOME_REGION = "AMERICA"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _nullif(column: Column, value: int) -> Column:
    return F.when(column != value, column)


def _base_number(key: Column) -> Column:
    return F.concat(F.lit("B"), F.lpad(key.cast("string"), 5, "0"))


def _trip_columns() -> dict[str, tuple[set[str], Column]]:
    """Column -> the tables it needs besides lineitem, and its expression."""
    line = F.col("l_linenumber")
    return {
        "trip_id": (set(), 8 * F.col("l_orderkey") + line),
        "VendorID": (set(), line.cast("long")),
        "pickup_datetime": ({"orders"}, F.col("o_orderdate")),
        "dropoff_datetime": (set(), F.col("l_shipdate")),
        "PULocationID": ({"orders", "customer"}, _nullif(F.col("c_nationkey"), 7).cast("long")),
        "DOLocationID": ({"supplier"}, _nullif(F.col("s_nationkey"), 7).cast("long")),
        "passenger_count": (set(), _nullif(line % 7, 3).cast("double")),
        "trip_distance": (set(), F.col("l_quantity")),
        "fare_amount": (set(), F.col("l_extendedprice")),
        "extra": (set(), F.col("l_discount")),
        "tip_amount": (set(), F.col("l_tax")),
        "total_amount": ({"orders"}, F.col("o_totalprice")),
        "service_type": (
            set(),
            F.when(F.col("l_linestatus") == "F", F.lit("green")).otherwise(F.lit("yellow")),
        ),
        "payment_type": (set(), (1 + line % 4).cast("long")),
        "dispatching_base_num": (set(), _base_number(F.col("l_suppkey"))),
        "SR_Flag": (set(), F.col("l_returnflag")),
        "Affiliated_base_number": (set(), _base_number(F.col("l_partkey") % 50)),
    }


TRIP_COLUMNS = (
    "VendorID", "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID",
    "passenger_count", "trip_distance", "fare_amount", "extra", "tip_amount", "total_amount",
    "service_type",
)
FEED_COLUMNS = TRIP_COLUMNS[:-1] + ("payment_type",)
FHV_COLUMNS = (
    "dispatching_base_num", "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID",
    "SR_Flag", "Affiliated_base_number",
)
TRIP_SUMS = {
    "fare_amount": "revenue_monthly_fare",
    "extra": "revenue_monthly_extra",
    "tip_amount": "revenue_monthly_tip_amount",
    "total_amount": "revenue_monthly_total_amount",
}


def _rides(
    spark: SparkSession, sf_dir: str, columns: Iterable[str], only: Column | None = None
) -> DataFrame:
    known = _trip_columns()
    chosen = {name: known[name] for name in columns}
    needed = set().union(*[tables for tables, _ in chosen.values()])
    rows = table(spark, sf_dir, "lineitem")
    if only is not None:
        rows = rows.filter(only)
    if "orders" in needed:
        orders = table(spark, sf_dir, "orders")
        if "customer" in needed:
            # Orders, not the several times larger lines, are shuffled by customer.
            customer = table(spark, sf_dir, "customer")
            orders = orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "left")
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if "supplier" in needed:
        supplier = table(spark, sf_dir, "supplier")
        rows = rows.join(supplier, F.col("l_suppkey") == supplier["s_suppkey"], "left")
    return rows.select(*[expression.alias(name) for name, (_, expression) in chosen.items()])


def trips(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Green and yellow trips already in one table."""
    return _rides(spark, sf_dir, columns or TRIP_COLUMNS)


def fhv(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """For-hire trips."""
    return _rides(spark, sf_dir, columns or FHV_COLUMNS)


def green_feed(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Green trips under their own time names; the payment type is a double."""
    rows = _rides(spark, sf_dir, columns or FEED_COLUMNS, F.col("l_linestatus") == "F")
    if "payment_type" in rows.columns:
        rows = rows.withColumn("payment_type", F.col("payment_type").cast("double"))
    return rows.withColumnsRenamed(
        {"pickup_datetime": "lpep_pickup_datetime", "dropoff_datetime": "lpep_dropoff_datetime"}
    )


def yellow_feed(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Yellow trips under their own time names; the payment type is a long."""
    rows = _rides(spark, sf_dir, columns or FEED_COLUMNS, F.col("l_linestatus") != "F")
    return rows.withColumnsRenamed(
        {"pickup_datetime": "tpep_pickup_datetime", "dropoff_datetime": "tpep_dropoff_datetime"}
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone lookup; ids 20 and up are unknown to it."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        nation.filter("n_nationkey < 20")
        .join(region, nation["n_regionkey"] == region["r_regionkey"])
        .select(
            F.col("n_nationkey").cast("long").alias("LocationID"),
            F.col("r_name").alias("Borough"),
            F.col("n_name").alias("Zone"),
        )
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def hourly_feed(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    """A feed with times within the day: purchases are green trips, all other events yellow ones."""
    green = F.col("event_type").eqNullSafe("purchase")
    return (
        events(spark, sf_dir)
        .filter(green if service == "green" else ~green)
        .select(
            F.col("ts").alias("pickup_datetime"),
            _nullif(F.col("user_id") % 25, 7).alias("PULocationID"),
            F.col("value").alias("total_amount"),
        )
    )


def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of up to 490 minutes forward or 490 seconds back, plus up to two whole days."""
    step = F.floor("value").cast("int")
    even = F.col("event_id") % 2 == 0
    zero = F.lit(0)
    offset = F.make_dt_interval(
        days=(F.col("event_id") % 3).cast("int"),
        hours=zero,
        mins=F.when(even, step).otherwise(zero),
        secs=F.when(even, zero).otherwise(-step).cast("decimal(18,6)"),
    )
    return events(spark, sf_dir).select(
        "event_id",
        F.col("ts").alias("pickup_datetime"),
        (F.col("ts") + offset).alias("dropoff_datetime"),
    )


def trade(
    spark: SparkSession,
    sf_dir: str,
    *columns: str,
    flow: str | None = None,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Trade rows of both flows in one pass over the order lines, or of one ``flow``.

    A line whose supplier alone is at home is an export, one whose customer alone is at home an
    import. ``years`` (first, last) reads only their orders. Orders are joined to customers before
    lines are; for exports the home suppliers come first and leave a fifth of the lines.
    """
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    places = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        "n_nationkey", "n_name", "r_name"
    )

    def party(rows: DataFrame, prefix: str) -> DataFrame:
        return rows.join(places, rows[f"{prefix}_nationkey"] == places["n_nationkey"]).select(
            f"{prefix}_{'supp' if prefix == 's' else 'cust'}key",
            F.col(f"{prefix}_name").alias(f"{prefix}_city"),
            F.col("n_name").alias(f"{prefix}_nation"),
            F.col("r_name").alias(f"{prefix}_region"),
        )

    customer = party(table(spark, sf_dir, "customer"), "c")
    supplier = party(table(spark, sf_dir, "supplier"), "s")
    orders = table(spark, sf_dir, "orders")
    if years:
        orders = orders.filter(in_years("o_orderdate", *years))
    orders = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    joins = [
        (orders, F.col("l_orderkey") == F.col("o_orderkey")),
        (supplier, F.col("l_suppkey") == F.col("s_suppkey")),
    ]
    rows = table(spark, sf_dir, "lineitem")
    for other, match in reversed(joins) if flow == "exports" else joins:
        rows = rows.join(other, match)
    if not columns or {"section_cd", "section_ds"} & set(columns):
        part = table(spark, sf_dir, "part")
        rows = rows.join(part, F.col("l_partkey") == part["p_partkey"], "left")

    home_supplier = F.col("s_region") == HOME_REGION
    home_customer = F.col("c_region") == HOME_REGION
    wanted = {
        None: home_supplier != home_customer,
        "exports": home_supplier & ~home_customer,
        "imports": home_customer & ~home_supplier,
    }[flow]

    def side(export: str, import_: str) -> Column:
        return F.when(home_supplier, F.col(export)).otherwise(F.col(import_))

    known = {
        "flow": F.when(home_supplier, F.lit("exports")).otherwise(F.lit("imports")),
        "year": F.year("o_orderdate"),
        "month": F.month("o_orderdate"),
        "destination_country": side("c_nation", "s_nation"),
        "trade_bloc": side("c_region", "s_region"),
        "origin_city": side("s_city", "c_city"),
        "origin_state": side("s_nation", "c_nation"),
        "section_cd": F.col("p_brand") if "p_brand" in rows.columns else None,
        "section_ds": F.col("p_type") if "p_type" in rows.columns else None,
        "fob": F.rint(F.col("l_extendedprice") * 100).cast("bigint"),
        "net_weight": F.col("l_quantity").cast("bigint"),
    }
    chosen = columns or tuple(known)
    return rows.filter(wanted).select(*[known[name].alias(name) for name in chosen])


def ride_columns(clean: bool = True) -> tuple[dict[str, Column], dict[str, Column]]:
    """Key and value fields of an event's ride message; unless clean, some lack their amount."""
    vendor = F.col("user_id").cast("int")
    amount = F.col("value")
    value = {
        "vendorId": vendor,
        "passenger_count": (F.col("event_id") % 6).cast("int"),
        "trip_distance": (F.col("value") / 10).cast("float"),
        "payment_type": (1 + F.col("event_id") % 4).cast("int"),
        "total_amount": amount if clean else F.when(F.col("event_id") % 100 != 1, amount),
    }
    return {name: value[name] for name in RIDE_KEY.fieldNames()}, value


def ride_messages(rows: DataFrame, clean: bool = True) -> DataFrame:
    """Events, batch or stream, as the ride topic of four partitions.

    Unless ``clean``, of every hundred values one is not JSON, the next lacks its amount, another has
    text after the document, another's amount is NaN, and three close brackets they have not opened.
    """
    key, value = ride_columns(clean)
    messages = encode(
        rows,
        key,
        value,
        F.lit("yellow_taxi_rides").alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.expr("event_id div 4").alias("offset"),
    )
    if clean:
        return messages
    number = (4 * F.col("offset") + F.col("partition")) % 100
    value = F.col("value")
    broken = (
        F.when(number == 0, F.lit("not json"))
        .when(number == 2, F.concat(value, F.lit(" trailing")))
        .when(number == 3, F.regexp_replace(value, r'"total_amount":[^,}]*', '"total_amount":NaN'))
        .when(number == 4, F.concat(value, F.lit('],"z":[')))
        .when(number == 5, F.concat(value, F.lit('],"end":true}')))
        .when(number == 6, F.concat(value, F.lit('],"end":true} garbage')))
        .otherwise(value)
    )
    return messages.withColumn("value", broken)


def price_messages(rows: DataFrame) -> DataFrame:
    """Events as price messages with the amount inside ``data``, as text."""
    amount = F.col("value").cast("string")
    return encode(
        rows,
        {"event_id": F.col("event_id")},
        {"data": F.struct(amount.alias("amount"))},
        F.lit("data-stream").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
    )

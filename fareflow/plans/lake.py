"""Files and tables: every query writes what it is about and reads it back."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.functions import moments as M
from fareflow.functions.money import exact_sum
from fareflow.operators import cleaning, clustered, reports, revenue
from fareflow.operators import trade as T
from fareflow.operators.kept import KeptReport
from fareflow.plans import bindings as B
from fareflow.plans import sql as S
from fareflow.plans.registry import QUERIES, query
from fareflow.plans.trips import both_feeds
from fareflow.schemas import AVERAGE_MEASURES, FOR_HIRE, TRADE_PAYLOAD, YELLOW_FEED, ZONES, fields
from fareflow.session import new_folder, new_table
from fareflow.sinks import files, tables
from fareflow.sinks.manifest import read_manifest
from fareflow.sources import files as sources
from fareflow.sources.payload import payload_rejects as read_payload_rejects
from fareflow.sources.payload import read_trade_payload
from fareflow.sources.variant import read_trade_variant

PICKUP_MONTH = tables.DateLayout("pickup_datetime", "month")
TEXT_TIME = "yyyy-MM-dd HH:mm:ss"

_FHV_ALL = S.with_(S.FHV) + """SELECT dispatching_base_num, pickup_datetime, dropoff_datetime,
    {pu} AS PULocationID, {do} AS DOLocationID, SR_Flag, Affiliated_base_number FROM fhv"""
FHV_INT = _FHV_ALL.format(pu="CAST(PULocationID AS INTEGER)", do="CAST(DOLocationID AS INTEGER)")
FHV_LONG = _FHV_ALL.format(pu="PULocationID", do="DOLocationID")


def _fhv_csv(spark, sf_dir, **options) -> str:
    """For-hire trips as CSV with times as plain text."""
    folder = new_folder(spark, "fhv-csv")
    rows = B.fhv(spark, sf_dir)
    rows.write.options(header=True, timestampNTZFormat=TEXT_TIME, **options).csv(folder)
    return folder


# --- sources --------------------------------------------------------------------------------


@query(
    S.with_(S.TRIPS, S.ZONES)
    + """SELECT LocationID, Borough, Zone, count(PULocationID) AS trips
         FROM zones LEFT JOIN trips ON PULocationID = LocationID GROUP BY ALL"""
)
def src_csv_zones(spark, sf_dir):
    """The lookup from CSV, each zone with the number of trips that start there."""
    folder = new_folder(spark, "zones-csv")
    B.zones(spark, sf_dir).write.option("header", True).csv(folder)
    zones = sources.read_csv(spark, folder, ZONES)
    starts = reports.count_by(B.trips(spark, sf_dir, "PULocationID"), "PULocationID")
    return zones.join(starts, zones["LocationID"] == starts["PULocationID"], "left").select(
        *ZONES.fieldNames(), F.coalesce("trips", F.lit(0)).alias("trips")
    )


@query(FHV_INT)
def src_csv_gz_typed(spark, sf_dir):
    """Each gzip file is decompressed by one task; typing its rows is spread."""
    files_ = _fhv_csv(spark, sf_dir, compression="gzip") + "/*.csv.gz"
    text = sources.read_csv(spark, files_, parallelism=spark.sparkContext.defaultParallelism)
    typed = cleaning.fix_timestamps(text, ["pickup_datetime", "dropoff_datetime"])
    return cleaning.conform(typed, FOR_HIRE)


@query(FHV_INT)
def src_csv_reordered(spark, sf_dir):
    """The file's columns stand in another order than the schema's, with one more between them."""
    folder = new_folder(spark, "fhv-reordered")
    rows = B.fhv(spark, sf_dir)
    shuffled = rows.select(*reversed(rows.columns[3:]), F.lit("x").alias("note"), *rows.columns[:3])
    shuffled.write.options(header=True, timestampNTZFormat=TEXT_TIME).csv(folder)
    return sources.read_csv(spark, folder, FOR_HIRE)


@query(FHV_INT)
def clean_timestamps(spark, sf_dir):
    text = sources.read_csv(spark, _fhv_csv(spark, sf_dir))
    typed = cleaning.fix_timestamps(text, ["pickup_datetime", "dropoff_datetime"])
    return cleaning.conform(typed, FOR_HIRE)


@query("SELECT * FROM orders")
def src_parquet(spark, sf_dir):
    return sources.read_parquet(spark, f"{sf_dir}/orders.parquet")


RIDE_DAYS = fields(EVENT_ID="long", user_id="integer", ts="date", value="double")


@query(
    """SELECT event_id AS EVENT_ID, CAST(user_id AS INTEGER) AS user_id, CAST(ts AS DATE) AS ts, value
       FROM events"""
)
def src_parquet_conformed(spark, sf_dir):
    return sources.read_conformed(spark, f"{sf_dir}/events.parquet", RIDE_DAYS)


@query(
    S.with_(S.TRIPS)
    + """SELECT VendorID, pickup_datetime AS tpep_pickup_datetime, passenger_count, CAST(trip_distance AS DOUBLE) AS trip_distance,
                CAST(payment_type AS BIGINT) AS payment_type
         FROM trips"""
)
def src_parquet_imposed(spark, sf_dir):
    """Months whose counts are whole numbers, of either width, under the feed's schema of doubles."""
    folder = new_folder(spark, "drifting")
    rows = B.trips(spark, sf_dir, "VendorID", "pickup_datetime", "passenger_count", "trip_distance").withColumns(
        {"payment_type": 1 + F.col("VendorID") % 4}
    )
    rows = rows.withColumnRenamed("pickup_datetime", "tpep_pickup_datetime")
    month = F.month("tpep_pickup_datetime") % 3
    for number, (count, vendor) in enumerate([("double", "long"), ("int", "int"), ("long", "long")]):
        part = rows.filter(F.coalesce(month, F.lit(0)) == number).withColumns(
            {"passenger_count": F.col("passenger_count").cast(count), "VendorID": F.col("VendorID").cast(vendor)}
        )
        part.write.parquet(f"{folder}/{number}")
    read = sources.read_feed(spark, f"{folder}/*", YELLOW_FEED)
    return read.select("VendorID", "tpep_pickup_datetime", "passenger_count", "trip_distance", "payment_type")


def _monthly_folders(spark, sf_dir, *columns) -> str:
    folder = new_folder(spark, "trips-by-month")
    rows = B.trips(spark, sf_dir, *columns).withColumns(
        {"year": F.year("pickup_datetime"), "month": F.month("pickup_datetime")}
    )
    files.write_partitioned(rows, folder, ["year", "month"])
    return folder


_BY_MONTH_SQL = S.with_(S.TRIPS) + f"""
    SELECT CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month,
           count(*) AS trips, {S.money('fare_amount')} AS fares
    FROM trips {{where}} GROUP BY 1, 2"""


def _by_month(rows):
    return rows.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("trips"), exact_sum("fare_amount").alias("fares")
    )


@query(_BY_MONTH_SQL.format(where=""))
def monthly_layout(spark, sf_dir):
    folder = _monthly_folders(spark, sf_dir, "pickup_datetime", "fare_amount")
    return _by_month(sources.read_parquet(spark, folder))


@query(
    S.with_(S.TRIPS)
    + f"SELECT service_type, count(*) AS trips, {S.money('fare_amount')} AS fares FROM trips GROUP BY 1"
)
def src_glob_months(spark, sf_dir):
    columns = ("pickup_datetime", "fare_amount", "service_type")
    folder = _monthly_folders(spark, sf_dir, *columns)
    rows = sources.read_parquet(spark, f"{folder}/*/*")
    return rows.groupBy("service_type").agg(
        F.count(F.lit(1)).alias("trips"), exact_sum("fare_amount").alias("fares")
    )


@query(_BY_MONTH_SQL.format(where="WHERE year(pickup_datetime) IN (1997, 1998)"))
def external_table_scan(spark, sf_dir):
    folder = _monthly_folders(spark, sf_dir, "pickup_datetime", "fare_amount")
    name = new_table("external")
    prefixes = [f"{folder}/year={year}" for year in (1997, 1998)]
    return _by_month(sources.external_table(spark, name, prefixes, root=folder))


@query(FHV_LONG)
def src_name_pattern(spark, sf_dir):
    root = new_folder(spark, "mixed")
    files.write_parquet(B.fhv(spark, sf_dir), root, prefix="fhv_tripdata")
    files.write_parquet(B.zones(spark, sf_dir), root, mode="append", prefix="zones_tripdata")
    return sources.read_dataset(spark, root, "fhv")


@query(
    S.with_(S.TRADE)
    + """SELECT year, month, destination_country, origin_city, origin_state, section_cd, section_ds,
                fob, net_weight, trade_bloc
         FROM trade"""
)
def trade_json_flatten(spark, sf_dir):
    """Both flows, each month in documents of up to some hundred records."""
    folder = new_folder(spark, "trade-json")
    _trade_documents(spark, sf_dir).write.partitionBy("of_year", "of_month").json(folder)
    return read_trade_payload(spark, f"{folder}/*/*", PAYLOAD_NAMES, keep_bloc=True)


PAYLOAD_NAMES = [f"f{position:02d}" for position in range(len(TRADE_PAYLOAD))]
RECORDS_PER_DOCUMENT = 200


def _trade_documents(spark, sf_dir):
    """data, of_year, of_month: a month's records, dealt to documents of about equal size."""
    rows = B.trade(spark, sf_dir, *TRADE_PAYLOAD)
    record = F.struct(*[F.col(c).cast("string").alias(n) for c, n in zip(TRADE_PAYLOAD, PAYLOAD_NAMES)])
    months = [F.col("year").alias("of_year"), F.col("month").alias("of_month")]
    per_month = reports.count_by(rows, "year", "month", name="records")
    parts = F.ceil(F.col("records") / RECORDS_PER_DOCUMENT)
    dealt = rows.join(per_month, ["year", "month"]).withColumn(
        "part", F.pmod(F.xxhash64("section_cd", "fob", "net_weight", "origin_city"), parts)
    )
    documents = dealt.groupBy(*months, "part").agg(F.collect_list(record).alias("list"))
    return documents.select(F.struct("list").alias("data"), "of_year", "of_month")


@query(
    S.with_(S.TRADE)
    + """, months AS (SELECT year, month FROM trade GROUP BY 1, 2)
         SELECT year, month, reason FROM months, (VALUES ('no data.list'), ('a record has none of the fields'),
             ('not a document of one line; see multiline')) r(reason)"""
)
def payload_rejects(spark, sf_dir):
    """All documents of both flows, and of each month one more that is cut off, has no list or has other names."""
    folder = new_folder(spark, "broken-json")
    lines = _trade_documents(spark, sf_dir).select("of_year", "of_month", F.to_json(F.struct("data")).alias("value"))
    lines.withColumnsRenamed({"of_year": "year", "of_month": "month"}).write.partitionBy("year", "month").text(folder)
    one = spark.read.text(folder).groupBy("year", "month").agg(F.min("value").alias("value"))
    broken = (
        F.substring("value", F.lit(1), (F.length("value") / 2).cast("int")),
        F.regexp_replace("value", '"list":', '"note":'),
        F.regexp_replace("value", '"f([0-9]+)":', '"other$1":'),
    )
    lines = one.select("year", "month", F.explode(F.array(*broken)).alias("value"))
    lines.write.partitionBy("year", "month").mode("append").text(folder)
    rejects = read_payload_rejects(spark, f"{folder}/*/*", PAYLOAD_NAMES)
    of = lambda key: F.regexp_extract("file", f"{key}=([0-9]+)", 1).cast("int").alias(key)
    return rejects.select(of("year"), of("month"), "reason")


@query(
    S.with_(S.TRADE)
    + """SELECT year, month, destination_country, trade_bloc, origin_city, origin_state, section_cd, section_ds, fob,
                CASE WHEN net_weight % 3 <> 1 THEN net_weight END AS net_weight,
                CASE net_weight % 3 WHEN 0 THEN '{}' WHEN 1 THEN '{"port":"P' || month || '"}'
                     ELSE '{"f09_unit":"kg","port":{"code":' || month || '}}' END AS more
         FROM trade"""
)
def trade_json_variant(spark, sf_dir):
    """Records whose fields are added, missing, of another type, or nested. Every document is there twice more, broken."""
    folder = new_folder(spark, "trade-variant")
    rows = B.trade(spark, sf_dir, *TRADE_PAYLOAD)
    named = dict(zip(TRADE_PAYLOAD, PAYLOAD_NAMES))
    text = {named[c]: F.col(c).cast("string") for c in TRADE_PAYLOAD}
    number = text | {named[c]: F.col(c) for c in ("year", "fob", "net_weight")}
    without = {name: c for name, c in number.items() if name != named["net_weight"]}
    without["port"] = F.concat(F.lit("P"), F.col("month"))
    nested = number | {"f09_unit": F.lit("kg"), "port": F.struct(F.col("month").alias("code"))}
    line = lambda fields: F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))
    kind = F.col("net_weight") % 3
    record = F.when(kind == 0, line(text)).when(kind == 1, line(without)).otherwise(line(nested))
    part = F.pmod(F.xxhash64("section_cd", "fob", "net_weight", "origin_city"), F.lit(8))
    lists = rows.select("year", "month", part.alias("part"), record.alias("record")).groupBy("year", "month", "part")
    document = F.concat(F.lit('{"data":{"list":['), F.array_join(F.collect_list("record"), ","), F.lit("]}}"))
    lists.agg(document.alias("value")).select("value").write.text(folder)
    broken = spark.read.text(folder).select(F.explode(F.array(F.concat("value", F.lit(" }")), F.substring("value", 1, 40))).alias("value"))
    broken.write.mode("append").text(f"{folder}/broken")
    records = read_trade_variant(spark, [f"{folder}/*.txt", f"{folder}/broken"], PAYLOAD_NAMES)
    return records.withColumn("more", F.concat(
        F.lit("{"), F.array_join(F.transform(F.array_sort(F.map_keys("more")), lambda k: F.concat(
            F.lit('"'), k, F.lit('":'), F.element_at("more", k))), ","), F.lit("}"),
    ))


# --- sinks ----------------------------------------------------------------------------------

_FEED_SQL = S.with_(S.TRIPS) + "SELECT pickup_datetime, PULocationID, total_amount, service_type FROM trips"
_FEED = ("pickup_datetime", "PULocationID", "total_amount", "service_type")


def _written(spark, sf_dir, label, **options):
    folder = new_folder(spark, label)
    files.write_parquet(B.trips(spark, sf_dir, *_FEED), folder, **options)
    return sources.read_parquet(spark, folder)


@query(_FEED_SQL)
def sink_overwrite(spark, sf_dir):
    folder = new_folder(spark, "overwrite")
    rows = B.trips(spark, sf_dir, *_FEED)
    files.write_parquet(rows.filter("service_type = 'green'"), folder)
    files.write_parquet(rows, folder, mode="overwrite")
    return sources.read_parquet(spark, folder)


@query(S.with_(S.TRIPS) + "SELECT true AS refused, count(*) AS trips FROM trips WHERE service_type = 'green'")
def sink_refuse(spark, sf_dir):
    """A second write to a folder that has rows is refused and leaves them as they are."""
    folder, refused = new_folder(spark, "refuse"), False
    rows = B.trips(spark, sf_dir, *_FEED)
    files.write_parquet(rows.filter("service_type = 'green'"), folder)
    try:
        files.write_parquet(rows, folder)
    except AnalysisException as error:
        refused = error.getCondition() == "PATH_ALREADY_EXISTS"
    stored = sources.read_parquet(spark, folder)
    return stored.agg(F.lit(refused).alias("refused"), F.count(F.lit(1)).alias("trips"))


@query(_FEED_SQL)
def sink_gzip(spark, sf_dir):
    return _written(spark, sf_dir, "gzip", compression="gzip")


@query(S.with_(S.TRIPS) + "SELECT CAST(24 AS BIGINT) AS files, count(*) AS trips FROM trips")
def sink_file_count(spark, sf_dir):
    rows = _written(spark, sf_dir, "file-count", files=24)
    per_file = reports.count_by(rows, F.input_file_name().alias("file"))
    return per_file.agg(F.count(F.lit(1)).alias("files"), F.sum("trips").alias("trips"))


@query(
    S.with_(S.TRIPS)
    + f"""SELECT PULocationID AS revenue_zone, date_trunc('month', pickup_datetime) AS revenue_month,
                 service_type, {S.money('total_amount')} AS revenue_monthly_total_amount
          FROM trips GROUP BY 1, 2, 3"""
)
def sink_single_report(spark, sf_dir):
    trips = both_feeds(spark, sf_dir, "PULocationID", "pickup_datetime", "total_amount")
    report = revenue.monthly_revenue(
        trips, sums={"total_amount": "revenue_monthly_total_amount"}, averages={}
    )
    folder = new_folder(spark, "report")
    files.write_report(report, folder)
    return sources.read_parquet(spark, folder)


# --- tables ---------------------------------------------------------------------------------


@query(_FEED_SQL)
def table_replace(spark, sf_dir):
    name, path = new_table("replace"), new_folder(spark, "replace")
    rows = B.trips(spark, sf_dir, *_FEED)
    tables.replace_table(rows.limit(0), name, path)
    return tables.append_table(rows, name, path)


@query(_BY_MONTH_SQL.format(where=""))
def table_append_idempotent(spark, sf_dir):
    """Two loads, the second of them twice."""
    name, path = new_table("load"), new_folder(spark, "load")
    rows = B.trips(spark, sf_dir, "pickup_datetime", "fare_amount")
    rows = rows.withColumn(PICKUP_MONTH.column, PICKUP_MONTH.of("pickup_datetime"))
    tables.create_load_table(rows, name, [PICKUP_MONTH.column], path)
    late = F.coalesce(F.col("pickup_datetime") >= F.lit("1997-01-01").cast("timestamp_ntz"), F.lit(True))
    for load, part in (("early", ~late), ("late", late), ("late", late)):
        loaded = tables.load_table(rows.filter(part), name, [PICKUP_MONTH.column], load)
    return _by_month(
        loaded.withColumns({"year": F.year("pickup_datetime"), "month": F.month("pickup_datetime")})
    )


@query(_BY_MONTH_SQL.format(where=""))
def load_with_strays(spark, sf_dir):
    """Loads of a year each, with some rides of the years beside it; the first is run again, once with fewer rows."""
    folder = new_folder(spark, "strays")
    rows = B.trips(spark, sf_dir, "pickup_datetime", "fare_amount", "VendorID").withColumns(
        {"year": F.year("pickup_datetime"), "month": F.month("pickup_datetime")}
    )
    # Every third vendor's rides of the first quarter come with the load of the year before.
    stray = (F.col("VendorID") % 3 == 0) & (F.col("month") <= 3)
    owner = F.coalesce(F.col("year") - stray.cast("int"), F.lit(0)) % 2
    loads = {f"load {i}": rows.filter(owner == i).drop("VendorID") for i in (0, 1)}
    for load, limit in (("load 0", 4), ("load 0", 12), ("load 1", 12), ("load 0", 12)):
        files.write_load(loads[load].filter(F.coalesce("month", F.lit(0)) <= limit), folder, ["year", "month"], load)
    return _by_month(sources.read_parquet(spark, folder))


@query(
    S.with_(S.TRIPS)
    + """, loads AS (SELECT date_trunc('month', pickup_datetime) AS month,
                CASE WHEN pickup_datetime < TIMESTAMP '1997-01-01' THEN 'early' ELSE 'late' END AS load FROM trips)
         SELECT load, count(DISTINCT month) + bool_or(month IS NULL)::INTEGER AS folders FROM loads
         WHERE load = 'early' OR month IS NULL OR month < TIMESTAMP '1998-01-01' GROUP BY 1"""
)
def load_folders(spark, sf_dir):
    """The folders of each load by the manifest, the late one run again without its last months."""
    name, path = new_table("folders"), new_folder(spark, "folders")
    rows = B.trips(spark, sf_dir, "pickup_datetime", "fare_amount")
    rows = rows.withColumn(PICKUP_MONTH.column, PICKUP_MONTH.of("pickup_datetime"))
    tables.create_load_table(rows, name, [PICKUP_MONTH.column], path)
    since = lambda day: F.coalesce(F.col("pickup_datetime") >= F.lit(day).cast("timestamp_ntz"), F.lit(True))
    late = since("1997-01-01")
    shorter = late & (F.col("pickup_datetime").isNull() | ~since("1998-01-01"))
    for load, part in (("early", ~late), ("late", late), ("late", shorter)):
        tables.load_table(rows.filter(part), name, [PICKUP_MONTH.column], load)
    return read_manifest(spark, path).groupBy("load").agg(F.count(F.lit(1)).alias("folders"))


@query(QUERIES["monthly_revenue"].sql)
def monthly_revenue_kept(spark, sf_dir):
    """The report from kept partial sums: a load that lacks rows, one with strays, and the first again, corrected."""
    columns = ("PULocationID", "pickup_datetime", *B.TRIP_SUMS, *AVERAGE_MEASURES)
    trips = both_feeds(spark, sf_dir, *columns)
    kept = KeptReport(new_folder(spark, "states"), new_folder(spark, "report"), B.TRIP_SUMS)
    early = F.coalesce(F.col("pickup_datetime") < F.lit("1997-01-01").cast("timestamp_ntz"), F.lit(False))
    # Green trips of a quarter come with the load of the years after.
    stray = early & (F.col("service_type") == "green") & (F.month("pickup_datetime") < 4)
    first = trips.filter(early & ~stray)
    for load, part in (("a", first.filter("PULocationID % 2 = 0")), ("b", trips.filter(~early | stray)), ("a", first)):
        kept.load(part, load)
    return kept.read(spark)


VENDOR_COLUMNS = (
    "VendorID", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
    "PULocationID", "DOLocationID", "fare_amount", "tip_amount", "total_amount",
)
_PLAIN_SQL = S.with_(S.TRIPS) + f"SELECT {', '.join(VENDOR_COLUMNS)} FROM trips"


@query(_PLAIN_SQL)
def ctas_plain(spark, sf_dir):
    rows = B.trips(spark, sf_dir, *VENDOR_COLUMNS)
    return tables.replace_table(rows, new_table("plain"), new_folder(spark, "plain"))


def layouts_of(spark, rows, key):
    """The same rows as a plain table, one partitioned by month, and one also ordered by ``key``."""
    plain = tables.replace_table(rows, new_table("plain"), new_folder(spark, "plain"))

    def by_month(label, cluster_by=()):
        name, path = new_table(label), new_folder(spark, label)
        return tables.create_by_date(plain, name, PICKUP_MONTH, cluster_by, path)

    partitioned, clustered = by_month("dated"), by_month("clustered", [key])
    return {"plain": plain, "partitioned": partitioned, "clustered": clustered}


def vendor_layouts(spark, rows):
    return layouts_of(spark, rows, "VendorID")


def base_layouts(spark, rows):
    return layouts_of(spark, rows, "dispatching_base_num")


def select_days(layout, table, first, last):
    """Rows of whole days, by the partition column where the layout has one."""
    if layout == "plain":
        return table.filter(M.days_between("pickup_datetime", first, last))
    return tables.between_dates(table, PICKUP_MONTH, first, last)


@query(
    S.with_(S.TRIPS)
    + """SELECT DISTINCT VendorID FROM trips
         WHERE CAST(pickup_datetime AS DATE) BETWEEN DATE '1997-06-01' AND DATE '1997-06-30'"""
)
def ctas_partitioned(spark, sf_dir):
    rows = B.trips(spark, sf_dir, *VENDOR_COLUMNS)
    table = tables.create_by_date(
        rows, new_table("dated"), PICKUP_MONTH, path=new_folder(spark, "dated")
    )
    june = tables.between_dates(table, PICKUP_MONTH, "1997-06-01", "1997-06-30")
    return reports.distinct_values(june, "VendorID")


PICKUP_DAY = tables.DateLayout("pickup_datetime", "day")


@query(
    S.with_(S.DURATIONS)
    + """SELECT CAST(pickup_datetime AS DATE) AS pickup_date, count(*) AS trips, max(dropoff_datetime) AS last_dropoff
         FROM durations WHERE CAST(pickup_datetime AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
         GROUP BY 1"""
)
def ctas_partitioned_by_day(spark, sf_dir):
    table = tables.create_by_date(
        B.durations(spark, sf_dir), new_table("daily"), PICKUP_DAY, path=new_folder(spark, "daily")
    )
    chosen = tables.between_dates(table, PICKUP_DAY, "2024-01-05", "2024-01-20")
    return chosen.groupBy(F.col(PICKUP_DAY.column).alias("pickup_date")).agg(
        F.count(F.lit(1)).alias("trips"), F.max("dropoff_datetime").alias("last_dropoff")
    )


@query(
    S.with_(S.TRIPS)
    + """, answer AS (SELECT count(*) AS trips FROM trips
             WHERE CAST(pickup_datetime AS DATE) BETWEEN DATE '1997-06-01' AND DATE '1998-12-31'
               AND VendorID = 1)
         SELECT layout, trips FROM answer, (VALUES ('plain'), ('partitioned'), ('clustered')) l(layout)"""
)
def count_vendor_in_range(spark, sf_dir):
    layouts = vendor_layouts(spark, B.trips(spark, sf_dir, *VENDOR_COLUMNS))
    counts = [
        reports.row_count(
            select_days(layout, table, "1997-06-01", "1998-12-31").filter("VendorID = 1")
        ).withColumn("layout", F.lit(layout))
        for layout, table in layouts.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def trip_layouts(spark, trips, trips_in_a_group):
    """The same trips by month and vendor, without and with Bloom filters on the trip, which nothing is ordered by."""
    options = {"dated": {}, "bloom": tables.bloom_options({"trip_id": trips_in_a_group})}
    return {
        label: tables.create_by_date(
            trips, new_table(label), PICKUP_MONTH, ["VendorID"], new_folder(spark, label), **more
        )
        for label, more in options.items()
    }


@query(
    """WITH trips AS (SELECT 8 * l_orderkey + l_linenumber AS trip_id, l_extendedprice AS fare_amount FROM lineitem),
            wanted AS (SELECT max(trip_id) // 16 * 8 AS absent, min(trip_id) FILTER (trip_id > (SELECT max(trip_id) // 16 * 8 FROM trips)) AS rare FROM trips),
            asked AS (SELECT unnest(['absent', 'rare']) AS kind, unnest([absent, rare]) AS trip_id FROM wanted)
       SELECT layout, kind, CAST(count(fare_amount) AS BIGINT) AS trips, CAST(sum(CAST(fare_amount AS DECIMAL(18,2))) AS DOUBLE) AS fares
       FROM (VALUES ('dated'), ('bloom')) l(layout), asked LEFT JOIN trips USING (trip_id) GROUP BY 1, 2"""
)
def trip_lookup_bloom(spark, sf_dir):
    """Single trips by their number in either layout: one that is there, and one that is not, amid the others."""
    trips = B.trips(spark, sf_dir, "trip_id", "VendorID", "pickup_datetime", "fare_amount")
    last = trips.agg(F.coalesce(F.max("trip_id"), F.lit(0))).first()[0]
    absent = last // 16 * 8
    rare = trips.agg(F.min(F.when(F.col("trip_id") > absent, F.col("trip_id")))).first()[0]
    found = []
    for layout, table in trip_layouts(spark, trips, 1_000_000).items():
        for kind, trip in (("absent", absent), ("rare", rare)):
            row = table.filter(F.col("trip_id") == trip)
            row = row.agg(F.count(F.lit(1)).alias("trips"), exact_sum("fare_amount").alias("fares"))
            found.append(row.select(F.lit(layout).alias("layout"), F.lit(kind).alias("kind"), "trips", "fares"))
    return reduce(DataFrame.unionByName, found)


def _clustered_fhv(spark, sf_dir):
    """For-hire trips without three columns, by pickup month and ordered by base."""
    columns = ("dispatching_base_num", "pickup_datetime", "dropoff_datetime", "Affiliated_base_number")
    rows = B.fhv(spark, sf_dir, *columns)
    return tables.create_by_date(
        rows, new_table("bases"), PICKUP_MONTH, ["dispatching_base_num"], new_folder(spark, "bases")
    )


@query(
    S.with_(S.FHV)
    + """SELECT dispatching_base_num, count(*) AS trips, max(dropoff_datetime) AS last_dropoff
         FROM fhv GROUP BY 1"""
)
def ctas_partitioned_clustered(spark, sf_dir):
    return _clustered_fhv(spark, sf_dir).groupBy("dispatching_base_num").agg(
        F.count(F.lit(1)).alias("trips"), F.max("dropoff_datetime").alias("last_dropoff")
    )


@query(
    S.with_(S.FHV)
    + """, rides AS (SELECT CASE SR_Flag WHEN 'N' THEN 'B00001' ELSE dispatching_base_num END AS base,
                            pickup_datetime, SR_Flag FROM fhv),
         bases AS (SELECT base, min(pickup_datetime) AS first_pickup FROM rides GROUP BY 1)
         SELECT CAST(date_trunc('month', first_pickup) AS DATE) AS cohort, SR_Flag, count(*) AS trips,
                count(*) FILTER (pickup_datetime < first_pickup + INTERVAL 365 DAY) AS first_year
         FROM rides JOIN bases USING (base) GROUP BY 1, 2"""
)
def clustered_join(spark, sf_dir):
    """Trips by the month in which their base began, of tables in buckets of the base. One base has half the trips."""
    base = F.when(F.col("SR_Flag") == "N", F.lit("B00001")).otherwise(F.col("dispatching_base_num"))
    trips = B.fhv(spark, sf_dir, "dispatching_base_num", "pickup_datetime", "SR_Flag")
    trips = trips.select(base.alias("base"), "pickup_datetime", "SR_Flag")
    both = []
    for label, make in (
        ("rides", lambda: trips),
        ("bases", lambda: both[0].rows(spark).groupBy("base").agg(F.min("pickup_datetime").alias("first_pickup"))),
    ):
        name, path = new_table(label), new_folder(spark, label)
        both.append(clustered.create_clustered(make(), name, "base", BASE_BUCKETS, path=path, hot=new_table("hot")))
    joined = clustered.join_clustered(spark, *both)
    year = F.col("pickup_datetime") < F.col("first_pickup") + F.expr("INTERVAL 365 DAYS")
    return joined.groupBy(M.month_date("first_pickup").alias("cohort"), "SR_Flag").agg(
        F.count(F.lit(1)).alias("trips"), F.count_if(year).alias("first_year")
    )


BASE_BUCKETS = 16


@query(
    S.with_(S.FHV)
    + """SELECT dispatching_base_num, pickup_datetime, dropoff_datetime, Affiliated_base_number FROM fhv
         WHERE pickup_datetime BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-03-31'
           AND dispatching_base_num IN ('B00001', 'B00007', 'B00042')"""
)
def fhv_base_in_range(spark, sf_dir):
    first, last = "1997-01-01", "1997-03-31"
    table = tables.between_dates(_clustered_fhv(spark, sf_dir), PICKUP_MONTH, first, last)
    return table.filter(
        M.moments_between("pickup_datetime", first, last)
        & F.col("dispatching_base_num").isin("B00001", "B00007", "B00042")
    ).drop(PICKUP_MONTH.column)


@query(
    S.with_(S.TRADE)
    + """SELECT make_date(year, month, 1) AS trade_date, flow, count(*) AS records,
                CAST(sum(fob) AS BIGINT) AS fob, CAST(sum(net_weight) AS BIGINT) AS net_weight
         FROM trade GROUP BY 1, 2"""
)
def trade_partitioned(spark, sf_dir):
    rows = T.with_trade_date(B.trade(spark, sf_dir))
    table = tables.create_partitioned(
        rows, new_table("trade"), ["trade_date"], new_folder(spark, "trade")
    )
    return table.groupBy("trade_date", "flow").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum("fob").alias("fob"),
        F.sum("net_weight").alias("net_weight"),
    )


@query(
    S.with_(S.TRADE)
    + """, by_year AS (SELECT CAST(year AS VARCHAR) AS period, flow, fob FROM trade
                       UNION ALL SELECT 'all', flow, fob FROM trade)
         SELECT period, CAST(coalesce(sum(fob) FILTER (flow = 'exports'), 0) AS BIGINT) AS exports,
                CAST(coalesce(sum(fob) FILTER (flow = 'imports'), 0) AS BIGINT) AS imports,
                exports - imports AS balance
         FROM by_year GROUP BY 1"""
)
def trade_both_flows(spark, sf_dir):
    """Exports, imports and again exports loaded into one table; the balance of it."""
    folder = new_folder(spark, "both-flows")
    for flow in (T.EXPORTS, T.IMPORTS, T.EXPORTS):
        rows = B.trade(spark, sf_dir, "year", "month", "fob", flow=flow).withColumn("flow", F.lit(flow))
        files.write_load(T.with_trade_date(rows), folder, ["flow", "trade_date"], flow)
    return T.trade_balance(sources.read_parquet(spark, folder))


@query(
    S.with_(S.TRIPS)
    + """SELECT CAST(date_trunc('month', pickup_datetime) AS DATE) AS partition_id, count(*) AS total_rows
         FROM trips GROUP BY 1 ORDER BY 2 DESC"""
)
def partition_row_counts(spark, sf_dir):
    rows = B.trips(spark, sf_dir, "VendorID", "pickup_datetime")
    table = tables.create_by_date(
        rows, new_table("counted"), PICKUP_MONTH, path=new_folder(spark, "counted")
    )
    return tables.partition_row_counts(table, PICKUP_MONTH.column)


@query(
    S.with_(S.TRIPS)
    + """SELECT CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month, count(*) AS rows,
                min(trip_distance) AS min_trip_distance, max(trip_distance) AS max_trip_distance,
                min(VendorID) AS min_VendorID, max(VendorID) AS max_VendorID
         FROM trips GROUP BY 1, 2"""
)
def footer_report(spark, sf_dir):
    """Trips and the range of their distances in each month, as the files' footers have them."""
    folder = _monthly_folders(spark, sf_dir, "pickup_datetime", "trip_distance", "VendorID")
    return reports.footer_report(spark, folder, ["year", "month"], ["trip_distance", "VendorID"])


@query(
    S.with_(S.FHV)
    + """, columns AS (SELECT row_number() OVER () AS position, column_name, column_type
                       FROM (DESCRIBE SELECT dispatching_base_num, pickup_datetime, dropoff_datetime,
                             CAST(PULocationID AS INTEGER) AS PULocationID,
                             CAST(DOLocationID AS INTEGER) AS DOLocationID, SR_Flag, Affiliated_base_number
                             FROM fhv) d)
         SELECT CAST(position AS INTEGER) AS position, column_name,
                CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
                                 WHEN 'TIMESTAMP' THEN 'timestamp' ELSE lower(column_type) END AS data_type
         FROM columns"""
)
def schema_ddl(spark, sf_dir):
    return tables.describe_columns(sources.infer_csv(spark, _fhv_csv(spark, sf_dir)))

"""Trip reports: projections, filters, joins with zones, aggregates, top lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from fareflow.functions import moments as M
from fareflow.functions.money import exact_avg, exact_sum
from fareflow.operators import cleaning, feeds, reports, revenue, sketches
from fareflow.operators import zones as Z
from fareflow.plans import bindings as B
from fareflow.plans import sql as S
from fareflow.plans.registry import query
from fareflow.schemas import AVERAGE_MEASURES, GREEN_FEED, YELLOW_FEED
from fareflow.session import new_folder, new_table

DAY = "1997-05-28"


def both_feeds(spark, sf_dir, *columns):
    """Green and yellow read under their own names, then united; ``columns`` in common names."""
    columns = columns or B.FEED_COLUMNS
    return feeds.union_feeds(
        [
            (B.green_feed(spark, sf_dir, *columns), GREEN_FEED),
            (B.yellow_feed(spark, sf_dir, *columns), YELLOW_FEED),
        ],
        columns,
    )


# --- feeds and projections ------------------------------------------------------------------


@query(
    S.with_(S.TRIPS)
    + """SELECT VendorID, pickup_datetime, dropoff_datetime, PULocationID, DOLocationID,
                passenger_count, trip_distance, fare_amount, extra, tip_amount, total_amount,
                payment_type, service_type
         FROM trips"""
)
def union_feeds(spark, sf_dir):
    return both_feeds(spark, sf_dir)


@query(
    S.with_(S.TRIPS)
    + """SELECT pickup_datetime, dropoff_datetime, PULocationID, DOLocationID FROM trips"""
)
def project_columns(spark, sf_dir):
    wanted = ["pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID"]
    return B.trips(spark, sf_dir, *wanted).select(*wanted)


@query(
    S.with_(S.FHV)
    + """SELECT dispatching_base_num, pickup_datetime, dropoff_datetime, Affiliated_base_number
         FROM fhv"""
)
def project_except(spark, sf_dir):
    view = new_table("except")
    B.fhv(spark, sf_dir).createOrReplaceTempView(view)
    return spark.sql(f"SELECT * EXCEPT (PULocationID, DOLocationID, SR_Flag) FROM {view}")


@query(
    S.with_(S.TRIPS)
    + """SELECT CAST(pickup_datetime AS DATE) AS pickup_date,
                CAST(dropoff_datetime AS DATE) AS dropoff_date, PULocationID, DOLocationID
         FROM trips"""
)
def project_dates(spark, sf_dir):
    rows = B.trips(
        spark, sf_dir, "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID"
    )
    return rows.select(
        F.to_date("pickup_datetime").alias("pickup_date"),
        F.to_date("dropoff_datetime").alias("dropoff_date"),
        "PULocationID",
        "DOLocationID",
    )


# --- filters --------------------------------------------------------------------------------


@query(
    S.with_(S.TRIPS)
    + """SELECT pickup_datetime, dropoff_datetime, PULocationID, DOLocationID FROM trips
         WHERE service_type = 'green'"""
)
def filter_equality(spark, sf_dir):
    wanted = ["pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID"]
    rows = B.trips(spark, sf_dir, *wanted, "service_type")
    return rows.filter(F.col("service_type") == "green").select(*wanted)


@query(
    S.with_(S.TRIPS)
    + f"SELECT count(*) AS trips FROM trips WHERE CAST(pickup_datetime AS DATE) = DATE '{DAY}'"
)
def trips_on_day(spark, sf_dir):
    rows = B.trips(spark, sf_dir, "pickup_datetime")
    return reports.row_count(rows.filter(M.on_day("pickup_datetime", DAY)))


@query(
    S.with_(S.DURATIONS)
    + """SELECT count(*) AS trips FROM durations
         WHERE CAST(pickup_datetime AS DATE) = DATE '2024-01-15'
           AND CAST(dropoff_datetime AS DATE) = DATE '2024-01-15'"""
)
def trips_within_day(spark, sf_dir):
    day = "2024-01-15"
    return reports.row_count(
        B.durations(spark, sf_dir).filter(
            M.on_day("pickup_datetime", day) & M.on_day("dropoff_datetime", day)
        )
    )


@query(
    S.with_(S.TRIPS)
    + """SELECT DISTINCT VendorID FROM trips
         WHERE CAST(pickup_datetime AS DATE) BETWEEN DATE '1997-06-01' AND DATE '1997-06-30'"""
)
def distinct_vendors_between(spark, sf_dir):
    rows = B.trips(spark, sf_dir, "VendorID", "pickup_datetime")
    june = rows.filter(M.days_between("pickup_datetime", "1997-06-01", "1997-06-30"))
    return reports.distinct_values(june, "VendorID")


@query(
    S.with_(S.DURATIONS)
    + """SELECT count(*) FILTER (WHERE CAST(pickup_datetime AS DATE)
                                 BETWEEN DATE '2024-01-01' AND DATE '2024-01-15') AS by_day,
                count(*) FILTER (WHERE pickup_datetime BETWEEN TIMESTAMP '2024-01-01 00:00:00'
                                 AND TIMESTAMP '2024-01-15 00:00:00') AS by_moment
         FROM durations"""
)
def range_by_day_and_moment(spark, sf_dir):
    bounds = ("pickup_datetime", "2024-01-01", "2024-01-15")
    return B.durations(spark, sf_dir).agg(
        F.count_if(M.days_between(*bounds)).alias("by_day"),
        F.count_if(M.moments_between(*bounds)).alias("by_moment"),
    )


@query(
    S.with_(S.FHV)
    + """SELECT count(*) AS trips FROM fhv
         WHERE extract(year FROM CAST(pickup_datetime AS DATE)) = 1997"""
)
def fhv_count_year(spark, sf_dir):
    rows = B.fhv(spark, sf_dir, "pickup_datetime")
    return reports.row_count(rows.filter(M.in_year("pickup_datetime", 1997)))


@query(
    S.with_(S.FHV)
    + "SELECT count(*) AS trips FROM fhv WHERE PULocationID IS NULL AND DOLocationID IS NULL"
)
def fhv_both_unlocated(spark, sf_dir):
    rows = B.fhv(spark, sf_dir, "PULocationID", "DOLocationID")
    return reports.row_count(
        rows.filter(F.col("PULocationID").isNull() & F.col("DOLocationID").isNull())
    )


@query(
    S.with_(S.TRIPS)
    + """SELECT VendorID, passenger_count, trip_distance FROM trips
         WHERE passenger_count IS DISTINCT FROM 0"""
)
def clean_drop_zero(spark, sf_dir):
    return cleaning.drop_zero(
        B.trips(spark, sf_dir, "VendorID", "passenger_count", "trip_distance")
    )


@query(
    S.with_(S.TRIPS)
    + """SELECT VendorID, coalesce(passenger_count, 0) AS passenger_count, trip_distance
         FROM trips"""
)
def clean_fill_zero(spark, sf_dir):
    return cleaning.fill_zero(
        B.trips(spark, sf_dir, "VendorID", "passenger_count", "trip_distance")
    )


@query(
    S.with_(S.TRIPS)
    + """SELECT 'read' AS state, count(*) AS rows,
                count(*) FILTER (WHERE passenger_count IS NULL) AS missing,
                count(*) FILTER (WHERE passenger_count = 0) AS zero FROM trips
         UNION ALL
         SELECT 'zero_dropped', count(*), count(*) FILTER (WHERE passenger_count IS NULL),
                count(*) FILTER (WHERE passenger_count = 0)
         FROM (SELECT * FROM trips WHERE passenger_count IS NULL OR passenger_count <> 0) d
         UNION ALL
         SELECT 'missing_filled', count(*), count(*) FILTER (WHERE passenger_count IS NULL),
                count(*) FILTER (WHERE passenger_count = 0)
         FROM (SELECT coalesce(passenger_count, 0) AS passenger_count FROM trips) f"""
)
def quality_counters(spark, sf_dir):
    return cleaning.quality_counters(B.trips(spark, sf_dir, "passenger_count"))


# --- aggregates -----------------------------------------------------------------------------


@query(S.with_(S.TRIPS) + "SELECT service_type, count(*) AS trips FROM trips GROUP BY service_type")
def trips_per_service(spark, sf_dir):
    return reports.count_by(both_feeds(spark, sf_dir, "VendorID"), "service_type")


@query(
    S.with_(S.TRIPS)
    + "SELECT PULocationID AS revenue_zone, date_trunc('month', pickup_datetime) AS revenue_month, service_type,"
    + ", ".join(f"{S.money(column)} AS {name}" for column, name in B.TRIP_SUMS.items())
    + ", "
    + ", ".join(
        f"{S.money(column)} / count({column}) AS {name}" for column, name in AVERAGE_MEASURES.items()
    )
    + " FROM trips GROUP BY 1, 2, 3"
)
def monthly_revenue(spark, sf_dir):
    columns = ("PULocationID", "pickup_datetime", *B.TRIP_SUMS, *AVERAGE_MEASURES)
    return revenue.monthly_revenue(both_feeds(spark, sf_dir, *columns), sums=B.TRIP_SUMS)


@query(
    S.with_(S.TRIPS)
    + """, fine AS (
             SELECT CAST(PULocationID AS BIGINT) AS zone, service_type,
                    CAST(fare_amount AS DECIMAL(18,2)) * (1 - CAST(extra AS DECIMAL(4,2))) AS net,
                    trip_distance / 8 AS parts FROM trips)
         SELECT zone, service_type, CAST(sum(net) AS DOUBLE) AS net, round(CAST(sum(net) AS DOUBLE) / count(net), 6) AS average,
                round(sum(parts), 6) AS parts, round(sum(parts) / count(parts), 6) AS average_parts
         FROM fine GROUP BY 1, 2"""
)
def revenue_fine_amounts(spark, sf_dir):
    """Amounts of four decimals and distances of three."""
    trips = both_feeds(spark, sf_dir, "PULocationID", "fare_amount", "extra", "trip_distance")
    net = F.col("fare_amount") * (1 - F.col("extra"))
    parts = F.col("trip_distance") / 8
    return trips.groupBy(F.col("PULocationID").alias("zone"), "service_type").agg(
        F.round(exact_sum(net), 4).alias("net"), F.round(exact_avg(net), 6).alias("average"),
        F.round(exact_sum(parts), 6).alias("parts"), F.round(exact_avg(parts), 6).alias("average_parts"),
    )


SINCE = "2024-01-10"


def _hourly(spark, sf_dir, service):
    return revenue.hourly_revenue(B.hourly_feed(spark, sf_dir, service), "pickup_datetime", SINCE)


@query(
    S.with_(S.HOURLY)
    + """SELECT "hour", zone, amount, number_records FROM hourly WHERE service_type = 'green'"""
)
def hourly_revenue(spark, sf_dir):
    return _hourly(spark, sf_dir, "green")


@query(S.with_(S.HOURLY, S.GREEN_YELLOW) + "SELECT * FROM both_feeds")
def revenue_green_yellow(spark, sf_dir):
    return revenue.combine_feeds(_hourly(spark, sf_dir, "green"), _hourly(spark, sf_dir, "yellow"))


@query(
    S.with_(S.HOURLY, S.GREEN_YELLOW, S.ZONES)
    + """SELECT "hour", green_amount, green_number_records, yellow_amount, yellow_number_records,
                z.Borough, z.Zone
         FROM both_feeds b JOIN zones z ON b.zone = z.LocationID"""
)
def revenue_by_zone_named(spark, sf_dir):
    return Z.revenue_by_zone_named(revenue_green_yellow(spark, sf_dir), B.zones(spark, sf_dir))


@query(
    S.with_(S.FHV)
    + """SELECT count(DISTINCT dispatching_base_num) AS bases FROM fhv
         WHERE extract(year FROM CAST(pickup_datetime AS DATE)) = 1997"""
)
def fhv_distinct_bases(spark, sf_dir):
    rows = B.fhv(spark, sf_dir, "dispatching_base_num", "pickup_datetime")
    return reports.distinct_count(
        rows.filter(M.in_year("pickup_datetime", 1997)), "dispatching_base_num", "bases"
    )


@query(S.with_(S.FHV) + "SELECT count(DISTINCT Affiliated_base_number) AS bases FROM fhv")
def fhv_distinct_affiliated(spark, sf_dir):
    rows = B.fhv(spark, sf_dir, "Affiliated_base_number")
    return reports.distinct_count(rows, "Affiliated_base_number", "bases")


@query(
    S.with_(S.DURATIONS)
    + """SELECT CAST(pickup_datetime AS DATE) AS pickup_date,
                CAST(max(date_sub('second', pickup_datetime, dropoff_datetime)) AS BIGINT) AS trip_duration
         FROM durations GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"""
)
def longest_trip_by_day(spark, sf_dir):
    seconds = M.duration_seconds("pickup_datetime", "dropoff_datetime")
    return reports.max_by_day(
        B.durations(spark, sf_dir), "pickup_datetime", seconds, "trip_duration", n=5
    )


@query(
    S.with_(S.TRIPS)
    + """SELECT CAST(pickup_datetime AS DATE) AS pickup_date, max(trip_distance) AS max_trip_distance
         FROM trips GROUP BY 1 ORDER BY 2 DESC, 1"""
)
def max_distance_by_day(spark, sf_dir):
    rows = B.trips(spark, sf_dir, "pickup_datetime", "trip_distance")
    return reports.max_by_day(rows, "pickup_datetime", "trip_distance", "max_trip_distance")


@query(
    S.with_(S.DURATIONS)
    + """SELECT CAST(max(date_sub('second', pickup_datetime, dropoff_datetime)) AS DOUBLE) / 3600 AS hours
         FROM durations"""
)
def trip_duration_max(spark, sf_dir):
    seconds = M.duration_seconds("pickup_datetime", "dropoff_datetime")
    return B.durations(spark, sf_dir).agg((F.max(seconds) / F.lit(3600)).alias("hours"))


_WRAPPED = """SELECT CAST(pickup_datetime AS DATE) AS pickup_date,
       CAST(max(((date_sub('second', pickup_datetime, dropoff_datetime) % 86400) + 86400) % 86400)
            AS INTEGER) AS trip_duration,
       CAST(sum(((date_sub('second', pickup_datetime, dropoff_datetime) % 86400) + 86400) % 86400)
            AS BIGINT) AS all_durations
FROM durations GROUP BY 1"""


def _wrapped(spark, sf_dir, seconds):
    rows = B.durations(spark, sf_dir).select("pickup_datetime", seconds.alias("seconds"))
    return rows.groupBy(F.to_date("pickup_datetime").alias("pickup_date")).agg(
        F.max("seconds").alias("trip_duration"), F.sum("seconds").alias("all_durations")
    )


@query(S.with_(S.DURATIONS) + _WRAPPED)
def trip_seconds_of_day(spark, sf_dir):
    return _wrapped(spark, sf_dir, M.seconds_of_day("pickup_datetime", "dropoff_datetime"))


@query(S.with_(S.DURATIONS) + _WRAPPED)
def trip_duration_udf(spark, sf_dir):
    return _wrapped(spark, sf_dir, M.seconds_of_day_udf("pickup_datetime", "dropoff_datetime"))


@query(
    S.with_(S.TRIPS)
    + f"""SELECT passenger_count, count(*) AS trips FROM trips
          WHERE CAST(pickup_datetime AS DATE) = DATE '{DAY}' GROUP BY passenger_count"""
)
def passengers_on_day(spark, sf_dir):
    rows = B.trips(spark, sf_dir, "pickup_datetime", "passenger_count")
    return reports.count_by(rows.filter(M.on_day("pickup_datetime", DAY)), "passenger_count")


@query(
    S.with_(S.FHV)
    + """SELECT dispatching_base_num, count(*) AS trips FROM fhv
         GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1"""
)
def top_base(spark, sf_dir):
    return reports.top_keys(B.fhv(spark, sf_dir, "dispatching_base_num"), "dispatching_base_num")


def _kept(spark, states, label):
    """Sketches as they are kept: written once, read for every question."""
    folder = new_folder(spark, label)
    states.write.parquet(folder)
    return spark.read.schema(states.schema).parquet(folder)


_TOP = S.with_(S.FHV) + "SELECT {0}, count(*) AS trips FROM fhv GROUP BY {0} ORDER BY trips DESC, {0} LIMIT {1}"


@query(_TOP.format("dispatching_base_num", 3).replace("ORDER BY trips DESC, ", "ORDER BY trips DESC NULLS LAST, "))
def top_bases_sketched(spark, sf_dir):
    """The busiest bases by the sketches of each month, recounted."""
    rows = B.fhv(spark, sf_dir, "dispatching_base_num", "pickup_datetime")
    keys = ["dispatching_base_num"]
    states = sketches.frequent_states(rows, keys, [M.month_date("pickup_datetime").alias("month")])
    return sketches.top_keys(_kept(spark, states, "frequent"), rows.select(*keys), keys, 3)


@query(
    S.with_(S.FHV)
    + """SELECT PULocationID, DOLocationID, count(*) AS trips FROM fhv GROUP BY 1, 2
         ORDER BY trips DESC, PULocationID NULLS FIRST, DOLocationID NULLS FIRST LIMIT 5"""
)
def top_pairs_sketched(spark, sf_dir):
    """The busiest pairs of pickup and dropoff zone by the sketches of each flag, recounted."""
    rows = B.fhv(spark, sf_dir, "PULocationID", "DOLocationID", "SR_Flag")
    keys = ["PULocationID", "DOLocationID"]
    states = sketches.frequent_states(rows, keys, ["SR_Flag"])
    return sketches.top_keys(_kept(spark, states, "frequent"), rows.select(*keys), keys, 5)


@query(
    S.with_(S.FHV)
    + """, m AS (SELECT DISTINCT CAST(date_trunc('month', pickup_datetime) AS DATE) AS month, dispatching_base_num AS base
                 FROM fhv WHERE pickup_datetime IS NOT NULL),
         n AS (SELECT month, base, row_number() OVER (PARTITION BY base ORDER BY month) AS seen,
                      dense_rank() OVER (ORDER BY month) AS i FROM m),
         months AS (SELECT DISTINCT month, i FROM n),
         gone AS (SELECT i + 1 AS i, count(*) AS gone FROM n p
                  WHERE base IS NOT NULL AND NOT EXISTS (SELECT 1 FROM n q WHERE q.i = p.i + 1 AND q.base = p.base) GROUP BY 1)
         SELECT months.month, count(base) AS present, count(base) FILTER (seen = 1) AS new,
                count(base) FILTER (seen > 1) AS back, coalesce(max(gone), 0) AS gone
         FROM months JOIN n USING (i) LEFT JOIN gone USING (i) GROUP BY 1"""
)
def base_changes_by_month(spark, sf_dir):
    """Bases present, new, back and gone in each month, by the months' sketches."""
    rows = B.fhv(spark, sf_dir, "dispatching_base_num", "pickup_datetime").filter("pickup_datetime IS NOT NULL")
    states = sketches.distinct_states(rows, "dispatching_base_num", [M.month_date("pickup_datetime").alias("month")])
    return sketches.distinct_changes(_kept(spark, states, "distinct"), "month")


@query(
    S.with_(S.FHV)
    + """SELECT CAST(year(pickup_datetime) AS INTEGER) AS year, count(DISTINCT dispatching_base_num) AS bases
         FROM fhv GROUP BY 1"""
)
def bases_by_year_sketched(spark, sf_dir):
    """Distinct bases of each year by the sketches of its months."""
    rows = B.fhv(spark, sf_dir, "dispatching_base_num", "pickup_datetime")
    states = sketches.distinct_states(rows, "dispatching_base_num", [M.month_date("pickup_datetime").alias("month")])
    return sketches.distinct_in(_kept(spark, states, "distinct"), [F.year("month").alias("year")], "bases")


# --- zones ----------------------------------------------------------------------------------


@query(
    S.with_(S.FHV, S.ZONES)
    + "SELECT Zone, count(*) AS trips FROM fhv, zones WHERE LocationID = PULocationID GROUP BY ALL"
)
def trips_per_zone(spark, sf_dir):
    return Z.trips_per_zone(B.fhv(spark, sf_dir, "PULocationID"), B.zones(spark, sf_dir))


@query(
    S.with_(S.FHV, S.ZONES)
    + """, named AS (
             SELECT (SELECT max(Zone) FROM zones WHERE LocationID = PULocationID) AS a,
                    (SELECT max(Zone) FROM zones WHERE LocationID = DOLocationID) AS b
             FROM fhv)
         SELECT concat(ifnull(a, 'Unknown'), ' / ', ifnull(b, 'Unknown')) AS pickup_dropoff, count(*) AS trips
         FROM named GROUP BY ALL ORDER BY trips DESC, pickup_dropoff LIMIT 5"""
)
def top_zone_pair(spark, sf_dir):
    rows = B.fhv(spark, sf_dir, "PULocationID", "DOLocationID")
    return Z.top_zone_pairs(rows, B.zones(spark, sf_dir))


@query(
    S.with_(S.TRIPS, S.ZONES)
    + """, tips AS (
             SELECT tip_amount, (SELECT max(Zone) FROM zones WHERE LocationID = DOLocationID) AS dropoff_zone
             FROM trips WHERE PULocationID IN (SELECT LocationID FROM zones WHERE Zone = 'NATION_3'))
         SELECT dropoff_zone, max(tip_amount) AS max_tip_amount FROM tips GROUP BY ALL"""
)
def max_tip_from_zone(spark, sf_dir):
    rows = B.trips(spark, sf_dir, "PULocationID", "DOLocationID", "tip_amount")
    return Z.max_tip_from_zone(rows, B.zones(spark, sf_dir), "NATION_3")


# --- staging and facts ----------------------------------------------------------------------


@query(
    S.with_(S.TRIPS)
    + """, counts AS (SELECT CAST(year(pickup_datetime) AS INTEGER) AS year, service_type, count(*) AS trips
                      FROM trips WHERE year(pickup_datetime) IN (1997, 1998) GROUP BY 1, 2)
         SELECT year, service_type, trips,
                CAST(trips AS DOUBLE) / CAST(sum(trips) OVER (PARTITION BY year) AS DOUBLE) AS share
         FROM counts"""
)
def service_share_by_year(spark, sf_dir):
    rows = B.trips(spark, sf_dir, "pickup_datetime", "service_type")
    return reports.service_share(rows, [1997, 1998])


def _staged(spark, sf_dir, *columns):
    return B.fhv(spark, sf_dir, *columns).filter(M.in_year("pickup_datetime", 1997))


@query(
    S.with_(S.FHV)
    + """SELECT * FROM fhv WHERE pickup_datetime >= TIMESTAMP '1997-01-01 00:00:00'
                             AND pickup_datetime < TIMESTAMP '1998-01-01 00:00:00'"""
)
def stg_fhv_year(spark, sf_dir):
    return _staged(spark, sf_dir)


@query(
    S.with_(S.FHV, S.ZONES)
    + """SELECT f.*, pu.Zone AS pickup_zone, d.Zone AS dropoff_zone
         FROM fhv f JOIN zones pu ON f.PULocationID = pu.LocationID
                    JOIN zones d ON f.DOLocationID = d.LocationID
         WHERE year(pickup_datetime) = 1997"""
)
def fact_fhv_trips(spark, sf_dir):
    return Z.known_zone_trips(_staged(spark, sf_dir), B.zones(spark, sf_dir))


@query(
    S.with_(S.FHV, S.ZONES)
    + """SELECT CAST(date_trunc('month', pickup_datetime) AS DATE) AS month, count(*) AS trips
         FROM fhv JOIN zones pu ON PULocationID = pu.LocationID
                  JOIN zones d ON DOLocationID = d.LocationID
         WHERE year(pickup_datetime) = 1997 GROUP BY 1"""
)
def fhv_trips_per_month(spark, sf_dir):
    staged = _staged(spark, sf_dir, "pickup_datetime", "PULocationID", "DOLocationID")
    facts = Z.known_zone_trips(staged, B.zones(spark, sf_dir))
    return reports.trips_per_month(facts, "pickup_datetime")


@query(
    S.with_(S.TRIPS)
    + """, counts AS (SELECT strftime(pickup_datetime, '%Y-%m') AS period, count(*) AS rows FROM trips
                      WHERE year(pickup_datetime) = 1997 AND month(pickup_datetime) IN (2, 3) GROUP BY 1)
         SELECT period, rows FROM counts
         UNION ALL SELECT 'total', CAST(coalesce(sum(rows), 0) AS BIGINT) FROM counts"""
)
def rows_by_month(spark, sf_dir):
    rows = B.trips(spark, sf_dir, "pickup_datetime")
    return reports.rows_by_month(rows, "pickup_datetime", [(1997, 2), (1997, 3)])

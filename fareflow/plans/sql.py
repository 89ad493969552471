"""The feeds in SQL, for the check queries. Every definition joins all of its tables."""

from __future__ import annotations

_RIDES = """
    FROM lineitem
    LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey
"""

TRIPS = f"""trips AS (
    SELECT CAST(l_linenumber AS BIGINT) AS VendorID,
           o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime,
           CAST(nullif(c_nationkey, 7) AS BIGINT) AS PULocationID,
           CAST(nullif(s_nationkey, 7) AS BIGINT) AS DOLocationID,
           CAST(nullif(l_linenumber % 7, 3) AS DOUBLE) AS passenger_count,
           l_quantity AS trip_distance, l_extendedprice AS fare_amount, l_discount AS extra,
           l_tax AS tip_amount, o_totalprice AS total_amount,
           CASE WHEN l_linestatus = 'F' THEN 'green' ELSE 'yellow' END AS service_type,
           CAST(1 + l_linenumber % 4 AS DOUBLE) AS payment_type
    {_RIDES})"""

FHV = f"""fhv AS (
    SELECT 'B' || lpad(CAST(l_suppkey AS VARCHAR), 5, '0') AS dispatching_base_num,
           o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime,
           CAST(nullif(c_nationkey, 7) AS BIGINT) AS PULocationID,
           CAST(nullif(s_nationkey, 7) AS BIGINT) AS DOLocationID,
           l_returnflag AS SR_Flag,
           'B' || lpad(CAST(l_partkey % 50 AS VARCHAR), 5, '0') AS Affiliated_base_number
    {_RIDES})"""

ZONES = """zones AS (
    SELECT CAST(n_nationkey AS BIGINT) AS LocationID, r_name AS Borough, n_name AS Zone
    FROM nation JOIN region ON n_regionkey = r_regionkey
    WHERE n_nationkey < 20)"""

HOURLY = """hourly AS (
    SELECT CASE event_type WHEN 'purchase' THEN 'green' ELSE 'yellow' END AS service_type,
           date_trunc('hour', ts) AS "hour", nullif(user_id % 25, 7) AS zone,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount,
           count(*) AS number_records
    FROM events
    WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'
    GROUP BY 1, 2, 3)"""

GREEN_YELLOW = """both_feeds AS (
    SELECT coalesce(g."hour", y."hour") AS "hour", coalesce(g.zone, y.zone) AS zone,
           g.amount AS green_amount, g.number_records AS green_number_records,
           y.amount AS yellow_amount, y.number_records AS yellow_number_records
    FROM (SELECT * FROM hourly WHERE service_type = 'green') g
    FULL OUTER JOIN (SELECT * FROM hourly WHERE service_type = 'yellow') y
      ON g."hour" = y."hour" AND g.zone = y.zone)"""

DURATIONS = """durations AS (
    SELECT event_id, ts AS pickup_datetime,
           ts + to_days(CAST(event_id % 3 AS INTEGER))
              + CASE WHEN event_id % 2 = 0 THEN to_minutes(CAST(floor(value) AS INTEGER))
                     ELSE to_seconds(-CAST(floor(value) AS INTEGER)) END AS dropoff_datetime
    FROM events)"""

TRADE = """trade AS (
    SELECT CASE WHEN sr.r_name = 'AMERICA' THEN 'exports' ELSE 'imports' END AS flow,
           CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           CASE WHEN sr.r_name = 'AMERICA' THEN cn.n_name ELSE sn.n_name END AS destination_country,
           CASE WHEN sr.r_name = 'AMERICA' THEN cr.r_name ELSE sr.r_name END AS trade_bloc,
           CASE WHEN sr.r_name = 'AMERICA' THEN s_name ELSE c_name END AS origin_city,
           CASE WHEN sr.r_name = 'AMERICA' THEN sn.n_name ELSE cn.n_name END AS origin_state,
           p_brand AS section_cd, p_type AS section_ds,
           CAST(round(l_extendedprice * 100) AS BIGINT) AS fob,
           CAST(l_quantity AS BIGINT) AS net_weight
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN part ON l_partkey = p_partkey
    JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN region cr ON cn.n_regionkey = cr.r_regionkey
    JOIN nation sn ON s_nationkey = sn.n_nationkey JOIN region sr ON sn.n_regionkey = sr.r_regionkey
    WHERE (sr.r_name = 'AMERICA') <> (cr.r_name = 'AMERICA'))"""

RIDES = """rides AS (
    SELECT event_id, CAST(user_id AS INTEGER) AS vendorId,
           CAST(event_id % 6 AS INTEGER) AS passenger_count,
           CAST(CAST(value / 10 AS FLOAT) AS DOUBLE) AS trip_distance,
           CAST(1 + event_id % 4 AS INTEGER) AS payment_type,
           value AS total_amount,
           event_id % 100 NOT IN (0, 1, 2, 3, 4, 5, 6) AS ok
    FROM events)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def money(column: str) -> str:
    """An exact sum of a two-decimal amount."""
    return f"CAST(sum(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"

"""Questions on foreign trade."""

from __future__ import annotations

from fareflow.operators import trade as T
from fareflow.plans import bindings as B
from fareflow.plans import sql as S
from fareflow.plans.registry import query

PLACE = ("origin_state", "origin_city", "destination_country")


def _by_place_sql(flow: str) -> str:
    return S.with_(S.TRADE) + f"""
        SELECT origin_state, origin_city, destination_country,
               CAST(sum(fob) AS BIGINT) AS fob, CAST(sum(net_weight) AS BIGINT) AS net_weight
        FROM trade WHERE flow = '{flow}' GROUP BY 1, 2, 3"""


@query(_by_place_sql("exports"))
def exports_by_place(spark, sf_dir):
    return T.by_place(B.trade(spark, sf_dir, *PLACE, "fob", "net_weight", flow=T.EXPORTS))


@query(_by_place_sql("imports"))
def imports_by_place(spark, sf_dir):
    return T.by_place(B.trade(spark, sf_dir, *PLACE, "fob", "net_weight", flow=T.IMPORTS))


def _changes(*place: str) -> tuple[str, ...]:
    """Every place gets a line for every year, 0 where it did not trade, before the comparison."""
    names = ", ".join(place)
    return (
        S.TRADE,
        "exported AS (SELECT * FROM trade WHERE flow = 'exports')",
        f"grid AS (SELECT * FROM (SELECT DISTINCT {names} FROM exported) p,"
        " (SELECT unnest(generate_series(min(year), max(year))) AS year FROM exported) y)",
        f"""yearly AS (SELECT {names}, g.year, CAST(coalesce(sum(fob), 0) AS BIGINT) AS current_fob
            FROM grid g LEFT JOIN exported e USING ({names}, year) GROUP BY ALL)""",
        f"""changes AS (SELECT *, lag(current_fob) OVER (PARTITION BY {names} ORDER BY year) AS previous_fob
            FROM yearly)""",
    )


FULL_YEARS = """full_years AS (SELECT min(year) AS first, max(year) AS last
    FROM (SELECT year FROM trade GROUP BY 1 HAVING count(DISTINCT month) = 12) y)"""


def _full_years(spark, sf_dir):
    return T.full_years(B.trade(spark, sf_dir, "year", "month"))


def _biggest_sql(*place: str) -> str:
    names = ", ".join(place)
    return S.with_(
        *_changes(*place),
        FULL_YEARS,
        f"""last_year AS (SELECT {names}, previous_fob, current_fob, current_fob - previous_fob AS change_fob
            FROM changes WHERE year = (SELECT last FROM full_years))""",
    ) + f"""
        SELECT *, 'increase' AS direction,
               CAST(row_number() OVER (ORDER BY change_fob DESC, {names}) AS INTEGER) AS position FROM
            (SELECT * FROM last_year WHERE change_fob > 0 ORDER BY change_fob DESC, {names} LIMIT 5) u
        UNION ALL
        SELECT *, 'decrease' AS direction,
               CAST(row_number() OVER (ORDER BY change_fob, {names}) AS INTEGER) AS position FROM
            (SELECT * FROM last_year WHERE change_fob < 0 ORDER BY change_fob, {names} LIMIT 5) d"""


def _biggest(spark, sf_dir, place):
    """The changes of the last full year; the other years' orders are not read a second time."""
    _, last = _full_years(spark, sf_dir)
    rows = B.trade(spark, sf_dir, "year", *place, "fob", flow=T.EXPORTS, years=(last - 1, last))
    return T.biggest_changes(rows, place, last)


@query(_biggest_sql("origin_state", "origin_city"))
def export_change_by_city(spark, sf_dir):
    return _biggest(spark, sf_dir, ("origin_state", "origin_city"))


@query(_biggest_sql("origin_state"))
def export_change_by_state(spark, sf_dir):
    return _biggest(spark, sf_dir, ("origin_state",))


@query(
    S.with_(*_changes("origin_state", "origin_city"))
    + """SELECT origin_state, origin_city, CAST(year AS INTEGER) AS year, previous_fob, current_fob,
                current_fob - previous_fob AS change_fob
         FROM changes WHERE previous_fob + current_fob > 0"""
)
def export_changes_by_city_and_year(spark, sf_dir):
    place = ("origin_state", "origin_city")
    rows = B.trade(spark, sf_dir, "year", *place, "fob", flow=T.EXPORTS)
    return T.yearly_changes(rows, place, *T.year_span(rows))


@query(
    S.with_(S.TRADE)
    + """, yearly AS (SELECT year, destination_country, CAST(sum(fob) AS BIGINT) AS fob FROM trade GROUP BY 1, 2)
         SELECT * FROM (SELECT *, CAST(rank() OVER (PARTITION BY year ORDER BY fob DESC) AS INTEGER) AS position
                        FROM yearly) r WHERE position <= 3"""
)
def top_partners_by_year(spark, sf_dir):
    return T.top_partners(B.trade(spark, sf_dir, "year", "destination_country", "fob"))


@query(
    S.with_(S.TRADE)
    + """, signed AS (
             SELECT CAST(year AS VARCHAR) AS period, flow, fob FROM trade
             UNION ALL SELECT 'all', flow, fob FROM trade)
         SELECT period,
                CAST(coalesce(sum(fob) FILTER (WHERE flow = 'exports'), 0) AS BIGINT) AS exports,
                CAST(coalesce(sum(fob) FILTER (WHERE flow = 'imports'), 0) AS BIGINT) AS imports,
                CAST(sum(CASE flow WHEN 'exports' THEN fob ELSE -fob END) AS BIGINT) AS balance
         FROM signed GROUP BY period"""
)
def trade_balance(spark, sf_dir):
    return T.trade_balance(B.trade(spark, sf_dir, "year", "flow", "fob"))


@query(
    S.with_(S.TRADE, FULL_YEARS)
    + """, years AS (SELECT CAST(unnest(generate_series(first, last)) AS INTEGER) AS year FROM full_years),
         yearly AS (SELECT destination_country, y.year, coalesce(sum(t.fob), 0) AS fob
                    FROM (SELECT DISTINCT destination_country FROM trade WHERE year IN (SELECT year FROM years)) c
                    CROSS JOIN years y LEFT JOIN trade t USING (destination_country, year) GROUP BY 1, 2)
         SELECT destination_country, last + 1 AS year,
                round(regr_intercept(CAST(fob AS DOUBLE), CAST(year - first AS DOUBLE))
                      + (last + 1 - first) * regr_slope(CAST(fob AS DOUBLE), CAST(year - first AS DOUBLE)), 2) AS forecast_fob
         FROM yearly, full_years GROUP BY 1, first, last ORDER BY 3 DESC, 1 LIMIT 5"""
)
def partner_forecast(spark, sf_dir):
    """The year after the last full one, by all full years."""
    first, last = _full_years(spark, sf_dir)
    rows = B.trade(spark, sf_dir, "year", "destination_country", "fob", years=(first, last))
    return T.partner_forecast(rows, first, last)


@query(
    S.with_(S.TRADE)
    + """, totals AS (
             SELECT flow, section_cd, 'fob' AS measure, CAST(sum(fob) AS BIGINT) AS total FROM trade GROUP BY 1, 2
             UNION ALL
             SELECT flow, section_cd, 'net_weight', CAST(sum(net_weight) AS BIGINT) FROM trade GROUP BY 1, 2)
         SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY flow, measure
                                       ORDER BY total DESC, section_cd) AS INTEGER) AS position
                        FROM totals) r WHERE position <= 5"""
)
def top_sections(spark, sf_dir):
    return T.top_sections(B.trade(spark, sf_dir, "flow", "section_cd", "fob", "net_weight"))


@query(
    S.with_(S.TRADE)
    + """, totals AS (SELECT flow, section_cd, sum(fob) AS fob, sum(net_weight) AS net_weight
                      FROM trade GROUP BY 1, 2)
         SELECT flow, section_cd,
                CAST(fob AS DOUBLE) / CAST(sum(fob) OVER (PARTITION BY flow) AS DOUBLE) AS fob_share,
                CAST(net_weight AS DOUBLE) / CAST(sum(net_weight) OVER (PARTITION BY flow) AS DOUBLE)
                    AS net_weight_share
         FROM totals"""
)
def section_share(spark, sf_dir):
    return T.section_share(B.trade(spark, sf_dir, "flow", "section_cd", "fob", "net_weight"))


def _top_section_sql(*place: str) -> str:
    names = ", ".join(place)
    return S.with_(S.TRADE) + f""", totals AS (
            SELECT flow, {names}, section_cd, CAST(sum(fob) AS BIGINT) AS fob FROM trade GROUP BY ALL)
        SELECT flow, {names}, section_cd, fob FROM (
            SELECT *, row_number() OVER (PARTITION BY flow, {names} ORDER BY fob DESC, section_cd) AS n
            FROM totals) r WHERE n = 1"""


@query(_top_section_sql("origin_state"))
def top_section_by_state(spark, sf_dir):
    rows = B.trade(spark, sf_dir, "flow", "origin_state", "section_cd", "fob")
    return T.top_section_of(rows, "origin_state")


@query(_top_section_sql("origin_state", "origin_city"))
def top_section_by_city(spark, sf_dir):
    rows = B.trade(spark, sf_dir, "flow", "origin_state", "origin_city", "section_cd", "fob")
    return T.top_section_of(rows, "origin_state", "origin_city")

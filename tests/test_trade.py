"""Trade questions against plain Python on random rows with gaps, ties and a hot city."""

import json
import random
from collections import defaultdict

import pytest
from pyspark.errors import PySparkException

from fareflow.operators import trade as T
from fareflow.schemas import TRADE
from fareflow.sources.payload import payload_rejects, read_trade_payload
from tests.conftest import plan, rows

COLUMNS = ("flow", "year", "month", "destination_country", "origin_city", "origin_state", "section_cd", "fob", "net_weight")
SCHEMA = (
    "flow string, year int, month int, destination_country string, origin_city string, origin_state string,"
    " section_cd string, fob bigint, net_weight bigint"
)


@pytest.fixture(scope="module")
def data():
    draw = random.Random(11)
    out = []
    for i in range(1500):
        city = "Hot" if i % 3 == 0 else f"C{draw.randrange(12)}"
        year = draw.choice([1997, 1999, 2000, 2001])
        out.append((
            draw.choice(["exports", "imports"]), year, draw.randrange(1, 13), f"N{draw.randrange(6)}",
            city, f"S{sum(map(ord, city)) % 4}", f"X{draw.randrange(7):02d}", draw.randrange(1, 40), draw.randrange(5),
        ))
    return out


@pytest.fixture(scope="module")
def trade(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(5).cache()


def totals(data, keys, measure, keep=lambda r: True):
    at = [COLUMNS.index(k) for k in keys]
    out = defaultdict(int)
    for r in data:
        if keep(r):
            out[tuple(r[i] for i in at)] += r[COLUMNS.index(measure)]
    return out


def test_by_place(trade, data):
    fob = totals(data, ("origin_state", "origin_city", "destination_country"), "fob")
    got = {tuple(r)[:3]: r.fob for r in T.by_place(trade).collect()}
    assert got == fob


@pytest.mark.parametrize("year", [2000, 1999, 1997])
def test_biggest_changes_counts_a_missing_year_as_zero(trade, data, year):
    exports = trade.filter("flow = 'exports'")
    fob = totals(data, ("origin_city", "year"), "fob", lambda r: r[0] == "exports")
    change = {c: fob[c, year] - fob[c, year - 1] for c in {k[0] for k in list(fob)}}
    up = sorted((-v, c) for c, v in change.items() if v > 0)[:3]
    down = sorted((v, c) for c, v in change.items() if v < 0)[:3]
    got = T.biggest_changes(exports, ["origin_city"], year, n=3).orderBy("position").collect()
    assert [(r.origin_city, r.change_fob) for r in got if r.direction == "increase"] == [(c, -v) for v, c in up]
    assert [(r.origin_city, r.change_fob) for r in got if r.direction == "decrease"] == [(c, v) for v, c in down]


def test_yearly_changes(trade, data):
    fob = totals(data, ("origin_city", "year"), "fob", lambda r: r[0] == "exports")
    want = {}
    for city in {c for c, _ in list(fob)}:
        for year in range(1998, 2002):
            if fob.get((city, year)) or fob.get((city, year - 1)):
                want[city, year] = fob.get((city, year), 0) - fob.get((city, year - 1), 0)
    got = T.yearly_changes(trade.filter("flow = 'exports'"), ["origin_city"], 1997, 2001).collect()
    assert {(r.origin_city, r.year): r.change_fob for r in got} == want


def test_changes_and_balance_read_the_trade_rows_once(trade):
    for result in (T.biggest_changes(trade, ["origin_city"], 2000), T.trade_balance(trade)):
        assert plan(result).count("InMemoryTableScan") == 1
    assert plan(T.biggest_changes(trade, ["origin_city"], 2000)).count("WindowGroupLimit") == 2


def test_top_partners_share_a_rank(spark):
    data = [(2000, "A", 5), (2000, "B", 5), (2000, "C", 4), (2000, "D", 1), (2001, "D", 2)]
    df = spark.createDataFrame(data, "year int, destination_country string, fob bigint")
    got = {(r.year, r.destination_country): r.position for r in T.top_partners(df).collect()}
    assert got == {(2000, "A"): 1, (2000, "B"): 1, (2000, "C"): 3, (2001, "D"): 1}


def test_rankings_limit_each_task_before_the_shuffle(trade):
    assert plan(T.top_partners(trade)).count("WindowGroupLimit") == 2
    assert plan(T.top_sections(trade)).count("WindowGroupLimit") == 2


def test_balance_has_every_year_and_the_total(trade, data):
    want = {}
    for period, keep in [(str(y), lambda r, y=y: r[1] == y) for y in (1997, 1999, 2000, 2001)] + [("all", lambda r: True)]:
        flows = totals(data, ("flow",), "fob", keep)
        want[period] = (flows[("exports",)], flows[("imports",)], flows[("exports",)] - flows[("imports",)])
    assert {r[0]: tuple(r)[1:] for r in T.trade_balance(trade).collect()} == want


def test_balance_of_a_year_with_one_flow(spark):
    df = spark.createDataFrame([("imports", 2000, 7)], "flow string, year int, fob bigint")
    assert rows(T.trade_balance(df)) == [("2000", 0, 7, -7), ("all", 0, 7, -7)]


def test_forecast_is_the_least_squares_line(trade, data):
    yearly = totals(data, ("destination_country", "year"), "fob", lambda r: 1997 <= r[1] <= 2000)
    want = {}
    for country in {c for c, _ in yearly}:
        points = [(y, yearly.get((country, y), 0)) for y in range(1997, 2001)]
        mx = sum(x for x, _ in points) / len(points)
        my = sum(v for _, v in points) / len(points)
        base = sum((x - mx) ** 2 for x, _ in points)
        slope = sum((x - mx) * (v - my) for x, v in points) / base if base else 0
        want[country] = round(my + slope * (2001 - mx), 2)
    got = {r.destination_country: r.forecast_fob for r in T.partner_forecast(trade, 1997, 2000, n=10).collect()}
    assert got == pytest.approx(want)


def test_forecast_from_a_single_year(spark):
    """A span of one year keeps its value; in a longer one the years without trade are 0."""
    df = spark.createDataFrame([(2000, "A", 10), (2000, "A", 5)], "year int, destination_country string, fob bigint")
    assert rows(T.partner_forecast(df, 2000, 2000)) == [("A", 2001, 15.0)]
    assert rows(T.partner_forecast(df, 1999, 2000)) == [("A", 2001, 30.0)]


def test_year_span(spark, trade, data):
    years = [r[1] for r in data]
    assert T.year_span(trade) == (min(years), max(years)) and T.year_span(trade.limit(0)) == (0, 0)


def test_forecast_of_values_beyond_double_precision(spark):
    base = 10**16
    df = spark.createDataFrame(
        [(1995 + i, "A", base + i) for i in range(6)], "year int, destination_country string, fob bigint"
    )
    assert T.partner_forecast(df, 1995, 2000).first().forecast_fob == float(base + 6)


def test_top_sections_by_value_and_weight(trade, data):
    got = defaultdict(list)
    for r in T.top_sections(trade, n=2).orderBy("position").collect():
        got[r.flow, r.measure].append((r.section_cd, r.total))
    for flow in ("exports", "imports"):
        for measure in ("fob", "net_weight"):
            sums = totals(data, ("section_cd",), measure, lambda r: r[0] == flow)
            want = sorted(((c, v) for (c,), v in sums.items()), key=lambda item: (-item[1], item[0]))[:2]
            assert got[flow, measure] == want


def test_shares_add_up_to_one(trade):
    sums = defaultdict(float)
    for r in T.section_share(trade).collect():
        sums[r.flow] += r.fob_share
    assert sums == pytest.approx({"exports": 1.0, "imports": 1.0})


def test_top_section_of_place_without_sort_or_window(trade, data):
    sums = totals(data, ("flow", "origin_city", "section_cd"), "fob")
    want = {}
    for (flow, city, section), value in sums.items():
        best = want.get((flow, city))
        if best is None or (-value, section) < (-best[1], best[0]):
            want[flow, city] = (section, value)
    top = T.top_section_of(trade, "origin_city")
    assert {(r.flow, r.origin_city): (r.section_cd, r.fob) for r in top.collect()} == want
    text = plan(top)
    assert "Window" not in text


def record(**changes):
    base = dict(a="1997", b="1", c="Chile", d="South", e="Santos", f="SP", g="01", h="Animals", i="10", j="3")
    return {**base, **changes}


NAMES = list("abcdefghij")


def test_payload_lists_of_any_length(spark, tmp_path):
    documents = [
        {"data": {"list": [record(), record(b="2", i="11")]}},
        {"data": {"list": []}},
        {"data": {"list": [record(b="3")]}},
    ]
    (tmp_path / "m.json").write_text("\n".join(json.dumps(d) for d in documents))
    out = read_trade_payload(spark, str(tmp_path), NAMES)
    assert out.schema == TRADE
    assert rows(out.select("month", "destination_country", "fob")) == [(1, "Chile", 10), (2, "Chile", 11), (3, "Chile", 10)]
    assert "trade_bloc" in read_trade_payload(spark, str(tmp_path), NAMES, keep_bloc=True).columns


def test_payload_spread_over_lines(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"data": {"list": [record()] * 3}}, indent=2))
    assert read_trade_payload(spark, str(tmp_path), NAMES, multiline=True).count() == 3


def test_payload_with_a_value_that_is_no_number(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"data": {"list": [record(i="ten")]}}))
    with pytest.raises(PySparkException):
        read_trade_payload(spark, str(tmp_path), NAMES).collect()


GOOD = {"data": {"list": [dict.fromkeys(NAMES) | {NAMES[0]: "1997", NAMES[1]: "2"}]}}


@pytest.mark.parametrize(
    "text, reason",
    [
        (json.dumps(GOOD, indent=1), "multiline"),
        (json.dumps(GOOD)[:40], "multiline"),
        ('{"data": {}}', "no data.list"),
        ('{"data": {"list": [{"other": 1}]}}', "none of the fields"),
    ],
)
def test_payload_that_cannot_be_used(spark, tmp_path, text, reason):
    """It fails the read, or is left out and found among the rejects."""
    (tmp_path / "good.json").write_text(json.dumps(GOOD))
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match=reason):
        read_trade_payload(spark, str(tmp_path), NAMES).collect()
    assert read_trade_payload(spark, str(tmp_path), NAMES, on_error="skip").count() == 1
    found = payload_rejects(spark, str(tmp_path), NAMES).collect()
    assert found and all(reason in r["reason"] and r["file"].endswith("bad.json") for r in found)


def test_full_years(spark):
    """Years with trade in every month; the first and the last may be cut off, and one between may lack a month."""
    months = [(1994, 12), *((1995, m) for m in range(1, 13)), *((1996, m) for m in range(1, 12))]
    months += [*((1997, m) for m in range(1, 13)), (1997, 5), (1998, 1), (1998, None), (None, 3)]
    df = spark.createDataFrame(months, "year int, month int")
    assert T.full_years(df) == (1995, 1997)
    assert T.full_years(df.filter("month < 12")) == T.full_years(df.limit(0)) == (0, 0)

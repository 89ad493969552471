"""Whole jobs from paths to paths, for ``spark-submit`` or ``python -m fareflow.jobs``.

::

    monthly-revenue  --green PATH --yellow PATH --output PATH
    zone-revenue     --green PATH --yellow PATH --zones CSV --since DATE --output PATH
    clean-csv        --feed green|yellow|fhv|hvfhv --input CSV --output PATH
    load-table       --feed green|yellow --input PATH --output PATH --load NAME
    monthly-layout   --feed green|yellow|fhv|hvfhv --input PATH --output PATH --load NAME
    load-trade       --input JSON --fields NAME,... --flow exports|imports --output PATH --load NAME [--multiline]
    trade-balance    --input PATH --output PATH
    load-arrivals    --feed green|yellow|fhv|hvfhv --input PATH --checkpoint PATH --output PATH
    route-rides      --input TOPIC_FOLDER --checkpoint PATH --output PATH
    count-vendors    --input TOPIC_FOLDER --checkpoint PATH --output PATH
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from fareflow import schemas
from fareflow.operators import cleaning, feeds, revenue, trade, zones
from fareflow.session import build_session
from fareflow.sinks import files, tables
from fareflow.sources import files as sources
from fareflow.sources.payload import read_trade_payload
from fareflow.sources.topics import read_recorded_topic
from fareflow.streaming import counts, loader, messages, routing, runner

FEEDS = {feed.service: feed for feed in (schemas.GREEN_FEED, schemas.YELLOW_FEED)}
ALL_FEEDS = FEEDS | {feed.service: feed for feed in (schemas.FOR_HIRE_FEED, schemas.HIGH_VOLUME_FEED)}


def monthly_revenue(spark: SparkSession, green: str, yellow: str, output: str) -> None:
    """One report file of revenue by zone, month and service over both feeds."""
    paths = {"green": green, "yellow": yellow}
    trips = feeds.union_feeds(
        [(sources.read_feed(spark, paths[name], feed), feed) for name, feed in FEEDS.items()]
    )
    files.write_report(revenue.monthly_revenue(trips), output)


def zone_revenue(
    spark: SparkSession, green: str, yellow: str, zones_csv: str, since: str, output: str
) -> None:
    """Hourly revenue of both feeds side by side, by zone name."""
    hourly = [
        revenue.hourly_revenue(sources.read_feed(spark, path, feed), feed.pickup, since)
        for path, feed in ((green, schemas.GREEN_FEED), (yellow, schemas.YELLOW_FEED))
    ]
    lookup = sources.read_csv(spark, zones_csv, schemas.ZONES)
    named = zones.revenue_by_zone_named(revenue.combine_feeds(*hourly), lookup)
    files.write_parquet(named, output, mode="overwrite")


def clean_csv(spark: SparkSession, feed: str, input: str, output: str) -> None:
    """A feed's CSV files as Parquet under its schema; an empty folder or none is written to.

    Columns are found by name; text that is no time or number fails the job. How many values of each
    kind are missing is left to the reader: nothing is filled in here.
    """
    spec = ALL_FEEDS[feed]
    text = sources.read_csv(spark, input, parallelism=spark.sparkContext.defaultParallelism)
    times = [f.name for f in spec.schema if f.dataType == schemas.TIMESTAMP]
    typed = cleaning.conform(cleaning.fix_timestamps(text, times), spec.schema)
    files.write_parquet(typed, output)


def load_table(spark: SparkSession, feed: str, input: str, output: str, load: str) -> None:
    """A feed's files, missing passenger counts as 0, into the table of all loads, by pickup month.

    Running a load again replaces what it wrote; other loads stay.
    """
    spec = FEEDS[feed]
    trips = cleaning.fill_zero(sources.read_feed(spark, input, spec))
    layout = tables.DateLayout(spec.pickup)
    files.write_load(trips.withColumn(layout.column, layout.of(spec.pickup)), output, [layout.column], load)


def monthly_layout(spark: SparkSession, feed: str, input: str, output: str, load: str) -> None:
    """A feed's files laid out by year and month of pickup, and by load.

    A trip of another month than its file's stands in its own month, beside the rows of that month's
    file. Running a load again replaces what it wrote; other loads stay.
    """
    spec = ALL_FEEDS[feed]
    trips = sources.read_feed(spark, input, spec).withColumns(
        {"year": F.year(spec.pickup), "month": F.month(spec.pickup)}
    )
    files.write_load(trips, output, ["year", "month"], load)


def load_trade(
    spark: SparkSession, input: str, fields: str, flow: str, output: str, load: str, multiline: bool = False
) -> None:
    """Payload files of one flow into the trade table of both, by flow and date.

    Running a load again replaces what it wrote; other loads, and the other flow, stay.
    """
    if flow not in (trade.EXPORTS, trade.IMPORTS):
        raise ValueError(f"flow: {flow}")
    records = read_trade_payload(spark, input, fields.split(","), multiline=multiline)
    dated = trade.with_trade_date(records).withColumn("flow", F.lit(flow))
    files.write_load(dated, output, ["flow", "trade_date"], load)


def load_arrivals(spark: SparkSession, feed: str, input: str, checkpoint: str, output: str) -> None:
    """Files of a feed that have come since the last run, into the table of all, by year and month of pickup.

    Every file is loaded once, however late it comes.
    """
    loader.load_feed_arrivals(spark, ALL_FEEDS[feed], input, output, checkpoint)


def trade_balance(spark: SparkSession, input: str, output: str) -> None:
    """Exports, imports and their difference by year, from a table of load-trade."""
    files.write_report(trade.trade_balance(sources.read_parquet(spark, input)), output)


def route_rides(spark: SparkSession, input: str, checkpoint: str, output: str) -> None:
    """New messages of a recorded ride topic into a folder per amount topic."""
    decoded = messages.decode(read_recorded_topic(spark, input))
    runner.append_to_files(routing.route_by_amount(decoded), output, checkpoint, ["topic"])


def count_vendors(spark: SparkSession, input: str, checkpoint: str, output: str) -> None:
    """The running counts per vendor, as a snapshot, after the new messages of a recorded ride topic."""
    decoded = messages.decode(read_recorded_topic(spark, input))
    runner.write_current(counts.vendor_counts(decoded), output, checkpoint, ["vendorId"])


JOBS = {
    "monthly-revenue": (monthly_revenue, ("green", "yellow", "output")),
    "zone-revenue": (zone_revenue, ("green", "yellow", "zones", "since", "output")),
    "clean-csv": (clean_csv, ("feed", "input", "output")),
    "load-table": (load_table, ("feed", "input", "output", "load")),
    "monthly-layout": (monthly_layout, ("feed", "input", "output", "load")),
    "load-trade": (load_trade, ("input", "fields", "flow", "output", "load")),
    "load-arrivals": (load_arrivals, ("feed", "input", "checkpoint", "output")),
    "trade-balance": (trade_balance, ("input", "output")),
    "route-rides": (route_rides, ("input", "checkpoint", "output")),
    "count-vendors": (count_vendors, ("input", "checkpoint", "output")),
}


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="fareflow.jobs")
    chosen = parser.add_subparsers(dest="job", required=True)
    for name, (_, options) in JOBS.items():
        job = chosen.add_parser(name)
        for option in options:
            job.add_argument(f"--{option}", required=True)
    chosen.choices["load-trade"].add_argument("--multiline", action="store_true")
    for job in chosen.choices.values():
        job.add_argument("--shuffle-bytes", type=int, help="size of the largest shuffle")
    values = vars(parser.parse_args(arguments))
    run, options = JOBS[values["job"]]
    spark = build_session(f"fareflow {values['job']}", shuffle_bytes=values["shuffle_bytes"])
    more = {"multiline": True} if values.get("multiline") else {}
    run(spark, *[values[option] for option in options], **more)


if __name__ == "__main__":
    main()

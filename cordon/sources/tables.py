"""Adapters from the driver's test tables to trip feeds and weather.

``lineitem`` rows become trips with the mapping of FIXTURES.md §4, so every query
scales with the table it reads.  The mapping is a pure projection (no shuffle);
time-range selection is pushed to the parquet scan on ``l_shipdate`` with a one-day
slack, then applied exactly on the derived pickup time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordon.sources.feeds import time_columns

# Fixed values of the test mapping (FIXTURES.md §4): modulus of the zone ids, time
# offset multipliers, fare divisor, surcharge marker discount, vendor count, and the
# year shift that turns the events calendar into the analysis year.
ZONE_MOD = 263
PICKUP_OFFSET_MOD = 86400
DURATION_MOD = 2400
FARE_DIVISOR = 2000.0
NULL_SURCHARGE_DISCOUNT = 0.01
VENDOR_MOD = 6
WEATHER_YEAR_SHIFT = 24

TRIP_KEY = "trip_key"


_OFFSET = f"(l_orderkey * 37 + l_linenumber * 911) % {PICKUP_OFFSET_MOD}"
_DURATION = f"(l_partkey * 7 + l_linenumber * 13 + l_suppkey * 3) % {DURATION_MOD}"
_FARE = (f"CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN -(l_extendedprice / {FARE_DIVISOR}D) "
         f"ELSE l_extendedprice / {FARE_DIVISOR}D END")

# The mapping as SQL expressions: one call builds the whole projection in the JVM.
TRIP_EXPRS = (
    f"concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), "
    f"CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING)) AS {TRIP_KEY}",
    f"timestampadd(SECOND, {_OFFSET}, l_shipdate) AS pickup_time",
    f"timestampadd(SECOND, {_OFFSET} + {_DURATION}, l_shipdate) AS dropoff_time",
    f"CAST(1 + l_partkey % {ZONE_MOD} AS BIGINT) AS pickup_loc",
    f"CAST(1 + (l_suppkey * 5 + l_linenumber) % {ZONE_MOD} AS BIGINT) AS dropoff_loc",
    "CASE WHEN l_quantity = 1 THEN 0.0D ELSE l_quantity / 8.0D END AS trip_distance",
    f"{_FARE} AS fare",
    f"({_FARE}) * (1.0D + 2.0D * l_tax) + l_discount * 25.0D AS total_amount",
    f"CASE WHEN l_discount = {NULL_SURCHARGE_DISCOUNT}D THEN CAST(NULL AS DOUBLE) "
    "ELSE l_discount * 25.0D END AS congestion_surcharge",
    "CASE WHEN l_linestatus = 'O' THEN 'yellow' ELSE 'green' END AS taxi_type",
    f"CAST(l_suppkey % {VENDOR_MOD} AS BIGINT) AS VendorID",
)


def lineitem_trips(lineitem: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Every lineitem row as a trip (raw surcharge, nullable) plus ``taxi_type`` and a key.
    ``names`` maps trip columns to output names, in output order (e.g. a feed's raw
    columns); trip columns not named are left out."""
    if names is None:
        return lineitem.selectExpr(*TRIP_EXPRS)
    bodies = dict(reversed(e.rsplit(" AS ", 1)) for e in TRIP_EXPRS)
    return lineitem.selectExpr(*[f"{bodies[src]} AS {dst}" for src, dst in names.items()])


_FEED_PRED = {
    "yellow": "l_linestatus = 'O'",
    "green": "(l_linestatus <> 'O' OR l_linestatus IS NULL)",
}


# raw-file column of each trip column, in raw-file order (times follow the feed)
_RAW_NAMES = (
    ("VendorID", "VendorID"), ("pickup_time", "{pickup}"), ("dropoff_time", "{dropoff}"),
    ("trip_distance", "trip_distance"), ("pickup_loc", "PULocationID"), ("dropoff_loc", "DOLocationID"),
    ("fare", "fare_amount"), ("total_amount", "total_amount"),
    ("congestion_surcharge", "congestion_surcharge"), (TRIP_KEY, TRIP_KEY),
)


def lineitem_feed(lineitem: DataFrame, feed: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Raw monthly-file schema of one feed for pickups in ``[start, end)``.

    Column names follow the feed (``tpep_*`` / ``lpep_*``); ``trip_key`` is an extra raw
    column that schema unification drops and imputation carries along.
    """
    pickup, dropoff = time_columns(feed)
    scan_pred, trip_pred = [_FEED_PRED[feed]], []
    if start is not None:
        slack = (dt.datetime.fromisoformat(start) - dt.timedelta(days=1)).isoformat(sep=" ")
        scan_pred.append(f"l_shipdate > TIMESTAMP_NTZ '{slack}'")
        trip_pred.append(f"{pickup} >= TIMESTAMP_NTZ '{start}'")
    if end is not None:
        scan_pred.append(f"l_shipdate < TIMESTAMP_NTZ '{end}'")
        trip_pred.append(f"{pickup} < TIMESTAMP_NTZ '{end}'")
    names = {src: dst.format(pickup=pickup, dropoff=dropoff) for src, dst in _RAW_NAMES}
    trips = lineitem_trips(lineitem.filter(" AND ".join(scan_pred)), names)  # raw-file order
    if trip_pred:
        trips = trips.filter(" AND ".join(trip_pred))
    return trips


def month_bounds(year: int, month: int) -> tuple[str, str]:
    start = dt.date(year, month, 1)
    end = dt.date(year + (month == 12), month % 12 + 1, 1)
    return start.isoformat(), end.isoformat()


def lineitem_feed_year(lineitem: DataFrame, feed: str, year: int) -> DataFrame:
    return lineitem_feed(lineitem, feed, f"{year}-01-01", f"{year + 1}-01-01")


def lineitem_feed_month(lineitem: DataFrame, feed: str, year: int, month: int) -> DataFrame:
    return lineitem_feed(lineitem, feed, *month_bounds(year, month))


def events_weather(events: DataFrame, year_shift: int = WEATHER_YEAR_SHIFT) -> DataFrame:
    """Daily precipitation from ``events``: day = ``ts - year_shift years``, mm = sum(value)."""
    day = F.to_date(F.col("ts") - F.make_ym_interval(F.lit(year_shift), F.lit(0)))
    return events.groupBy(day.alias("date")).agg(F.sum("value").alias("precip_mm"))

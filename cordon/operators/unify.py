"""Schema unification of the feeds (C1) and detection of missing periods."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cordon.sources.feeds import time_columns

TRIP_COLUMNS = (
    "pickup_time", "dropoff_time", "pickup_loc", "dropoff_loc", "trip_distance",
    "fare", "total_amount", "congestion_surcharge", "taxi_type", "VendorID",
)


def raw_to_trips(raw: DataFrame, feed: str, fill_surcharge: bool = True, keep: Iterable[str] = ()) -> DataFrame:
    """Rename one feed's raw columns to the canonical Trip schema and tag the feed;
    ``keep`` names extra raw columns carried along, whatever their case in the files
    (null where a feed lacks them)."""
    present = {c.lower(): c for c in raw.columns}
    pickup, dropoff = time_columns(feed)
    surcharge = F.col("congestion_surcharge")
    if fill_surcharge:
        surcharge = F.coalesce(surcharge, F.lit(0.0))
    return raw.select(
        F.col(pickup).alias("pickup_time"),
        F.col(dropoff).alias("dropoff_time"),
        F.col("PULocationID").alias("pickup_loc"),
        F.col("DOLocationID").alias("dropoff_loc"),
        "trip_distance",
        F.col("fare_amount").alias("fare"),
        "total_amount",
        surcharge.alias("congestion_surcharge"),
        F.lit(feed).alias("taxi_type"),
        "VendorID",
        *[F.col(present[c.lower()]).alias(c) if c.lower() in present else F.lit(None).alias(c) for c in keep],
    )


def unify_feeds(raw_by_feed: Mapping[str, DataFrame], keep: Iterable[str] = ()) -> DataFrame:
    """``UNION ALL`` of every feed in the canonical schema; a plain union, no shuffle."""
    keep = list(keep)
    frames = [raw_to_trips(df, feed, keep=keep) for feed, df in raw_by_feed.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def observed_periods(trips: DataFrame, feed_col: str = "taxi_type", time_col: str = "pickup_time") -> DataFrame:
    """Distinct ``(feed, year, month)`` present; partial aggregation keeps the shuffle tiny."""
    return trips.groupBy(
        F.col(feed_col).alias("feed"),
        F.year(time_col).alias("year"),
        F.month(time_col).alias("month"),
    ).agg(F.count(F.lit(1)).alias("n_trips"))


def missing_periods(observed: DataFrame, feeds: Iterable[str], years: Iterable[int] | None = None) -> DataFrame:
    """Periods of the expected calendar (each feed x year x 12 months) with no trips.

    ``years`` defaults to every year from the first to the last observed one (over all
    feeds).  Months are numbered ``year * 12 + month - 1``; each feed's present months are
    gathered into one set (bounded by the calendar: at most years x 12 values), and the
    missing ones are ``array_except(calendar, present)``.  One pass over the observed
    periods: no self-join, no cross join, so the trips are scanned once.
    """
    feeds = list(feeds)
    idx = F.col("year") * 12 + F.col("month") - 1
    per_feed = observed.groupBy("feed").agg(F.collect_set(idx.cast("int")).alias("present"))
    wanted = observed.sparkSession.range(1).select(F.explode(F.array(*[F.lit(f) for f in feeds])).alias("feed"))
    # one row per feed on each side; AQE broadcasts it from the measured size
    rows = wanted.join(per_feed, "feed", "left")
    if years is None:
        span = Window.partitionBy()  # over one row per feed
        rows = rows.select(
            "feed", "present",
            F.min(F.array_min("present")).over(span).alias("lo"),
            F.max(F.array_max("present")).over(span).alias("hi"),
        )
        calendar = F.sequence((F.floor(F.col("lo") / 12) * 12).cast("int"),
                              (F.floor(F.col("hi") / 12) * 12 + 11).cast("int"))
    else:
        months = [y * 12 + m for y in sorted(set(int(y) for y in years)) for m in range(12)]
        calendar = F.array(*[F.lit(m) for m in months])
    present = F.coalesce(F.col("present"), F.array().cast("array<int>"))
    gaps = rows.select("feed", F.explode(F.array_except(calendar, present)).alias("m"))
    return gaps.select(
        "feed",
        F.floor(F.col("m") / 12).cast("int").alias("year"),
        (F.col("m") % 12 + 1).cast("int").alias("month"),
    )

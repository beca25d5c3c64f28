"""Imputation of a missing month from earlier years.

The month is rebuilt as a row mixture: each donor month ``years_back`` earlier is
shifted forward by that many years and hash-sampled at its fraction (30 % of two years
back + 70 % of one year back by default).  Row-local work only -- two scans, a filter
and a union, no shuffle -- so it scales with the donor files.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordon.functions.sample import exact_sample, in_hash_sample, sample_key
from cordon.functions.time import shift_years
from cordon.sources.feeds import time_columns
from cordon.spec import Donor


WEEKS_PER_YEAR_DAYS = 364


def shift_feed_years(raw: DataFrame, feed: str, years: int, align_weekdays: bool = False) -> DataFrame:
    """Move both trip times of a raw feed ``years`` forward, columns kept in place;
    with ``align_weekdays`` by ``364 * years`` days, which keeps the weekday."""
    pickup, dropoff = time_columns(feed)
    if align_weekdays:
        days = WEEKS_PER_YEAR_DAYS * years
        shift = lambda c: F.timestamp_add("DAY", F.lit(days), F.col(c))
    else:
        shift = lambda c: shift_years(c, years)
    return raw.withColumns({
        pickup: shift(pickup).cast("timestamp_ntz"),
        dropoff: shift(dropoff).cast("timestamp_ntz"),
    })


def donor_window(year: int, month: int, donor: Donor, align_weekdays: bool = False) -> tuple[str, str]:
    """Pickup-time window ``[start, end)`` of a donor for the target month."""
    start = dt.date(year, month, 1)
    end = dt.date(year + (month == 12), month % 12 + 1, 1)
    if align_weekdays:
        back = dt.timedelta(days=WEEKS_PER_YEAR_DAYS * donor.years_back)
        return (start - back).isoformat(), (end - back).isoformat()
    y = year - donor.years_back
    return dt.date(y, month, 1).isoformat(), dt.date(y + (month == 12), month % 12 + 1, 1).isoformat()


def impute_month(
    donors: Sequence[tuple[DataFrame, Donor]],
    feed: str,
    key_cols: Sequence[str] | None = None,
    align_weekdays: bool = False,
    mark_column: str | None = None,
    exact: bool = False,
) -> DataFrame:
    """Union of shifted, hash-sampled donor months of one feed (raw schema kept).

    ``key_cols`` name the columns whose hash decides membership; default is every
    original column, so identical rows are kept or dropped together.  Each donor frame
    holds the pickups of its :func:`donor_window`.  ``mark_column`` adds a boolean column
    set to true, so synthetic rows stay traceable downstream.  ``exact`` takes exactly the donor's
    fraction of its rows, rounded half up, instead of about as many (a count and a histogram of each donor).
    """
    parts = []
    for frame, donor in donors:
        cols = list(key_cols) if key_cols else frame.columns
        if exact:
            sampled = exact_sample(frame, int(frame.count() * Fraction(str(donor.fraction)) + Fraction(1, 2)), cols)
        else:
            sampled = frame.filter(in_hash_sample(sample_key(cols), donor.fraction))
        parts.append(shift_feed_years(sampled, feed, donor.years_back, align_weekdays))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    if mark_column:
        out = out.withColumn(mark_column, F.lit(True))
    return out

"""Demand vs weather."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordon.functions.stats import guarded_corr, ols_fit


def daily_trips(clean: DataFrame) -> DataFrame:
    return clean.groupBy(F.to_date("pickup_time").alias("date")).agg(F.count(F.lit(1)).alias("daily_trips"))


def rain_daily(clean: DataFrame, weather: DataFrame) -> DataFrame:
    """Daily trip counts joined with daily precipitation; days missing on either side drop.

    Both inputs are one row per day after aggregation.  No broadcast hint: AQE picks a
    broadcast from the measured size and falls back to a shuffle join beyond it.
    """
    return daily_trips(clean).join(weather.select("date", "precip_mm"), "date", "inner") \
        .select("date", "daily_trips", "precip_mm")


def rain_elasticity(rain: DataFrame) -> DataFrame:
    """Pearson correlation of daily trips and precipitation; null if undefined."""
    return rain.agg(guarded_corr("daily_trips", "precip_mm").alias("correlation"))


def rain_trend(rain: DataFrame) -> DataFrame:
    """Least-squares line daily_trips = intercept + slope * precip_mm, with r^2."""
    return rain.agg(*ols_fit("daily_trips", "precip_mm"))

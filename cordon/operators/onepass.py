"""Every clean-trip report from one pass over the clean trips, and the baseline's from one over the baseline.

Run separately, the leakage, volume, speed, tip, daily-count and border reports each scan
the clean trips.  Here each trip emits one keyed row per report it belongs to (the
leakage zone, the Q1 volume, its Q1 speed cell, its month, its day, its border zone).
A single aggregation then yields all reports at their own grain, at most a few thousand
rows, from which each report is a filter and a projection.  The data is scanned once,
and the only shuffle carries partial aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cordon.functions.time import day_name, in_period, speed_mph, ts_lit
from cordon.functions.zones import entering, in_zone, inside, touching
from cordon.operators.reports import border_window, tip_share, top_leakage
from cordon.spec import AuditSpec

LEAKAGE, VOLUME, SPEED, TIPS, DAILY, BORDER = "leakage", "volume", "speed", "tips", "daily", "border"


def _key(grain: str, cond: Column, k_long: Column | None = None, k_str: Column | None = None,
         k_date: Column | None = None) -> Column:
    return F.when(cond, F.struct(
        F.lit(grain).alias("grain"),
        (k_long if k_long is not None else F.lit(None)).cast("bigint").alias("k_long"),
        (k_str if k_str is not None else F.lit(None)).cast("string").alias("k_str"),
        (k_date if k_date is not None else F.lit(None)).cast("date").alias("k_date"),
    ))


def _cube(trips: DataFrame, keys: list[Column], by: Sequence[str] = ()) -> DataFrame:
    """One keyed row per trip and report, aggregated once.  An average is a sum and a count of its own
    non-null values, so nulls drop out of it as they do in ``avg``."""
    rows = trips.select(
        *by,
        F.explode(F.array(*keys)).alias("k"),
        F.when(F.col("congestion_surcharge") > 0, 1).otherwise(0).alias("pos"),
        F.when(F.col("congestion_surcharge") == 0, 1).otherwise(0).alias("zero"),
        F.col("congestion_surcharge").alias("surcharge"),
        speed_mph("trip_distance", "pickup_time", "dropoff_time").alias("speed"),
        tip_share().alias("tip"),
    ).filter(F.col("k").isNotNull())
    return rows.groupBy("k.grain", "k.k_long", "k.k_str", "k.k_date", *by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("pos").cast("bigint").alias("n_pos"),
        F.sum("zero").cast("bigint").alias("n_zero"),
        *[f for c in ("surcharge", "speed", "tip") for f in (F.count(c).alias(f"n_{c}"), F.sum(c).alias(f"sum_{c}"))],
    )


def clean_report_cube(clean: DataFrame, spec: AuditSpec) -> DataFrame:
    """``(grain, k_long, k_str, k_date)`` -> n, surcharge counts, and a count and sum of surcharge, speed and tip."""
    return _cube(clean, _clean_keys(spec))


def period_cube(clean: DataFrame, spec: AuditSpec, by: Sequence[str]) -> DataFrame:
    """The same states for each period (the columns ``by``); :func:`merge_cubes` adds them up."""
    return _cube(clean, _clean_keys(spec), by)


#: what a cube holds: counts and sums, which are added up when states are merged
STATES = ("n", "n_pos", "n_zero", *(f"{f}_{c}" for c in ("surcharge", "speed", "tip") for f in ("n", "sum")))


def merge_cubes(states: DataFrame) -> DataFrame:
    """One cube from the cubes of parts of the trips."""
    return states.groupBy("grain", "k_long", "k_str", "k_date").agg(*[F.sum(c).alias(c) for c in STATES])


def _clean_keys(spec: AuditSpec) -> list[Column]:
    after = F.col("pickup_time") >= ts_lit(spec.policy_start)
    q1 = in_period("pickup_time", spec.q1_start, spec.q1_end, spec.half_open)
    return [
        _key(LEAKAGE, entering("pickup_loc", "dropoff_loc", spec.zone_ids) & after, k_long=F.col("pickup_loc")),
        _key(VOLUME, touching("pickup_loc", "dropoff_loc", spec.zone_ids) & q1),
        _key(SPEED, inside("pickup_loc", "dropoff_loc", spec.zone_ids) & q1,
             k_long=F.hour("pickup_time"), k_str=day_name("pickup_time")),
        _key(TIPS, after, k_long=F.month("pickup_time")),
        _key(DAILY, F.lit(True), k_date=F.to_date("pickup_time")),
        _key(BORDER, in_zone("dropoff_loc", spec.border_ids) & border_window(spec), k_long=F.col("dropoff_loc")),
    ]


def baseline_report_cube(baseline: DataFrame, spec: AuditSpec) -> DataFrame:
    """The baseline's share of the reports (volume, speed, border) in the same shape, unbounded in time."""
    return _cube(baseline, [
        _key(VOLUME, touching("pickup_loc", "dropoff_loc", spec.zone_ids)),
        _key(SPEED, inside("pickup_loc", "dropoff_loc", spec.zone_ids),
             k_long=F.hour("pickup_time"), k_str=day_name("pickup_time")),
        _key(BORDER, in_zone("dropoff_loc", spec.border_ids), k_long=F.col("dropoff_loc")),
    ])


def _mean(name: str) -> Column:
    return F.col(f"sum_{name}") / F.nullif(F.col(f"n_{name}"), F.lit(0))


def _grain(cube: DataFrame, grain: str) -> DataFrame:
    return cube.filter(F.col("grain") == grain)


def leakage_from(cube: DataFrame, spec: AuditSpec) -> DataFrame:
    return top_leakage(_grain(cube, LEAKAGE).select(
        F.col("k_long").alias("pickup_loc"),
        F.col("n").alias("trip_count"),
        (F.col("n_pos") / F.col("n")).alias("compliance_rate"),
        F.col("n_zero").alias("missing_surcharge_hits"),
    ), spec)


def volume_from(cube: DataFrame, label: str) -> DataFrame:
    """One row even when no trip matched (count 0), like ``COUNT(*)``."""
    return _grain(cube, VOLUME).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("volume")) \
        .select(F.lit(label).alias("period"), "volume")


def speed_from(cube: DataFrame) -> DataFrame:
    return _grain(cube, SPEED).select(
        F.col("k_long").alias("hour"),
        F.col("k_str").alias("dow"),
        _mean("speed").alias("speed"),
    )


def tips_from(cube: DataFrame) -> DataFrame:
    return _grain(cube, TIPS).select(
        F.col("k_long").alias("month"),
        _mean("surcharge").alias("avg_surcharge"),
        _mean("tip").alias("avg_tip_pct"),
    ).orderBy("month")


def daily_from(cube: DataFrame) -> DataFrame:
    return _grain(cube, DAILY).select(F.col("k_date").alias("date"), F.col("n").alias("daily_trips"))


def border_from(cube: DataFrame, name: str) -> DataFrame:
    return _grain(cube, BORDER).select(F.col("k_long").alias("loc_id"), F.col("n").alias(name))

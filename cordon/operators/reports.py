"""Zone reports over flagged / clean trips.

Every report aggregates before anything else: partial aggregation on the map side,
one small shuffle on the grouping key, then at most a few hundred rows.  That also
absorbs skew -- a zone holding a third of all trips is one pre-aggregated row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordon.functions.time import day_name, in_period, speed_mph, ts_lit
from cordon.functions.zones import entering, in_zone, inside, touching
from cordon.spec import AuditSpec


def _ones(cond) -> F.Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def surcharge_leakage(clean: DataFrame, spec: AuditSpec) -> DataFrame:
    """Entering trips after the policy start, per pickup zone; the ``top_leakage`` zones
    with most trips lacking a surcharge (ties broken by zone id)."""
    entering_trips = clean.filter(
        entering("pickup_loc", "dropoff_loc", spec.zone_ids)
        & (F.col("pickup_time") >= ts_lit(spec.policy_start))
    )
    per_zone = entering_trips.groupBy("pickup_loc").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.avg(_ones(F.col("congestion_surcharge") > 0)).alias("compliance_rate"),
        F.sum(_ones(F.col("congestion_surcharge") == 0)).cast("bigint").alias("missing_surcharge_hits"),
    )
    return top_leakage(per_zone, spec)


def top_leakage(per_zone: DataFrame, spec: AuditSpec) -> DataFrame:
    """Most hits first; ties by zone id, a null zone last."""
    return per_zone.orderBy(F.desc("missing_surcharge_hits"), F.asc_nulls_last("pickup_loc")).limit(spec.top_leakage)


def volume_row(trips: DataFrame, spec: AuditSpec, label: str, q1_only: bool) -> DataFrame:
    """Trips touching the zone as one labelled count row (present even when zero)."""
    cond = touching("pickup_loc", "dropoff_loc", spec.zone_ids)
    if q1_only:
        cond = cond & in_period("pickup_time", spec.q1_start, spec.q1_end, spec.half_open)
    return trips.filter(cond).agg(F.count(F.lit(1)).alias("volume")) \
        .select(F.lit(label).alias("period"), "volume")


def period_volumes(baseline: DataFrame, clean: DataFrame, spec: AuditSpec) -> DataFrame:
    """Trips touching the zone: the baseline file vs the analysis Q1, one labelled row
    each (a count row is produced even when nothing matches)."""
    return volume_row(baseline, spec, spec.baseline_label, q1_only=False) \
        .unionByName(volume_row(clean, spec, spec.analysis_label, q1_only=True))


def suspicious_vendors(log: DataFrame, spec: AuditSpec) -> DataFrame:
    """Vendors x flag with the most flagged trips; ties by vendor (null last) and flag."""
    counts = log.groupBy("VendorID", "forensic_flag").agg(F.count(F.lit(1)).alias("ghost_count"))
    return counts.orderBy(F.desc("ghost_count"), F.asc_nulls_last("VendorID"), F.asc("forensic_flag")).limit(spec.top_vendors)


def border_counts(trips: DataFrame, spec: AuditSpec, name: str) -> DataFrame:
    """Drop-offs per border zone, at most ``len(border_ids)`` rows."""
    return (
        trips.filter(in_zone("dropoff_loc", spec.border_ids))
        .groupBy(F.col("dropoff_loc").alias("loc_id"))
        .agg(F.count(F.lit(1)).alias(name))
    )


def border_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Join of the two border counts and the relative change.  Both sides hold at most
    ``len(border_ids)`` rows -- a proven bound, hence the broadcast."""
    joined = before.join(F.broadcast(after), "loc_id", "inner")
    change = (F.col("count_25").cast("double") - F.col("count_24")) / F.col("count_24")
    return joined.select("loc_id", "count_24", "count_25", change.alias("change_rate"))


def border_window(spec: AuditSpec):
    """Pickup-time bound of the analysis side of the border report (true when unbounded)."""
    cond = F.lit(True)
    if spec.border_start:
        cond = cond & (F.col("pickup_time") >= ts_lit(spec.border_start))
    if spec.border_end:
        cond = cond & (F.col("pickup_time") < ts_lit(spec.border_end))
    return cond


def border_effect(baseline: DataFrame, clean: DataFrame, spec: AuditSpec) -> DataFrame:
    """Drop-offs per border zone: baseline vs analysis, and the relative change.
    Both sides are aggregated (and restricted to the border ids) before the join."""
    after = clean.filter(border_window(spec)) if (spec.border_start or spec.border_end) else clean
    return border_change(border_counts(baseline, spec, "count_24"), border_counts(after, spec, "count_25"))


def velocity(trips: DataFrame, spec: AuditSpec, q1_only: bool) -> DataFrame:
    """Average per-trip speed of trips inside the zone, by pickup hour and weekday name."""
    rows = trips.filter(inside("pickup_loc", "dropoff_loc", spec.zone_ids))
    if q1_only:
        rows = rows.filter(in_period("pickup_time", spec.q1_start, spec.q1_end, spec.half_open))
    return rows.groupBy(
        F.hour("pickup_time").cast("bigint").alias("hour"),
        day_name("pickup_time").alias("dow"),
    ).agg(F.avg(speed_mph("trip_distance", "pickup_time", "dropoff_time")).alias("speed"))


def velocity_before(baseline: DataFrame, spec: AuditSpec) -> DataFrame:
    return velocity(baseline, spec, q1_only=False)


def velocity_after(clean: DataFrame, spec: AuditSpec) -> DataFrame:
    return velocity(clean, spec, q1_only=True)


def tip_share():
    """Tip as % of the fare: 0 where the fare isn't positive, null where an input is null."""
    share = (F.col("total_amount") - F.col("fare") - F.col("congestion_surcharge")) / F.col("fare") * F.lit(100.0)
    return F.when(F.col("fare") > 0, share).otherwise(F.lit(0.0))


def tip_crowding(clean: DataFrame, spec: AuditSpec) -> DataFrame:
    """Monthly average surcharge and tip share (% of fare; 0 where fare <= 0)."""
    rows = clean.filter(F.col("pickup_time") >= ts_lit(spec.policy_start))
    return (
        rows.groupBy(F.month("pickup_time").cast("bigint").alias("month"))
        .agg(
            F.avg("congestion_surcharge").alias("avg_surcharge"),
            F.avg(tip_share()).alias("avg_tip_pct"),
        )
        .orderBy("month")
    )

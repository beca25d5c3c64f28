"""Trip flagging (C4), quarantine split (C5) and flag counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cordon.functions.time import seconds_between, speed_mph
from cordon.spec import FLAG_SPEED, FLAG_STATIONARY, FLAG_TELEPORT, AuditSpec

DERIVED = ("duration_sec", "avg_speed_mph", "forensic_flag")


def flag_expr(speed: Column, duration: Column, distance: Column, fare: Column, spec: AuditSpec) -> Column:
    """First matching rule wins; a rule whose input is null does not fire."""
    return (
        F.when(speed > spec.max_speed_mph, F.lit(FLAG_SPEED))
        .when((duration < spec.min_duration_sec) & (fare > spec.teleport_min_fare), F.lit(FLAG_TELEPORT))
        .when((distance == 0) & (fare > 0), F.lit(FLAG_STATIONARY))
    )


def flag_trips(trips: DataFrame, spec: AuditSpec = AuditSpec()) -> DataFrame:
    """Trip columns + ``duration_sec``, ``avg_speed_mph``, ``forensic_flag``; limits from the spec.

    Row-local expressions in one projection (common subexpressions are evaluated once by
    codegen): stays inside one whole-stage-codegen span with the scan.
    """
    duration = seconds_between("pickup_time", "dropoff_time")
    speed = speed_mph("trip_distance", "pickup_time", "dropoff_time")
    flag = flag_expr(speed, duration, F.col("trip_distance"), F.col("fare"), spec)
    return trips.select("*", duration.alias("duration_sec"), speed.alias("avg_speed_mph"), flag.alias("forensic_flag"))


def audit_log(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col("forensic_flag").isNotNull())


def clean_trips(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col("forensic_flag").isNull()).drop(*DERIVED)


def flag_stats(flagged: DataFrame) -> DataFrame:
    """Rows per flag among flagged trips."""
    return audit_log(flagged).groupBy("forensic_flag").agg(F.count(F.lit(1)).alias("n"))

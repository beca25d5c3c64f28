"""Flag rule on the edge rows of FIXTURES.md §2 and the quarantine split."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cordon.operators import audit_log, clean_trips, flag_stats, flag_trips

T0 = dt.datetime(2025, 3, 1, 12, 0, 0)

# id, duration s, distance, fare, expected flag
EDGE_ROWS = [
    ("G01", 3600, 65.0, 30, None),
    ("G02", 3600, 65.01, 30, "Impossible Physics"),
    ("G03", 0, 5, 25, "Teleporter"),
    ("G04", 0, 0, 25, "Teleporter"),
    ("G05", 0, 0, 5, "Stationary Ride"),
    ("G06", 30, 2, 25, "Impossible Physics"),
    ("G07", -600, 3, 25, "Teleporter"),
    ("G08", -600, 3, 10, None),
    ("G09", 600, 0, 0, None),
    ("G10", 600, 0, -5, None),
    ("G11", None, 1, 25, None),
    ("G12", 600, math.nan, 10, "Impossible Physics"),
    ("G13", 59.5, 0.5, 20.01, "Teleporter"),
    ("G14", 60, 0.5, 20.01, None),
    ("G15", 10, 0.1, 20, None),
    ("G16", 600, None, 25, None),
    ("G17", 600, 0, None, None),
]

TRIP_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("pickup_time", T.TimestampNTZType()),
    T.StructField("dropoff_time", T.TimestampNTZType()),
    T.StructField("pickup_loc", T.LongType()),
    T.StructField("dropoff_loc", T.LongType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("fare", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("congestion_surcharge", T.DoubleType()),
    T.StructField("taxi_type", T.StringType()),
    T.StructField("VendorID", T.LongType()),
])


def edge_frame(spark):
    rows = []
    for rid, dur, dist, fare, _ in EDGE_ROWS:
        drop = None if dur is None else T0 + dt.timedelta(seconds=dur)
        rows.append((rid, T0, drop, 1, 2, None if dist is None else float(dist),
                     None if fare is None else float(fare), 0.0, 0.0, "yellow", 1))
    return spark.createDataFrame(rows, TRIP_SCHEMA)


def test_edge_rows(spark):
    got = {r.id: r.forensic_flag for r in flag_trips(edge_frame(spark)).select("id", "forensic_flag").collect()}
    for rid, *_, expected in EDGE_ROWS:
        assert got[rid] == expected, rid


def test_duration_keeps_fraction_and_zero_speed_is_null(spark):
    rows = {r.id: r for r in flag_trips(edge_frame(spark)).collect()}
    assert rows["G13"].duration_sec == pytest.approx(59.5)
    assert rows["G03"].avg_speed_mph is None
    assert rows["G07"].duration_sec == -600


def test_split_is_a_partition_of_all_rows(spark):
    flagged = flag_trips(edge_frame(spark))
    log, clean = audit_log(flagged), clean_trips(flagged)
    assert log.count() + clean.count() == flagged.count()
    assert "forensic_flag" not in clean.columns and "duration_sec" not in clean.columns
    ids = {r.id for r in log.select("id").union(clean.select("id")).collect()}
    assert ids == {r[0] for r in EDGE_ROWS}


def test_flag_stats(spark):
    stats = {r.forensic_flag: r.n for r in flag_stats(flag_trips(edge_frame(spark))).collect()}
    assert stats == {"Impossible Physics": 3, "Teleporter": 4, "Stationary Ride": 1}

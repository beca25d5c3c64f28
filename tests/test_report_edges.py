"""Report semantics on hand-made rows (FIXTURES.md §2, 'also to cover')."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cordon.functions.time import shift_years
from cordon.operators import (
    border_effect,
    border_geo,
    period_volumes,
    rain_daily,
    rain_elasticity,
    rain_trend,
    surcharge_leakage,
    suspicious_vendors,
    velocity,
    velocity_grid,
    volume_change_kpi,
)
from cordon.spec import AuditSpec

from test_flags import TRIP_SCHEMA

SPEC = AuditSpec()  # reference calendar: 2025, policy 2025-01-05, baseline 2024-01
ZIN, ZOUT = 4, 1  # a zone id inside the priced zone / outside it


def trips(spark, rows):
    """rows: (pickup, minutes, pu, do, distance, fare, surcharge, vendor)."""
    out = []
    for i, (pu_t, mins, pu, do, dist, fare, sur, vendor) in enumerate(rows):
        out.append((f"r{i}", pu_t, pu_t + dt.timedelta(minutes=mins), pu, do, dist, fare,
                    fare + (sur or 0) + 1.0, sur, "yellow", vendor))
    return spark.createDataFrame(out, TRIP_SCHEMA).drop("id")


def test_leakage_negative_surcharge_is_neither(spark):
    t = dt.datetime(2025, 2, 1, 9)
    df = trips(spark, [
        (t, 10, ZOUT, ZIN, 1.0, 10.0, 2.5, 1),
        (t, 10, ZOUT, ZIN, 1.0, 10.0, 0.0, 1),
        (t, 10, ZOUT, ZIN, 1.0, 10.0, -2.5, 1),
        (t, 10, None, ZIN, 1.0, 10.0, 0.0, 1),   # null pickup zone: dropped by NOT IN
        (dt.datetime(2025, 1, 4, 23), 10, ZOUT, ZIN, 1.0, 10.0, 0.0, 1),  # before policy
    ])
    (row,) = surcharge_leakage(df, SPEC).collect()
    assert row.pickup_loc == ZOUT and row.trip_count == 3
    assert row.missing_surcharge_hits == 1
    assert abs(row.compliance_rate - 1 / 3) < 1e-12


def test_leakage_tie_at_cut_is_broken_by_zone(spark):
    t = dt.datetime(2025, 2, 1, 9)
    rows = [(t, 10, pu, ZIN, 1.0, 10.0, 0.0, 1) for pu in (9, 8, 7, 6)]
    got = [r.pickup_loc for r in surcharge_leakage(trips(spark, rows), SPEC).collect()]
    assert got == [6, 7, 8]


def test_volumes_empty_baseline_gives_zero_row(spark):
    t = dt.datetime(2025, 3, 31, 0, 0)  # midnight of the last day: inside BETWEEN
    late = dt.datetime(2025, 3, 31, 0, 0, 1)  # one second later: outside
    clean = trips(spark, [(t, 5, ZIN, ZOUT, 1.0, 5.0, 2.5, 1), (late, 5, ZIN, ZOUT, 1.0, 5.0, 2.5, 1)])
    empty = clean.limit(0)
    got = {r.period: r.volume for r in period_volumes(empty, clean, SPEC).collect()}
    assert got == {"2024_Q1": 0, "2025_Q1": 1}
    half = {r.period: r.volume for r in period_volumes(empty, clean, SPEC.with_(half_open=True)).collect()}
    assert half["2025_Q1"] == 2
    (kpi,) = volume_change_kpi(period_volumes(empty, clean, SPEC), SPEC).collect()
    assert kpi.v_before == 0 and kpi.pct_change is None and kpi.delta == -1


def test_vendor_ranking(spark):
    t = dt.datetime(2025, 2, 1, 9)
    log = trips(spark, [(t, 1, 1, 1, 0.0, 5.0, 0.0, v) for v in (2, 2, 1, 1, 3)]).withColumn(
        "forensic_flag", F.lit("Stationary Ride"))
    got = [(r.VendorID, r.ghost_count) for r in suspicious_vendors(log, SPEC.with_(top_vendors=2)).collect()]
    assert got == [(1, 2), (2, 2)]


def test_border_zone_on_one_side_vanishes(spark):
    t = dt.datetime(2025, 2, 1, 9)
    base = trips(spark, [(t, 5, ZOUT, 236, 1.0, 5.0, 0.0, 1), (t, 5, ZOUT, 237, 1.0, 5.0, 0.0, 1),
                         (t, 5, ZOUT, 236, 1.0, 5.0, 0.0, 1)])
    clean = trips(spark, [(t, 5, ZOUT, 236, 1.0, 5.0, 0.0, 1), (t, 5, ZOUT, 263, 1.0, 5.0, 0.0, 1)])
    rows = border_effect(base, clean, SPEC).collect()
    assert [(r.loc_id, r.count_24, r.count_25, r.change_rate) for r in rows] == [(236, 2, 1, -0.5)]
    (geo,) = border_geo(border_effect(base, clean, SPEC)).collect()
    assert (geo.lat, geo.lon) == (40.77, -73.95)


def test_border_geo_default_coordinates(spark):
    t = dt.datetime(2025, 2, 1, 9)
    both = trips(spark, [(t, 5, ZOUT, 263, 1.0, 5.0, 0.0, 1)])
    (geo,) = border_geo(border_effect(both, both, SPEC)).collect()
    assert (geo.loc_id, geo.lat, geo.lon) == (263, 40.75, -73.98)


def test_velocity_grid_nulls_and_names(spark):
    mon = dt.datetime(2025, 1, 6, 8)  # a Monday
    df = trips(spark, [(mon, 30, ZIN, ZIN, 10.0, 5.0, 0.0, 1), (mon, 60, ZIN, ZIN, 10.0, 5.0, 0.0, 1),
                       (mon + dt.timedelta(days=1, hours=2), 0, ZIN, ZIN, 1.0, 5.0, 0.0, 1)])
    speeds = velocity(df, SPEC, q1_only=True)
    grid = {r.dow: r for r in velocity_grid(speeds).collect()}
    assert set(grid) == {"Monday", "Tuesday"}
    assert grid["Monday"].h08 == 15.0  # mean of 20 and 10 mph
    assert grid["Tuesday"].h10 is None  # zero duration -> null speed
    assert grid["Monday"].h09 is None


def _weather(spark, rows):
    return spark.createDataFrame(rows, "date date, precip_mm double")


def test_rain_day_without_weather_and_null_precip(spark):
    d1, d2, d3 = (dt.datetime(2025, 5, d, 10) for d in (1, 2, 3))
    clean = trips(spark, [(d1, 5, 1, 1, 1.0, 5.0, 0.0, 1), (d2, 5, 1, 1, 1.0, 5.0, 0.0, 1),
                          (d2, 5, 1, 1, 1.0, 5.0, 0.0, 1), (d3, 5, 1, 1, 1.0, 5.0, 0.0, 1)])
    w = _weather(spark, [(dt.date(2025, 5, 1), 0.0), (dt.date(2025, 5, 2), 10.0), (dt.date(2025, 5, 4), None)])
    rain = rain_daily(clean, w)
    assert sorted((r.date.day, r.daily_trips) for r in rain.collect()) == [(1, 1), (2, 2)]
    (c,) = rain_elasticity(rain).collect()
    assert abs(c.correlation - 1.0) < 1e-12
    (tr,) = rain_trend(rain).collect()
    assert abs(tr.slope - 0.1) < 1e-12 and abs(tr.intercept - 1.0) < 1e-12 and abs(tr.r2 - 1.0) < 1e-12


def test_constant_precipitation_gives_null_not_error(spark):
    d1, d2 = dt.datetime(2025, 5, 1, 10), dt.datetime(2025, 5, 2, 10)
    clean = trips(spark, [(d1, 5, 1, 1, 1.0, 5.0, 0.0, 1), (d2, 5, 1, 1, 1.0, 5.0, 0.0, 1),
                          (d2, 5, 1, 1, 1.0, 5.0, 0.0, 1)])
    w = _weather(spark, [(dt.date(2025, 5, 1), 3.0), (dt.date(2025, 5, 2), 3.0)])
    rain = rain_daily(clean, w)
    assert rain_elasticity(rain).collect()[0].correlation is None
    assert rain_trend(rain).collect()[0].slope is None


def test_correlation_skips_incomplete_pairs(spark):
    rain = spark.createDataFrame(
        [(1, 1.0), (2, 2.0), (3, 2.5), (10, None)], "daily_trips long, precip_mm double")
    got = rain_elasticity(rain).collect()[0].correlation
    import numpy as np
    want = np.corrcoef([1, 2, 3], [1.0, 2.0, 2.5])[0, 1]
    assert abs(got - want) < 1e-12


def test_feb29_shift_clamps(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 29, 13, 5),)], "t timestamp_ntz")
    (r,) = df.select(shift_years("t", 1).alias("a"), shift_years("t", 4).alias("b")).collect()
    assert r.a == dt.datetime(2025, 2, 28, 13, 5) and r.b == dt.datetime(2028, 2, 29, 13, 5)


def test_kpi_text(spark):
    from cordon.operators import volume_change_text

    vols = spark.createDataFrame([("2024_Q1", 4000), ("2025_Q1", 3500)], "period string, volume long")
    (r,) = volume_change_text(volume_change_kpi(vols, SPEC)).collect()
    assert (r.v_before, r.v_after, r.pct_change, r.delta) == (4000, 3500, -12.5, 500)
    assert (r.pct_label, r.delta_label) == ("-12.5%", "500 trips")


def test_durations_ignore_session_zone_dst(spark):
    """NTZ wall-clock difference, as the reference's naive timestamps: no DST hour."""
    from cordon.functions.time import seconds_between

    df = spark.createDataFrame([
        (dt.datetime(2025, 3, 9, 1, 30), dt.datetime(2025, 3, 9, 3, 30, 0, 250000), 7200.25),  # across the gap
        (dt.datetime(2000, 4, 2, 2, 58, 26), dt.datetime(2000, 4, 2, 3, 13, 35), 909.0),  # starts in the gap
        (dt.datetime(2025, 11, 2, 1, 30), dt.datetime(2025, 11, 2, 1, 10), -1200.0),  # repeated hour
    ], "a timestamp_ntz, b timestamp_ntz, want double")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        for r in df.select(seconds_between("a", "b").alias("s"), "want").collect():
            assert r.s == r.want
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_border_time_bounds(spark):
    t_in, t_out = dt.datetime(2025, 2, 1, 9), dt.datetime(2025, 6, 1, 9)
    base = trips(spark, [(t_in, 5, ZOUT, 236, 1.0, 5.0, 0.0, 1)])
    clean = trips(spark, [(t_in, 5, ZOUT, 236, 1.0, 5.0, 0.0, 1), (t_out, 5, ZOUT, 236, 1.0, 5.0, 0.0, 1)])
    assert border_effect(base, clean, SPEC).first().count_25 == 2
    bounded = SPEC.with_(border_start="2025-01-01", border_end="2025-04-01")
    assert border_effect(base, clean, bounded).first().count_25 == 1
    from cordon.operators.onepass import border_from, clean_report_cube
    assert border_from(clean_report_cube(clean, bounded), "count_25").first().count_25 == 1


def test_weather_failure_modes(spark, tmp_path):
    import pytest
    from pyspark.errors import AnalysisException

    from cordon.sources import read_weather_json

    with pytest.raises(AnalysisException):
        read_weather_json(spark, str(tmp_path / "absent.json")).count()
    d = dt.datetime(2025, 5, 1, 10)
    clean = trips(spark, [(d, 5, 1, 1, 1.0, 5.0, 0.0, 1)])
    rain = rain_daily(clean, _weather(spark, [(dt.date(2025, 6, 1), 1.0)]))  # no common day
    assert rain.count() == 0
    assert rain_elasticity(rain).first().correlation is None

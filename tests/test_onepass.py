"""The one-pass report cube gives the same reports as the per-report operators."""

import math

from cordon.operators import (
    border_effect,
    daily_trips,
    period_volumes,
    surcharge_leakage,
    tip_crowding,
    velocity_after,
    velocity_before,
)
from cordon.operators.onepass import (
    baseline_report_cube,
    border_from,
    clean_report_cube,
    daily_from,
    leakage_from,
    speed_from,
    tips_from,
    volume_from,
)
from cordon.operators.reports import border_change
from cordon.plans.registry import Inputs

from conftest import SF_MID


def same(a, b):
    ra = sorted((tuple(r) for r in a.collect()), key=str)
    rb = sorted((tuple(r) for r in b.collect()), key=str)
    assert len(ra) == len(rb)
    for x, y in zip(ra, rb):
        for u, v in zip(x, y):
            if isinstance(u, float) or isinstance(v, float):
                assert (u is None and v is None) or math.isclose(u, v, rel_tol=1e-9, abs_tol=1e-9), (x, y)
            else:
                assert u == v, (x, y)


def test_cube_reports_equal_direct_reports(spark):
    i = Inputs(spark, SF_MID)
    s = i.spec
    cube = clean_report_cube(i.clean, s).cache()
    try:
        same(leakage_from(cube, s), surcharge_leakage(i.clean, s))
        same(tips_from(cube), tip_crowding(i.clean, s))
        same(speed_from(cube), velocity_after(i.clean, s))
        same(daily_from(cube), daily_trips(i.clean))
        before = baseline_report_cube(i.baseline, s)
        same(volume_from(before, s.baseline_label).unionByName(volume_from(cube, s.analysis_label)),
             period_volumes(i.baseline, i.clean, s))
        same(border_change(border_from(before, "count_24"), border_from(cube, "count_25")),
             border_effect(i.baseline, i.clean, s))
        same(speed_from(before), velocity_before(i.baseline, s))
        assert cube.count() < 2000  # every report at its grain, a few hundred rows
    finally:
        cube.unpersist()


def test_cube_is_one_scan_one_shuffle(spark):
    from test_plans import plan

    i = Inputs(spark, SF_MID)
    p = plan(clean_report_cube(i.clean, i.spec))
    assert p.count("Arguments: hashpartitioning(") == 1
    assert "Generate explode" in p or "Generate" in p


def test_cube_averages_skip_nulls_like_the_direct_reports(spark):
    """Null totals, fares, times and zones: a null value drops out of an average, the trip stays counted."""
    import datetime as dt

    from cordon.spec import AuditSpec

    s = AuditSpec()
    t = dt.datetime(2025, 2, 3, 10)
    rows = [(t, t + dt.timedelta(minutes=10), 1, 4, 2.0, 10.0, 17.0, 3.0, "yellow", 1), (t, t + dt.timedelta(minutes=10), 4, 4, 2.0, 10.0, None, 3.0, "yellow", 1),
            (t, None, 4, 12, 2.0, None, 9.0, 0.0, "green", None), (None, t, 4, 4, 1.0, 5.0, 6.0, 0.0, "green", 2), (t, t, None, 4, None, 5.0, 6.0, None, "green", 2)]
    trips = spark.createDataFrame(rows, "pickup_time timestamp_ntz, dropoff_time timestamp_ntz, pickup_loc long, dropoff_loc long, trip_distance double, "
                                        "fare double, total_amount double, congestion_surcharge double, taxi_type string, VendorID long")
    cube = clean_report_cube(trips, s)
    same(tips_from(cube), tip_crowding(trips, s))
    same(speed_from(cube), velocity_after(trips, s))
    same(leakage_from(cube, s), surcharge_leakage(trips, s))
    same(daily_from(cube), daily_trips(trips))
    (feb,) = tips_from(cube).collect()
    assert feb.avg_tip_pct == (40.0 + 0.0) / 2  # the trip without a total is not in it, the one without a fare counts 0

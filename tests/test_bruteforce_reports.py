"""Reports against plain-Python versions on random trips (hypothesis)."""

import datetime as dt
import math
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cordon.operators import (
    border_effect,
    period_volumes,
    surcharge_leakage,
    tip_crowding,
    velocity,
)
from cordon.spec import AuditSpec

from test_flags import TRIP_SCHEMA

SPEC = AuditSpec(top_leakage=1000)  # whole ranking, so the comparison covers every zone
ZONE = set(SPEC.zone_ids)
BORDER = set(SPEC.border_ids)
LOCS = [1, 2, 4, 12, 236, 237, 263, 140, 99]
START = dt.datetime(2024, 12, 30)

trip = st.tuples(
    st.integers(0, 24 * 100),                  # pickup hour offset from START
    st.integers(0, 3599),                      # seconds within the hour
    st.sampled_from([0, 30, 600, 1800]),       # duration s
    st.sampled_from(LOCS), st.sampled_from(LOCS),
    st.sampled_from([0.0, 0.5, 3.0, 12.0]),    # distance
    st.sampled_from([-5.0, 0.0, 7.5, 25.0]),   # fare
    st.sampled_from([None, -2.5, 0.0, 2.5]),   # surcharge
    st.floats(0, 10, allow_nan=False),         # extra on total
)
SETTINGS = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, rows):
    data = []
    for i, (h, sec, dur, pu, do, dist, fare, sur, extra) in enumerate(rows):
        t = START + dt.timedelta(hours=h, seconds=sec)
        data.append((str(i), t, t + dt.timedelta(seconds=dur), pu, do, dist, fare,
                     fare + (sur or 0.0) + extra, sur, "yellow", 1))
    return spark.createDataFrame(data, TRIP_SCHEMA).drop("id"), data


def close(a, b):
    return (a is None and b is None) or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9))


@SETTINGS
@given(st.lists(trip, min_size=1, max_size=120))
def test_reports_match_python(spark, rows):
    df, data = frame(spark, rows)
    policy = dt.datetime(2025, 1, 5)
    q1_lo, q1_hi = dt.datetime(2025, 1, 1), dt.datetime(2025, 3, 31)

    # leakage; the surcharge is raw here (may be null): null is neither > 0 nor = 0
    agg = defaultdict(lambda: [0, 0, 0])
    for _, t, _, pu, do, _, _, _, sur, _, _ in data:
        if pu not in ZONE and do in ZONE and t >= policy:
            a = agg[pu]
            a[0] += 1
            a[1] += 1 if sur is not None and sur > 0 else 0
            a[2] += 1 if sur is not None and sur == 0 else 0
    want = sorted(((k, v[0], v[1] / v[0], v[2]) for k, v in agg.items()), key=lambda r: (-r[3], r[0]))
    got = [tuple(r) for r in surcharge_leakage(df, SPEC).collect()]
    assert [(g[0], g[1], g[3]) for g in got] == [(w[0], w[1], w[3]) for w in want]
    assert all(close(g[2], w[2]) for g, w in zip(got, want))

    # volumes (the frame is used as both baseline and analysis trips)
    touch = [r for r in data if r[3] in ZONE or r[4] in ZONE]
    vols = {r.period: r.volume for r in period_volumes(df, df, SPEC).collect()}
    assert vols == {"2024_Q1": len(touch), "2025_Q1": sum(1 for r in touch if q1_lo <= r[1] <= q1_hi)}

    # speed cells inside the zone in Q1
    cells = defaultdict(list)
    for _, t, d, pu, do, dist, _, _, _, _, _ in data:
        if pu in ZONE and do in ZONE and q1_lo <= t <= q1_hi:
            secs = (d - t).total_seconds()
            cells[(t.hour, t.strftime("%A"))].append(None if secs == 0 else dist / (secs / 3600.0))
    got = {(r.hour, r.dow): r.speed for r in velocity(df, SPEC, q1_only=True).collect()}
    assert set(got) == set(cells)
    for k, vals in cells.items():
        vals = [v for v in vals if v is not None]
        assert close(got[k], sum(vals) / len(vals) if vals else None)

    # tips by month after the policy date (null surcharge -> null tip -> skipped by avg)
    months = defaultdict(list)
    for _, t, _, _, _, _, fare, total, sur, _, _ in data:
        if t >= policy:
            months[t.month].append((fare, total, sur))
    got = {r.month: (r.avg_surcharge, r.avg_tip_pct) for r in tip_crowding(df, SPEC).collect()}
    assert set(got) == set(months)
    for m, vals in months.items():
        surs = [s for _, _, s in vals if s is not None]
        tips = [((tot - f - s) / f * 100 if f > 0 else 0.0) if (f <= 0 or s is not None) else None
                for f, tot, s in vals]
        tips = [x for x in tips if x is not None]
        assert close(got[m][0], sum(surs) / len(surs) if surs else None)
        assert close(got[m][1], sum(tips) / len(tips) if tips else None)

    # border change (same frame on both sides: change 0 for every border zone present)
    drops = defaultdict(int)
    for r in data:
        if r[4] in BORDER:
            drops[r[4]] += 1
    got = {r.loc_id: (r.count_24, r.count_25, r.change_rate) for r in border_effect(df, df, SPEC).collect()}
    assert got == {k: (v, v, 0.0) for k, v in drops.items()}

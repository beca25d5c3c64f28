"""DuckDB SQL for every registered query, written independently of the Spark code.

Views ``lineitem`` and ``events`` are expected to exist (the driver registers them).
Floating results are rounded to 6 digits exactly as :func:`cordon.plans.registry.finish`.
"""

from __future__ import annotations

from cordon.spec import (
    BORDER_IDS,
    DEFAULT_COORD,
    FLAG_SPEED,
    FLAG_STATIONARY,
    FLAG_TELEPORT,
    MAX_SPEED_MPH,
    MIN_DURATION_SEC,
    TELEPORT_MIN_FARE,
    ZONE_COORDS,
    fixture_spec,
)

S = fixture_spec()
ZONES = ", ".join(map(str, S.zone_ids))
BORDER = ", ".join(map(str, BORDER_IDS))
Y = S.analysis_year

# every lineitem row as a trip (FIXTURES.md §4)
_MAPPED = """
SELECT
  trip_key, pickup_time, dropoff_time, pickup_loc, dropoff_loc, trip_distance, fare,
  fare * (1.0 + 2.0 * l_tax) + l_discount * 25.0 AS total_amount,
  congestion_surcharge, taxi_type, VendorID
FROM (
  SELECT
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS trip_key,
    l_shipdate + to_seconds((l_orderkey * 37 + l_linenumber * 911) % 86400) AS pickup_time,
    l_shipdate + to_seconds((l_orderkey * 37 + l_linenumber * 911) % 86400
                            + (l_partkey * 7 + l_linenumber * 13 + l_suppkey * 3) % 2400) AS dropoff_time,
    CAST(1 + l_partkey % 263 AS BIGINT) AS pickup_loc,
    CAST(1 + (l_suppkey * 5 + l_linenumber) % 263 AS BIGINT) AS dropoff_loc,
    CASE WHEN l_quantity = 1 THEN CAST(0.0 AS DOUBLE) ELSE l_quantity / 8.0 END AS trip_distance,
    CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN -(l_extendedprice / 2000.0)
         ELSE l_extendedprice / 2000.0 END AS fare,
    l_tax, l_discount,
    CASE WHEN l_discount = 0.01 THEN CAST(NULL AS DOUBLE) ELSE l_discount * 25.0 END AS congestion_surcharge,
    CASE WHEN l_linestatus = 'O' THEN 'yellow' ELSE 'green' END AS taxi_type,
    CAST(l_suppkey % 6 AS BIGINT) AS VendorID
  FROM lineitem
) m
"""


def _between(lo: str, hi: str) -> str:
    return f"pickup_time >= TIMESTAMP '{lo}' AND pickup_time < TIMESTAMP '{hi}'"


def _month(year: int, month: int) -> tuple[str, str]:
    nxt = (year + (month == 12), month % 12 + 1)
    return f"{year}-{month:02d}-01", f"{nxt[0]}-{nxt[1]:02d}-01"


def _raw(feed: str, lo: str, hi: str) -> str:
    p = "tpep" if feed == "yellow" else "lpep"
    return f"""
SELECT VendorID, pickup_time AS {p}_pickup_datetime, dropoff_time AS {p}_dropoff_datetime,
       trip_distance, pickup_loc AS PULocationID, dropoff_loc AS DOLocationID,
       fare AS fare_amount, total_amount, congestion_surcharge, trip_key
FROM mapped WHERE taxi_type = '{feed}' AND {_between(lo, hi)}
"""


_BASE_CTES = f"""
mapped AS ({_MAPPED}),
trips AS (
  SELECT pickup_time, dropoff_time, pickup_loc, dropoff_loc, trip_distance, fare, total_amount,
         COALESCE(congestion_surcharge, 0) AS congestion_surcharge, taxi_type, VendorID
  FROM mapped WHERE {_between(f"{Y}-01-01", f"{Y + 1}-01-01")}
),
flagged AS (
  SELECT *,
    CASE WHEN avg_speed_mph > {MAX_SPEED_MPH} THEN '{FLAG_SPEED}'
         WHEN duration_sec < {MIN_DURATION_SEC} AND fare > {TELEPORT_MIN_FARE} THEN '{FLAG_TELEPORT}'
         WHEN trip_distance = 0 AND fare > 0 THEN '{FLAG_STATIONARY}'
    END AS forensic_flag
  FROM (
    SELECT *,
      epoch(dropoff_time) - epoch(pickup_time) AS duration_sec,
      trip_distance / (NULLIF(epoch(dropoff_time) - epoch(pickup_time), 0) / 3600.0) AS avg_speed_mph
    FROM trips
  ) c
),
clean AS (SELECT * EXCLUDE (duration_sec, avg_speed_mph, forensic_flag) FROM flagged WHERE forensic_flag IS NULL),
flog AS (SELECT * FROM flagged WHERE forensic_flag IS NOT NULL),
baseline AS (
  SELECT pickup_time, dropoff_time, pickup_loc, dropoff_loc, trip_distance, fare
  FROM mapped WHERE taxi_type = '{S.baseline_feed}' AND {_between(*_month(S.baseline_year, S.baseline_month))}
),
baseline_q1_all AS (
  SELECT pickup_time, dropoff_time, pickup_loc, dropoff_loc, trip_distance, fare
  FROM mapped WHERE {_between(f"{S.baseline_year}-01-01", f"{S.baseline_year}-04-01")}
),
baseline_audited AS (
  SELECT * FROM baseline
  WHERE NOT coalesce(
    trip_distance / (NULLIF(epoch(dropoff_time) - epoch(pickup_time), 0) / 3600.0) > {MAX_SPEED_MPH}
    OR (epoch(dropoff_time) - epoch(pickup_time) < {MIN_DURATION_SEC} AND fare > {TELEPORT_MIN_FARE})
    OR (trip_distance = 0 AND fare > 0), false)
),
weather AS (
  SELECT CAST(ts - INTERVAL '24 years' AS DATE) AS date, sum(value) AS precip_mm FROM events GROUP BY 1
),
rain AS (
  SELECT d.date, d.daily_trips, w.precip_mm
  FROM (SELECT CAST(pickup_time AS DATE) AS date, count(*) AS daily_trips FROM clean GROUP BY 1) d
  JOIN weather w ON d.date = w.date
)
"""


def _with(body: str, round_cols: tuple[str, ...] = ()) -> str:
    sql = f"WITH {_BASE_CTES}\n{body}"
    if not round_cols:
        return sql
    repl = ", ".join(f"round({c}, 6) AS {c}" for c in round_cols)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) q"


TRIP_DOUBLES = ("trip_distance", "fare", "total_amount", "congestion_surcharge")
RAW_DOUBLES = ("trip_distance", "fare_amount", "total_amount", "congestion_surcharge")
Q1 = f"pickup_time BETWEEN TIMESTAMP '{S.q1_start}' AND TIMESTAMP '{S.q1_end}'"
Q1_HALF_OPEN = f"pickup_time >= TIMESTAMP '{S.q1_start}' AND pickup_time < TIMESTAMP '{S.q1_end}' + INTERVAL 1 DAY"
INSIDE = f"pickup_loc IN ({ZONES}) AND dropoff_loc IN ({ZONES})"
TOUCHING = f"(pickup_loc IN ({ZONES}) OR dropoff_loc IN ({ZONES}))"


def _velocity(src: str, extra: str = "") -> str:
    return f"""
SELECT hour(pickup_time) AS hour, dayname(pickup_time) AS dow,
       avg(trip_distance / (NULLIF(epoch(dropoff_time) - epoch(pickup_time), 0) / 3600.0)) AS speed
FROM {src} WHERE {INSIDE} {extra}
GROUP BY 1, 2
"""


def _grid(src: str, extra: str = "") -> str:
    cells = ", ".join(f"max(CASE WHEN hour = {h} THEN speed END) AS h{h:02d}" for h in range(24))
    return f"SELECT dow, {cells} FROM ({_velocity(src, extra)}) v GROUP BY dow"


_BORDER = f"""
SELECT b.loc_id, b.count_24, a.count_25,
       (CAST(a.count_25 AS DOUBLE) - b.count_24) / b.count_24 AS change_rate
FROM (SELECT dropoff_loc AS loc_id, count(*) AS count_24 FROM baseline
      WHERE dropoff_loc IN ({BORDER}) GROUP BY 1) b
JOIN (SELECT dropoff_loc AS loc_id, count(*) AS count_25 FROM clean GROUP BY 1) a ON a.loc_id = b.loc_id
"""

_VOLUMES = f"""
SELECT '{S.baseline_label}' AS period, count(*) AS volume FROM baseline WHERE {TOUCHING}
UNION ALL
SELECT '{S.analysis_label}' AS period, count(*) AS volume FROM clean WHERE {TOUCHING} AND {Q1}
"""

_VOLUMES_LFL = _VOLUMES.replace("FROM baseline WHERE", "FROM baseline_q1_all WHERE")
_VOLUMES_HALF_OPEN = _VOLUMES.replace(f"AND {Q1}", f"AND {Q1_HALF_OPEN}")


def _impute_aligned(feed: str) -> str:
    p = "tpep" if feed == "yellow" else "lpep"
    lo, hi = _month(Y, S.impute_month)
    parts = []
    for d in S.donors:
        days = 364 * d.years_back
        thr = f"{min(int(d.fraction * 2**32), 2**32 - 1):08x}"
        parts.append(f"""
SELECT * REPLACE ({p}_pickup_datetime + INTERVAL {days} DAY AS {p}_pickup_datetime,
                  {p}_dropoff_datetime + INTERVAL {days} DAY AS {p}_dropoff_datetime)
FROM (
  SELECT VendorID, pickup_time AS {p}_pickup_datetime, dropoff_time AS {p}_dropoff_datetime,
         trip_distance, pickup_loc AS PULocationID, dropoff_loc AS DOLocationID,
         fare AS fare_amount, total_amount, congestion_surcharge, trip_key
  FROM mapped
  WHERE taxi_type = '{feed}'
    AND pickup_time >= TIMESTAMP '{lo}' - INTERVAL {days} DAY
    AND pickup_time < TIMESTAMP '{hi}' - INTERVAL {days} DAY
) r WHERE substr(md5(trip_key), 1, 8) < '{thr}'""")
    return "\nUNION ALL\n".join(parts)


_COORDS = ", ".join(f"({k}, CAST({v[0]} AS DOUBLE), CAST({v[1]} AS DOUBLE))" for k, v in ZONE_COORDS.items())


def _impute(feed: str) -> str:
    p = "tpep" if feed == "yellow" else "lpep"
    parts = []
    for d in S.donors:
        lo, hi = _month(Y - d.years_back, S.impute_month)
        thr = f"{min(int(d.fraction * 2**32), 2**32 - 1):08x}"
        parts.append(f"""
SELECT * REPLACE ({p}_pickup_datetime + INTERVAL '{d.years_back} years' AS {p}_pickup_datetime,
                  {p}_dropoff_datetime + INTERVAL '{d.years_back} years' AS {p}_dropoff_datetime)
FROM ({_raw(feed, lo, hi)}) r WHERE substr(md5(trip_key), 1, 8) < '{thr}'""")
    return "\nUNION ALL\n".join(parts)


_PREDICATES = {
    "pickup_in_zone": f"pickup_loc IN ({ZONES})",
    "pickup_not_in_zone": f"pickup_loc NOT IN ({ZONES})",
    "entering": f"pickup_loc NOT IN ({ZONES}) AND dropoff_loc IN ({ZONES})",
    "inside": INSIDE,
    "touching": TOUCHING,
    "after_policy": f"pickup_time >= TIMESTAMP '{S.policy_start}'",
    "in_q1": Q1,
    "in_q1_half_open": Q1_HALF_OPEN,
    "surcharge_null": "congestion_surcharge IS NULL",
    "fare_positive": "fare > 0",
}


def _thresholds(speed: float, duration: float, fare: float) -> str:
    """``flag_trips`` with other limits."""
    sql = _with("SELECT * FROM flagged", TRIP_DOUBLES + ("duration_sec", "avg_speed_mph"))
    for old, new in ((f"WHEN avg_speed_mph > {MAX_SPEED_MPH}", f"WHEN avg_speed_mph > {speed}"),
                     (f"WHEN duration_sec < {MIN_DURATION_SEC} AND fare > {TELEPORT_MIN_FARE}", f"WHEN duration_sec < {duration} AND fare > {fare}")):
        sql = sql.replace(old, new)
    return sql


def _flagged_all(columns: str, where: str = "true") -> str:
    """Every trip of ``lineitem``, flagged."""
    return f"""
SELECT {columns},
  CASE WHEN avg_speed_mph > {MAX_SPEED_MPH} THEN '{FLAG_SPEED}'
       WHEN duration_sec < {MIN_DURATION_SEC} AND fare > {TELEPORT_MIN_FARE} THEN '{FLAG_TELEPORT}'
       WHEN trip_distance = 0 AND fare > 0 THEN '{FLAG_STATIONARY}' END AS forensic_flag
FROM (SELECT * REPLACE (coalesce(congestion_surcharge, 0) AS congestion_surcharge), epoch(dropoff_time) - epoch(pickup_time) AS duration_sec,
             trip_distance / (NULLIF(epoch(dropoff_time) - epoch(pickup_time), 0) / 3600.0) AS avg_speed_mph FROM mapped) c
WHERE {where}
"""


def _impute_exact(feed: str) -> str:
    """The donors' rows with the least key hashes, as many as their fraction of all."""
    p = "tpep" if feed == "yellow" else "lpep"
    parts = []
    for d in S.donors:
        lo, hi = _month(Y - d.years_back, S.impute_month)
        parts.append(f"""
SELECT * EXCLUDE (place, total) REPLACE ({p}_pickup_datetime + INTERVAL '{d.years_back} years' AS {p}_pickup_datetime,
                                         {p}_dropoff_datetime + INTERVAL '{d.years_back} years' AS {p}_dropoff_datetime)
FROM (SELECT *, row_number() OVER (ORDER BY md5(trip_key)) AS place, count(*) OVER () AS total FROM ({_raw(feed, lo, hi)}) r) q
WHERE place <= floor({round(d.fraction * 100)} * total / 100.0 + 0.5)""")
    return "\nUNION ALL\n".join(parts)


def _published(plain: dict[str, str]) -> str:
    """The reports of a run in one long table."""
    columns = {
        "leakage": ("surcharge_leakage", "pickup_loc", "trip_count", "compliance_rate", "missing_surcharge_hits"),
        "volumes": ("period_volumes", "period", "volume"), "vendors": ("suspicious_vendors", "VendorID || '/' || forensic_flag", "ghost_count"),
        "border": ("border_effect", "loc_id", "count_24", "count_25", "change_rate"), "velocity_after": ("velocity_after", "hour || '/' || dow", "speed"),
        "tips": ("tip_crowding", "month", "avg_surcharge", "avg_tip_pct"),
        "rain_stats": ("scalar_text", "'correlation'", "correlation"),
    }
    parts = []
    for name, (query, key, *values) in columns.items():
        cells = ", ".join(f"CAST({c} AS DOUBLE) AS v{i + 1}" for i, c in enumerate([*values, *["NULL"] * (3 - len(values))]))
        parts.append(f"SELECT '{name}' AS report, CAST({key} AS VARCHAR) AS key, {cells} FROM ({plain[query]}) q")
    return "\nUNION ALL\n".join(parts)


def _cube() -> str:
    """Each report of the clean trips at its grain."""
    tip = "CASE WHEN fare > 0 THEN ((total_amount - fare - congestion_surcharge) / fare) * 100 ELSE 0 END"
    after = f"pickup_time >= TIMESTAMP '{S.policy_start}'"
    grains = {
        "leakage": ("pickup_loc", "NULL", "NULL", f"pickup_loc NOT IN ({ZONES}) AND dropoff_loc IN ({ZONES}) AND {after}"),
        "volume": ("NULL", "NULL", "NULL", f"{TOUCHING} AND {Q1}"),
        "speed": ("hour(pickup_time)", "dayname(pickup_time)", "NULL", f"{INSIDE} AND {Q1}"),
        "tips": ("month(pickup_time)", "NULL", "NULL", after),
        "daily": ("NULL", "NULL", "CAST(pickup_time AS DATE)", "true"),
        "border": ("dropoff_loc", "NULL", "NULL", f"dropoff_loc IN ({BORDER})"),
    }
    return "\nUNION ALL\n".join(f"""
SELECT '{grain}' AS grain, CAST({k} AS BIGINT) AS k_long, CAST({s} AS VARCHAR) AS k_str, CAST({d} AS DATE) AS k_date, count(*) AS n,
       CAST(count(*) FILTER (WHERE congestion_surcharge > 0) AS BIGINT) AS n_pos, CAST(count(*) FILTER (WHERE congestion_surcharge = 0) AS BIGINT) AS n_zero,
       avg(congestion_surcharge) AS avg_surcharge,
       avg(trip_distance / (NULLIF(epoch(dropoff_time) - epoch(pickup_time), 0) / 3600.0)) AS avg_speed, avg({tip}) AS avg_tip
FROM clean WHERE {where} GROUP BY ALL""" for grain, (k, s, d, where) in grains.items())


def oracle_sql() -> dict[str, str]:
    thr30 = f"{int(S.donors[0].fraction * 2**32):08x}"
    sql = {
        "unify_feeds": _with("SELECT * FROM trips", TRIP_DOUBLES),
        "missing_periods": f"""
WITH mapped AS ({_MAPPED}),
present AS (SELECT DISTINCT taxi_type AS feed, year(pickup_time) AS year, month(pickup_time) AS month FROM mapped),
span AS (SELECT min(year) AS lo, max(year) AS hi FROM present),
cal AS (
  SELECT f.feed, y.year, m.month
  FROM (VALUES ('yellow'), ('green')) f(feed),
       (SELECT unnest(range(lo, hi + 1)) AS year FROM span) y,
       (SELECT unnest(range(1, 13)) AS month) m
)
SELECT feed, CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month FROM cal
WHERE NOT EXISTS (SELECT 1 FROM present p WHERE p.feed = cal.feed AND p.year = cal.year AND p.month = cal.month)
""",
        "impute_month": _with(_impute("yellow"), RAW_DOUBLES),
        "impute_month_green": _with(_impute("green"), RAW_DOUBLES),
        "flag_trips": _with("SELECT * FROM flagged", TRIP_DOUBLES + ("duration_sec", "avg_speed_mph")),
        "audit_log": _with("SELECT * FROM flog", TRIP_DOUBLES + ("duration_sec", "avg_speed_mph")),
        "clean_trips": _with("SELECT * FROM clean", TRIP_DOUBLES),
        "flag_stats": _with("SELECT forensic_flag, count(*) AS n FROM flog GROUP BY 1"),
        "surcharge_leakage": _with(f"""
SELECT pickup_loc, count(*) AS trip_count,
       avg(CASE WHEN congestion_surcharge > 0 THEN 1 ELSE 0 END) AS compliance_rate,
       CAST(sum(CASE WHEN congestion_surcharge = 0 THEN 1 ELSE 0 END) AS BIGINT) AS missing_surcharge_hits
FROM clean
WHERE pickup_loc NOT IN ({ZONES}) AND dropoff_loc IN ({ZONES})
  AND pickup_time >= TIMESTAMP '{S.policy_start}'
GROUP BY 1
ORDER BY missing_surcharge_hits DESC, pickup_loc NULLS LAST
LIMIT {S.top_leakage}
""", ("compliance_rate",)),
        "period_volumes": _with(_VOLUMES),
        "suspicious_vendors": _with(f"""
SELECT VendorID, forensic_flag, count(*) AS ghost_count FROM flog GROUP BY 1, 2
ORDER BY ghost_count DESC, VendorID NULLS LAST, forensic_flag LIMIT {S.top_vendors}
"""),
        "border_effect": _with(_BORDER, ("change_rate",)),
        "velocity_before": _with(_velocity("baseline"), ("speed",)),
        "velocity_after": _with(_velocity("clean", f"AND {Q1}"), ("speed",)),
        "tip_crowding": _with(f"""
SELECT month(pickup_time) AS month, avg(congestion_surcharge) AS avg_surcharge,
       avg(CASE WHEN fare > 0 THEN ((total_amount - fare - congestion_surcharge) / fare) * 100 ELSE 0 END) AS avg_tip_pct
FROM clean WHERE pickup_time >= TIMESTAMP '{S.policy_start}'
GROUP BY 1 ORDER BY 1
""", ("avg_surcharge", "avg_tip_pct")),
        "rain_daily": _with("SELECT date, daily_trips, precip_mm FROM rain", ("precip_mm",)),
        "rain_elasticity": _with("""
SELECT CASE WHEN isnan(c) THEN NULL ELSE c END AS correlation
FROM (SELECT corr(daily_trips, precip_mm) AS c FROM rain WHERE daily_trips IS NOT NULL AND precip_mm IS NOT NULL) t
""", ("correlation",)),
        "rain_trend": _with("""
SELECT CASE WHEN isnan(s) THEN NULL ELSE s END AS slope,
       CASE WHEN isnan(i) THEN NULL ELSE i END AS intercept,
       CASE WHEN isnan(r) THEN NULL ELSE r END AS r2
FROM (SELECT regr_slope(daily_trips, precip_mm) AS s, regr_intercept(daily_trips, precip_mm) AS i,
             regr_r2(daily_trips, precip_mm) AS r
      FROM rain WHERE daily_trips IS NOT NULL AND precip_mm IS NOT NULL) t
""", ("slope", "intercept", "r2")),
        "velocity_grid_before": _with(_grid("baseline"), tuple(f"h{h:02d}" for h in range(24))),
        "velocity_grid_after": _with(_grid("clean", f"AND {Q1}"), tuple(f"h{h:02d}" for h in range(24))),
        "border_geo": _with(f"""
SELECT b.*, COALESCE(c.lat, CAST({DEFAULT_COORD[0]} AS DOUBLE)) AS lat,
       COALESCE(c.lon, CAST({DEFAULT_COORD[1]} AS DOUBLE)) AS lon
FROM ({_BORDER}) b LEFT JOIN (VALUES {_COORDS}) c(loc_id, lat, lon) ON b.loc_id = c.loc_id
""", ("change_rate", "lat", "lon")),
        "volume_change_kpi": _with(f"""
SELECT v_before, v_after, (v_after - v_before) / CAST(NULLIF(v_before, 0) AS DOUBLE) * 100.0 AS pct_change,
       v_before - v_after AS delta
FROM (SELECT max(CASE WHEN period = '{S.baseline_label}' THEN volume END) AS v_before,
             max(CASE WHEN period = '{S.analysis_label}' THEN volume END) AS v_after
      FROM ({_VOLUMES}) v) w
""", ("pct_change",)),
        "period_volumes_like_for_like": _with(_VOLUMES_LFL),
        "period_volumes_half_open": _with(_VOLUMES_HALF_OPEN),
        "velocity_before_audited": _with(_velocity("baseline_audited"), ("speed",)),
        "impute_month_weekday_aligned": _with(_impute_aligned("yellow"), RAW_DOUBLES),
        "sample_hash": f"""
SELECT * REPLACE ({", ".join(f"round({c}, 6) AS {c}" for c in TRIP_DOUBLES)})
FROM ({_MAPPED}) t WHERE substr(md5(trip_key), 1, 8) < '{thr30}'
""",
        "sample_exact": f"""
SELECT * REPLACE ({", ".join(f"round({c}, 6) AS {c}" for c in TRIP_DOUBLES)})
FROM (SELECT * FROM ({_MAPPED}) t ORDER BY md5(trip_key) LIMIT 1000) s
""",
        "impute_month_exact": _with(_impute_exact("yellow"), RAW_DOUBLES),
        "shift_year": f"""
SELECT trip_key, pickup_time, pickup_time + INTERVAL '1 year' AS pickup_plus_1y,
       dropoff_time + INTERVAL '2 years' AS dropoff_plus_2y
FROM ({_MAPPED}) t
""",
        "project_exclude": _with("SELECT * EXCLUDE (pickup_time, dropoff_time) FROM mapped", TRIP_DOUBLES),
        "zone_predicates": _with(
            "SELECT * FROM ("
            + "\nUNION ALL\n".join(
                f"SELECT '{name}' AS predicate, CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS n FROM mapped"
                for name, cond in _PREDICATES.items()
            )
            + ") p"
        ),
        "topk_ties": _with("""
SELECT pickup_loc, dropoff_loc, count(*) AS trips FROM mapped GROUP BY 1, 2
ORDER BY trips DESC, pickup_loc NULLS LAST, dropoff_loc NULLS LAST LIMIT 5
"""),
        "union_widening": _with("""
SELECT * FROM mapped WHERE taxi_type = 'yellow'
UNION ALL BY NAME
SELECT * EXCLUDE (congestion_surcharge) REPLACE (CAST(VendorID AS INTEGER) AS VendorID, CAST(pickup_loc AS INTEGER) AS pickup_loc,
                                                 CAST(dropoff_loc AS INTEGER) AS dropoff_loc)
FROM mapped WHERE taxi_type = 'green'
""", TRIP_DOUBLES),
        "flag_trips_thresholds": _thresholds(40, 300, 10),
        "monthly_files": _with("""
SELECT * REPLACE (CASE WHEN year(pickup_time) % 2 = 1 THEN congestion_surcharge END AS congestion_surcharge) FROM mapped
""", TRIP_DOUBLES),
        "pruned_months": _with(f"""
SELECT * REPLACE (CASE WHEN year(pickup_time) % 2 = 1 THEN congestion_surcharge END AS congestion_surcharge),
       CAST(year(pickup_time) AS INTEGER) AS year, CAST(month(pickup_time) AS INTEGER) AS month
FROM mapped WHERE year(pickup_time) IN ({", ".join(str(Y - d.years_back) for d in S.donors)}) AND month(pickup_time) = {S.impute_month}
""", TRIP_DOUBLES),
        "incremental_periods": _with(_flagged_all("*, CAST(year(pickup_time) AS INTEGER) AS year, CAST(month(pickup_time) AS INTEGER) AS month"),
                                     TRIP_DOUBLES + ("duration_sec", "avg_speed_mph")),
        "audit_cube_merged": _with(_cube(), ("avg_surcharge", "avg_speed", "avg_tip")),
        "sql_function_leakage": _with("""
SELECT pickup_loc, count(*) AS trip_count, avg(CASE WHEN congestion_surcharge > 0 THEN 1 ELSE 0 END) AS compliance_rate,
       CAST(count(*) FILTER (WHERE congestion_surcharge = 0) AS BIGINT) AS missing_surcharge_hits
FROM clean WHERE pickup_loc NOT IN (236, 237, 238, 239, 262, 263) AND dropoff_loc IN (236, 237, 238, 239, 262, 263) AND pickup_time >= TIMESTAMP '2000-02-01'
GROUP BY 1 ORDER BY missing_surcharge_hits DESC, pickup_loc NULLS LAST LIMIT 10
""", ("compliance_rate",)),
        "lookup_default": _with("""
SELECT trip_key, pickup_loc, dropoff_loc, coalesce(s_name, 'unknown') AS s_name, coalesce(s_acctbal, 0.0) AS s_acctbal, coalesce(n_name, 'nowhere') AS n_name
FROM mapped LEFT JOIN supplier ON s_suppkey = pickup_loc LEFT JOIN nation ON n_nationkey = dropoff_loc
""", ("s_acctbal",)),
        "velocity_exact": _with(f"""
SELECT hour, dow, CAST(sum(CAST(s AS DECIMAL(38, 12))) AS DOUBLE) / nullif(count(s), 0) AS speed
FROM (SELECT hour(pickup_time) AS hour, dayname(pickup_time) AS dow,
             trip_distance / (NULLIF(epoch(dropoff_time) - epoch(pickup_time), 0) / 3600.0) AS s FROM clean WHERE {INSIDE} AND {Q1}) v
GROUP BY 1, 2
""", ("speed",)),
        "rain_exact": _with("""
SELECT corr(daily_trips, precip_mm) AS correlation, regr_slope(daily_trips, precip_mm) AS slope,
       regr_intercept(daily_trips, precip_mm) AS intercept, regr_r2(daily_trips, precip_mm) AS r2 FROM rain
""", ("correlation", "slope", "intercept", "r2")),
        "weather_json_quarantine": _with("""
SELECT CASE WHEN reason IS NULL THEN 'good' ELSE 'bad' END AS status, day, CASE WHEN reason IS NULL THEN precip_mm END AS precip_mm, reason
FROM (
  SELECT precip_mm, CASE WHEN day(date) = 7 THEN strftime(date, '%Y-99-%d') ELSE CAST(date AS VARCHAR) END AS day,
         CASE WHEN part = 4 AND date = max(date) OVER (PARTITION BY date_trunc('month', date), part) THEN 'no value for the day'
              WHEN day(date) = 7 THEN 'day is no date' WHEN day(date) = 3 THEN 'value is no number' END AS reason
  FROM (SELECT *, (day(date) - 1) // 5 AS part FROM weather) w WHERE part <> 5
  UNION ALL
  SELECT NULL, NULL, 'unreadable object' FROM (SELECT DISTINCT date_trunc('month', date) FROM weather WHERE (day(date) - 1) // 5 = 5) m
) q
""", ("precip_mm",)),
        "table_roundtrip": _with(f"""
SELECT * FROM (
  SELECT *,
    CASE WHEN avg_speed_mph > {MAX_SPEED_MPH} THEN '{FLAG_SPEED}'
         WHEN duration_sec < {MIN_DURATION_SEC} AND fare > {TELEPORT_MIN_FARE} THEN '{FLAG_TELEPORT}'
         WHEN trip_distance = 0 AND fare > 0 THEN '{FLAG_STATIONARY}' END AS forensic_flag
  FROM (SELECT *, epoch(dropoff_time) - epoch(pickup_time) AS duration_sec,
               trip_distance / (NULLIF(epoch(dropoff_time) - epoch(pickup_time), 0) / 3600.0) AS avg_speed_mph FROM mapped) c
) f WHERE forensic_flag IS NOT NULL
""", TRIP_DOUBLES + ("duration_sec", "avg_speed_mph")),
        "weather_json": _with("SELECT date, precip_mm FROM weather", ("precip_mm",)),
        "scalar_text": _with(f"""
SELECT (SELECT CASE WHEN isnan(c) OR c IS NULL THEN NULL ELSE printf('%.4f', c) END FROM (
          SELECT corr(daily_trips, precip_mm) AS c FROM rain WHERE daily_trips IS NOT NULL AND precip_mm IS NOT NULL) t) AS correlation,
       CASE WHEN v_before = 0 THEN NULL ELSE printf('%.1f%%', (v_after - v_before) / CAST(v_before AS DOUBLE) * 100.0) END AS pct_label,
       format('{{:,}}', v_before - v_after) || ' trips' AS delta_label
FROM (SELECT max(CASE WHEN period = '{S.baseline_label}' THEN volume END) AS v_before,
             max(CASE WHEN period = '{S.analysis_label}' THEN volume END) AS v_after FROM ({_VOLUMES}) v) w
"""),
    }
    # the published run and the file round trips give what the plain operators give
    same = {"audit_run_flag_stats": "flag_stats", "audit_run_leakage": "surcharge_leakage", "audit_run_tips": "tip_crowding",
            "audit_run_volumes": "period_volumes", "audit_run_border": "border_effect", "audit_run_velocity_after": "velocity_after",
            "audit_run_rain": "rain_elasticity", "sql_leakage": "surcharge_leakage", "csv_roundtrip": "velocity_after",
            "table_replaced": "table_roundtrip"}
    sql["published_reports"] = _published(sql)
    return sql | {name: sql[plain] for name, plain in same.items()}

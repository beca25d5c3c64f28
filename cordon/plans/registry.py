"""

Each query is ``(spark, sf_dir) -> DataFrame`` and reads whole tables: trips come from
all of ``lineitem`` through the mapping in :mod:`cordon.sources.tables`, weather from
all of ``events``.  Double columns are rounded to 6 digits at the end (report
precision), identically in :mod:`cordon.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cordon.functions.sample import exact_sample, hash_sample
from cordon.functions.exact import exact_avg, exact_corr, exact_ols
from cordon.functions.time import day_name, in_period, shift_years, speed_mph, ts_lit
from cordon.functions.zones import entering, inside, not_in_zone, touching, in_zone
from cordon.operators import (
    audit_log,
    border_effect,
    border_geo,
    clean_trips,
    flag_stats,
    flag_trips,
    impute_month,
    missing_periods,
    observed_periods,
    period_volumes,
    rain_daily,
    rain_elasticity,
    rain_trend,
    raw_to_trips,
    surcharge_leakage,
    suspicious_vendors,
    tip_crowding,
    unify_feeds,
    velocity_after,
    velocity_before,
    velocity_grid,
    volume_change_kpi,
    volume_change_text,
)
from cordon.operators.impute import donor_window
from cordon.operators.lookup import lookup_join
from cordon.plans.audit_run import baseline_trips, build_reports, materialise_flags
from cordon.plans.periods import merged_cube, publish_periods, read_trips
from cordon.plans.publish import publish_run, read_published
from cordon.plans.views import register_functions, register_leakage_view, register_views
from cordon.session import scratch_path
from cordon.sinks import write_report_csv, write_scalar, write_table
from cordon.sources.feeds import path_exists, read_feed, read_parquet, time_columns
from cordon.sources.files import read_report_csv, read_scalar, read_weather_checked, read_weather_json
from cordon.sources.partitioned import in_periods, land_periods, read_feed_table, table_to_trips
from cordon.sources.tables import (
    TRIP_KEY,
    events_weather,
    lineitem_feed,
    lineitem_feed_month,
    lineitem_feed_year,
    lineitem_trips,
    month_bounds,
)
from cordon.spec import AuditSpec, fixture_spec
from cordon.tablestore import open_table, replace_table

DIGITS = 6
QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        _REGISTRY[name] = fn
        return fn
    return deco


def registry() -> dict[str, QueryFn]:
    return dict(_REGISTRY)


def round_binary(c, digits: int = DIGITS):
    """``round(x * 10^d) / 10^d``: rounds the binary value (half away from zero).

    Spark's ``round(x, d)`` rounds the shortest decimal text of ``x`` instead, which
    differs on values such as 8.3101165 (stored as 8.31011649999...)."""
    scale = F.lit(float(10**digits))
    return F.round(c * scale) / scale


def finish(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every floating column to report precision (float sums are order-dependent
    in their last bits)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round_binary(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


class Inputs:
    """Lazily built DataFrames shared by the queries of one ``(spark, sf_dir)``."""

    def __init__(self, spark: SparkSession, sf_dir: str, spec: AuditSpec | None = None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.spec = spec or fixture_spec()

    def table(self, name: str) -> DataFrame:
        return read_parquet(self.spark, f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.table("lineitem")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    def feed_year(self, feed: str, year: int) -> DataFrame:
        return lineitem_feed_year(self.lineitem, feed, year)

    def feed_month(self, feed: str, year: int, month: int) -> DataFrame:
        return lineitem_feed_month(self.lineitem, feed, year, month)

    @cached_property
    def raw_feeds(self) -> dict[str, DataFrame]:
        return {f: self.feed_year(f, self.spec.analysis_year) for f in self.spec.feeds}

    @cached_property
    def trips(self) -> DataFrame:
        return unify_feeds(self.raw_feeds)

    @cached_property
    def flagged(self) -> DataFrame:
        return flag_trips(self.trips, self.spec)

    @cached_property
    def clean(self) -> DataFrame:
        return clean_trips(self.flagged)

    @cached_property
    def log(self) -> DataFrame:
        return audit_log(self.flagged)

    @cached_property
    def baseline_raw_by_feed(self) -> dict[str, DataFrame]:
        s = self.spec
        (y0, m0), (y1, m1) = s.baseline_periods[0], s.baseline_periods[-1]
        start = month_bounds(y0, m0)[0]
        end = month_bounds(y1, m1)[1]
        return {f: lineitem_feed(self.lineitem, f, start, end) for f in s.baseline_feed_list}

    @cached_property
    def baseline_raw(self) -> DataFrame:
        """The raw baseline of the (first) baseline feed."""
        return self.baseline_raw_by_feed[self.spec.baseline_feed_list[0]]

    @cached_property
    def baseline(self) -> DataFrame:
        return baseline_trips(self.baseline_raw_by_feed, self.spec)

    @cached_property
    def weather(self) -> DataFrame:
        return events_weather(self.events)

    @cached_property
    def rain(self) -> DataFrame:
        return rain_daily(self.clean, self.weather)

    def donors(self, feed: str) -> list:
        s = self.spec
        out = []
        for d in s.donors:
            start, end = donor_window(s.analysis_year, s.impute_month, d, s.align_weekdays)
            out.append((lineitem_feed(self.lineitem, feed, start, end), d))
        return out


# ---------------------------------------------------------------- composites C1-C19

@query("unify_feeds")
def q_unify_feeds(spark, sf_dir):
    return finish(Inputs(spark, sf_dir).trips)


@query("missing_periods")
def q_missing_periods(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    observed = observed_periods(lineitem_trips(i.lineitem))
    return missing_periods(observed, i.spec.feeds)


@query("impute_month")
def q_impute_month(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return finish(impute_month(i.donors("yellow"), "yellow", key_cols=[TRIP_KEY]))


@query("impute_month_green")
def q_impute_month_green(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return finish(impute_month(i.donors("green"), "green", key_cols=[TRIP_KEY]))


@query("flag_trips")
def q_flag_trips(spark, sf_dir):
    return finish(Inputs(spark, sf_dir).flagged)


@query("audit_log")
def q_audit_log(spark, sf_dir):
    return finish(Inputs(spark, sf_dir).log)


@query("clean_trips")
def q_clean_trips(spark, sf_dir):
    return finish(Inputs(spark, sf_dir).clean)


@query("flag_stats")
def q_flag_stats(spark, sf_dir):
    return flag_stats(Inputs(spark, sf_dir).flagged)


@query("surcharge_leakage")
def q_surcharge_leakage(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return finish(surcharge_leakage(i.clean, i.spec))


@query("period_volumes")
def q_period_volumes(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return period_volumes(i.baseline, i.clean, i.spec)


@query("suspicious_vendors")
def q_suspicious_vendors(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return suspicious_vendors(i.log, i.spec)


@query("border_effect")
def q_border_effect(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return finish(border_effect(i.baseline, i.clean, i.spec))


@query("velocity_before")
def q_velocity_before(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return finish(velocity_before(i.baseline, i.spec))


@query("velocity_after")
def q_velocity_after(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return finish(velocity_after(i.clean, i.spec))


@query("tip_crowding")
def q_tip_crowding(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return finish(tip_crowding(i.clean, i.spec))


@query("rain_daily")
def q_rain_daily(spark, sf_dir):
    return finish(Inputs(spark, sf_dir).rain)


@query("rain_elasticity")
def q_rain_elasticity(spark, sf_dir):
    return finish(rain_elasticity(Inputs(spark, sf_dir).rain))


@query("rain_trend")
def q_rain_trend(spark, sf_dir):
    return finish(rain_trend(Inputs(spark, sf_dir).rain))


@query("velocity_grid_before")
def q_velocity_grid_before(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return finish(velocity_grid(velocity_before(i.baseline, i.spec)))


@query("velocity_grid_after")
def q_velocity_grid_after(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return finish(velocity_grid(velocity_after(i.clean, i.spec)))


@query("border_geo")
def q_border_geo(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return finish(border_geo(border_effect(i.baseline, i.clean, i.spec), i.spec))


@query("volume_change_kpi")
def q_volume_change_kpi(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return finish(volume_change_kpi(period_volumes(i.baseline, i.clean, i.spec), i.spec))


# ------------------------------------------- options of SURVEY §2.12 (Q1, Q2, Q6, Q12)

@query("period_volumes_like_for_like")
def q_period_volumes_like_for_like(spark, sf_dir):
    """Q1 option: baseline = Q1 of the previous year, both feeds."""
    i = Inputs(spark, sf_dir, fixture_spec().like_for_like())
    return period_volumes(i.baseline, i.clean, i.spec)


@query("period_volumes_half_open")
def q_period_volumes_half_open(spark, sf_dir):
    """Q2 option: the analysis quarter as ``[start, end + 1 day)``."""
    i = Inputs(spark, sf_dir, fixture_spec().with_(half_open=True))
    return period_volumes(i.baseline, i.clean, i.spec)


@query("velocity_before_audited")
def q_velocity_before_audited(spark, sf_dir):
    """Q6 option: the baseline speeds after the same flag rule."""
    i = Inputs(spark, sf_dir, fixture_spec().with_(audit_baseline=True))
    return finish(velocity_before(i.baseline, i.spec))


@query("impute_month_weekday_aligned")
def q_impute_month_weekday_aligned(spark, sf_dir):
    """Q12 option: donors shifted by 364 days per year, so weekdays are kept."""
    i = Inputs(spark, sf_dir, fixture_spec().with_(align_weekdays=True))
    return finish(impute_month(i.donors("yellow"), "yellow", key_cols=[TRIP_KEY], align_weekdays=True))


# ------------------------------------------------------- primitives shown on their own

@query("sample_hash")
def q_sample_hash(spark, sf_dir):
    """Reproducible 30 % sample of every trip, keyed by the trip key."""
    i = Inputs(spark, sf_dir)
    trips = lineitem_trips(i.lineitem)
    return finish(hash_sample(trips, i.spec.donors[0].fraction, [TRIP_KEY]))


@query("sample_exact")
def q_sample_exact(spark, sf_dir):
    """Exactly 1,000 trips, those with the least hashes of their keys."""
    return finish(exact_sample(lineitem_trips(Inputs(spark, sf_dir).lineitem), 1000, [TRIP_KEY]))


@query("impute_month_exact")
def q_impute_month_exact(spark, sf_dir):
    """The rebuilt month from exactly 30 and 70 % of its donors' rows."""
    i = Inputs(spark, sf_dir)
    return finish(impute_month(i.donors("yellow"), "yellow", key_cols=[TRIP_KEY], exact=True))


@query("shift_year")
def q_shift_year(spark, sf_dir):
    """Every pickup moved 1 and 2 years forward (Feb 29 clamps to Feb 28)."""
    trips = lineitem_trips(Inputs(spark, sf_dir).lineitem)
    return trips.select(
        TRIP_KEY,
        "pickup_time",
        shift_years("pickup_time", 1).alias("pickup_plus_1y"),
        shift_years("dropoff_time", 2).alias("dropoff_plus_2y"),
    )


@query("project_exclude")
def q_project_exclude(spark, sf_dir):
    """``* EXCLUDE (pickup, dropoff)`` on every trip."""
    return finish(lineitem_trips(Inputs(spark, sf_dir).lineitem).drop("pickup_time", "dropoff_time"))


@query("zone_predicates")
def q_zone_predicates(spark, sf_dir):
    """F1-F9 as labelled counts over every trip, one pass and one tiny shuffle."""
    i = Inputs(spark, sf_dir)
    s = i.spec
    preds = {
        "pickup_in_zone": in_zone("pickup_loc", s.zone_ids),
        "pickup_not_in_zone": not_in_zone("pickup_loc", s.zone_ids),
        "entering": entering("pickup_loc", "dropoff_loc", s.zone_ids),
        "inside": inside("pickup_loc", "dropoff_loc", s.zone_ids),
        "touching": touching("pickup_loc", "dropoff_loc", s.zone_ids),
        "after_policy": F.col("pickup_time") >= ts_lit(s.policy_start),
        "in_q1": in_period("pickup_time", s.q1_start, s.q1_end),
        "in_q1_half_open": in_period("pickup_time", s.q1_start, s.q1_end, half_open=True),
        "surcharge_null": F.col("congestion_surcharge").isNull(),
        "fare_positive": F.col("fare") > 0,
    }
    counts = lineitem_trips(i.lineitem).agg(*[F.count_if(c).alias(name) for name, c in preds.items()])
    return counts.unpivot([], list(preds), "predicate", "n").select("predicate", F.col("n").cast("bigint").alias("n"))


@query("topk_ties")
def q_topk_ties(spark, sf_dir):
    """O1: top 5 (pickup, dropoff) pairs by trips, ties broken by the key."""
    trips = lineitem_trips(Inputs(spark, sf_dir).lineitem)
    pairs = trips.groupBy("pickup_loc", "dropoff_loc").agg(F.count(F.lit(1)).alias("trips"))
    return pairs.orderBy(F.desc("trips"), F.asc_nulls_last("pickup_loc"), F.asc_nulls_last("dropoff_loc")).limit(5)


def _older(trips: DataFrame) -> DataFrame:
    """Trips in an older file schema: narrower ids, no surcharge column."""
    return trips.withColumns({c: F.col(c).cast("int") for c in ("VendorID", "pickup_loc", "dropoff_loc")}).drop("congestion_surcharge")


@query("union_widening")
def q_union_widening(spark, sf_dir):
    """One feed in the current schema unioned by name with the other in an older one
    (narrower id types, no surcharge column); missing -> null, ints widened."""
    trips = lineitem_trips(Inputs(spark, sf_dir).lineitem)
    return finish(trips.filter("taxi_type = 'yellow'").unionByName(_older(trips.filter("taxi_type = 'green'")), allowMissingColumns=True))


@query("flag_trips_thresholds")
def q_flag_trips_thresholds(spark, sf_dir):
    """The flag rule with other limits."""
    spec = fixture_spec().with_(max_speed_mph=40, min_duration_sec=300, teleport_min_fare=10)
    i = Inputs(spark, sf_dir, spec)
    return finish(flag_trips(i.trips, spec))


# ------------------------------------------------------------- the published audit run

_RUNS: dict[tuple[str, str], dict[str, DataFrame]] = {}


def _published(spark, sf_dir) -> dict[str, DataFrame]:
    """Reports as ``run_audit`` makes them: table written, cubes written, reports from those; one run for an
    application and input folder, since each query shows one report of it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RUNS:
        i = Inputs(spark, sf_dir)
        _, counts, audited = materialise_flags(spark, i.trips, spec=i.spec)
        reports, scalars = build_reports(audited, i.baseline, i.weather, i.spec, flag_counts=counts)
        _RUNS[key] = reports | {name: df for name, (df, _) in scalars.items()}
    return _RUNS[key]


def _published_query(name: str, report: str):
    query(name)(lambda spark, sf_dir: finish(_published(spark, sf_dir)[report]))


for _name, _report in (("audit_run_flag_stats", "flag_stats"), ("audit_run_leakage", "leakage"), ("audit_run_tips", "tips"),
                       ("audit_run_volumes", "volumes"), ("audit_run_border", "border"), ("audit_run_velocity_after", "velocity_after"),
                       ("audit_run_rain", "rain_stats")):
    _published_query(_name, _report)


# --------------------------------------------------------------- files, views, scalars

MONTH_FOLDERS = "{root}/feed={feed}/year={year}/month={month}"


@query("monthly_files")
def q_monthly_files(spark, sf_dir):
    """Every trip written as monthly folders per feed, even years in an older schema, and all
    months read back as one feed each."""
    i, root = Inputs(spark, sf_dir), _landing(spark, sf_dir)
    years = lineitem_trips(i.lineitem).agg(F.min(F.year("pickup_time")).alias("lo"), F.max(F.year("pickup_time")).alias("hi")).first()
    if years["lo"] is None:
        return finish(lineitem_trips(i.lineitem))
    frames = [raw_to_trips(read_feed(spark, root, feed, range(years["lo"], years["hi"] + 1), template=MONTH_FOLDERS, complete_only=False),
                           feed, fill_surcharge=False, keep=[TRIP_KEY]) for feed in i.spec.feeds]
    return finish(frames[0].unionByName(frames[1]))


def _landed(lineitem: DataFrame) -> DataFrame:
    """Every trip as a raw row of the feed table: each feed's own time columns, the key, the month of its pickup."""
    trips = lineitem_trips(lineitem)
    times = [F.when(F.col("taxi_type") == f, F.col(c)).alias(n) for f in AuditSpec().feeds for c, n in zip(("pickup_time", "dropoff_time"), time_columns(f))]
    return trips.select("VendorID", *times, "trip_distance", F.col("pickup_loc").alias("PULocationID"), F.col("dropoff_loc").alias("DOLocationID"),
                        F.col("fare").alias("fare_amount"), "total_amount", "congestion_surcharge", TRIP_KEY,
                        F.col("taxi_type").alias("feed"), F.year("pickup_time").alias("year"), F.month("pickup_time").alias("month"))


#: landed and published tables of one application, by input folder: several queries read them
_KEPT: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[str], None]) -> str:
    """A folder that ``make`` fills once for an application and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _KEPT or not path_exists(spark, _KEPT[key]):
        path = scratch_path(spark, name)
        make(path)
        _KEPT[key] = path
    return _KEPT[key]


def _landing(spark: SparkSession, sf_dir: str) -> str:
    """All trips landed by period, even years in an older schema."""
    def make(path: str) -> None:
        raw = _landed(Inputs(spark, sf_dir).lineitem)
        land_periods(raw.filter("year % 2 = 1"), path)
        older = {c: F.col(c).cast("int") for c in ("VendorID", "PULocationID", "DOLocationID")}
        land_periods(raw.filter("year % 2 = 0").withColumns(older).drop("congestion_surcharge"), path)

    return _once(spark, sf_dir, "landing", make)


KEY_FIELD = [T.StructField(TRIP_KEY, T.StringType())]


@query("pruned_months")
def q_pruned_months(spark, sf_dir):
    """The months of a table of expected periods, read from the feed table by one scan that lists only their folders."""
    i = Inputs(spark, sf_dir)
    years = [i.spec.analysis_year - d.years_back for d in i.spec.donors]
    calendar = spark.range(1, 13).select(F.explode(F.array(*[F.lit(f) for f in i.spec.feeds])).alias("feed"), F.col("id").cast("int").alias("month")) \
        .select("feed", F.explode(F.array(*[F.lit(y) for y in years])).alias("year"), "month")
    path = write_table(calendar.repartition(1), scratch_path(spark, "expected"))
    wanted = spark.read.schema(calendar.schema).parquet(path).filter(F.col("month") == i.spec.impute_month)
    table = read_feed_table(spark, _landing(spark, sf_dir), i.spec.feeds, KEY_FIELD)
    return finish(table_to_trips(in_periods(table, wanted), i.spec.feeds, keep=[TRIP_KEY], fill_surcharge=False).drop("feed"))


def _published_in_steps(spark: SparkSession, sf_dir: str) -> str:
    """All trips published in two steps: the later years land after the first, and a month that had landed in part
    is written again."""
    def make(out: str) -> None:
        i, root = Inputs(spark, sf_dir), scratch_path(spark, "steps")
        raw = _landed(i.lineitem)
        year = i.spec.analysis_year - 1
        changed = (F.col("feed") == i.spec.feeds[0]) & (F.col("year") == year - 1) & (F.col("month") == 6)
        land_periods(raw.filter(f"year < {year}").filter(~changed | (F.xxhash64(TRIP_KEY) % 2 == 0)), root)
        publish_periods(spark, root, out, i.spec, KEY_FIELD)
        land_periods(raw.filter(changed | (F.col("year") >= year)), root)
        publish_periods(spark, root, out, i.spec, KEY_FIELD)

    return _once(spark, sf_dir, "published", make)


@query("incremental_periods")
def q_incremental_periods(spark, sf_dir):
    """Flagged trips by period, published in two steps of new and changed months only."""
    spec = fixture_spec()
    return finish(read_trips(spark, _published_in_steps(spark, sf_dir), spec, KEY_FIELD).drop("feed"))


@query("audit_cube_merged")
def q_audit_cube_merged(spark, sf_dir):
    """Every clean-trip report of the analysis year at its grain, merged from the states of its months."""
    spec = fixture_spec()
    cube = merged_cube(spark, _published_in_steps(spark, sf_dir), spec, spec.analysis_year)
    means = [(F.col(f"sum_{c}") / F.nullif(F.col(f"n_{c}"), F.lit(0))).alias(f"avg_{c}") for c in ("surcharge", "speed", "tip")]
    return finish(cube.select("grain", "k_long", "k_str", "k_date", "n", "n_pos", "n_zero", *means))


@query("sql_leakage")
def q_sql_leakage(spark, sf_dir):
    """The leakage report read with SQL from its view."""
    i = Inputs(spark, sf_dir)
    register_views(spark, i.raw_feeds, prefix="audit_views_", spec=i.spec)
    register_leakage_view(spark, i.spec, "audit_views_clean_trips", "audit_views_leakage")
    return finish(spark.sql("SELECT * FROM audit_views_leakage"))


@query("sql_function_leakage")
def q_sql_function_leakage(spark, sf_dir):
    """The leakage report as a SQL table function, with zones, start and length of the caller's own."""
    i = Inputs(spark, sf_dir)
    i.flagged.createOrReplaceTempView("audit_functions_trips")
    register_functions(spark, "audit_functions_trips", i.spec, prefix="audit_")
    return finish(spark.sql("SELECT * FROM audit_leakage(zones => array(236, 237, 238, 239, 262, 263), since => TIMESTAMP_NTZ '2000-02-01 00:00:00', top => 10)"))


@query("lookup_default")
def q_lookup_default(spark, sf_dir):
    """Names and balances from dimension tables, defaults where a trip's key is in none."""
    i = Inputs(spark, sf_dir)
    trips = lineitem_trips(i.lineitem).select(TRIP_KEY, "pickup_loc", "dropoff_loc")
    named = lookup_join(trips, i.table("supplier"), {"pickup_loc": "s_suppkey"}, {"s_name": "unknown", "s_acctbal": 0.0})
    return finish(lookup_join(named, i.table("nation"), {"dropoff_loc": "n_nationkey"}, {"n_name": "nowhere"}))


@query("velocity_exact")
def q_velocity_exact(spark, sf_dir):
    """A3: average speeds inside the zone from sums that do not depend on the order of the trips."""
    i = Inputs(spark, sf_dir)
    rows = i.clean.filter(inside("pickup_loc", "dropoff_loc", i.spec.zone_ids)).filter(in_period("pickup_time", i.spec.q1_start, i.spec.q1_end))
    return finish(rows.groupBy(F.hour("pickup_time").cast("bigint").alias("hour"), day_name("pickup_time").alias("dow"))
                  .agg(exact_avg(speed_mph("trip_distance", "pickup_time", "dropoff_time")).alias("speed")))


@query("rain_exact")
def q_rain_exact(spark, sf_dir):
    """Correlation and line from moments that do not depend on the order of the days."""
    return finish(Inputs(spark, sf_dir).rain.agg(exact_corr("daily_trips", "precip_mm").alias("correlation"), *exact_ols("daily_trips", "precip_mm")))


@query("weather_json_quarantine")
def q_weather_json_quarantine(spark, sf_dir):
    """Daily weather as an object for every five days, some of it broken on purpose, read into good days and a quarantine."""
    day = F.dayofmonth("date")
    part = F.floor((day - 1) / 5).cast("int")
    made = Inputs(spark, sf_dir).weather.select(F.trunc("date", "month").alias("first"), part.alias("part"), F.struct(
        "date", F.when(day == 7, F.date_format("date", "yyyy-99-dd")).otherwise(F.col("date").cast("string")).alias("t"),
        F.when(day == 3, F.lit("n/a")).otherwise(F.col("precip_mm").cast("string")).alias("v")).alias("d"))
    objects = made.groupBy("first", "part").agg(F.sort_array(F.collect_list("d")).alias("d"))  # at most five days each
    # the fifth part of a month lacks its last value, the sixth is cut in the middle
    values = F.when(F.col("part") == 4, F.slice("d.v", F.lit(1), F.size("d") - 1)).otherwise(F.col("d.v"))
    text = F.to_json(F.struct(F.struct(F.col("d.t").alias("time"), values.alias("precipitation_sum")).alias("daily")))
    path = scratch_path(spark, "weather-objects")
    objects.select(F.when(F.col("part") == 5, F.substring(text, 1, 20)).otherwise(text).alias("value")).write.text(path)
    good, bad = read_weather_checked(spark, path, line_per_object=True)
    return finish(good.select(F.lit("good").alias("status"), F.col("date").cast("string").alias("day"), "precip_mm", F.lit(None).cast("string").alias("reason"))
                  .unionByName(bad.select(F.lit("bad").alias("status"), "day", F.lit(None).cast("double").alias("precip_mm"), "reason")))


@query("table_roundtrip")
def q_table_roundtrip(spark, sf_dir):
    """A table of all flagged and clean trips, replaced by one of the flagged alone."""
    i = Inputs(spark, sf_dir)
    flagged = flag_trips(lineitem_trips(i.lineitem), i.spec)
    path = scratch_path(spark, "table")
    write_table(flagged, path, partition_by=["forensic_flag"])
    write_table(audit_log(flagged), path, partition_by=["forensic_flag"])
    return finish(spark.read.schema(flagged.schema).parquet(path))


@query("table_replaced")
def q_table_replaced(spark, sf_dir):
    """A table of all flagged trips, replaced as a whole by a selection read from itself."""
    i = Inputs(spark, sf_dir)
    flagged = flag_trips(lineitem_trips(i.lineitem), i.spec)
    path = replace_table(flagged, scratch_path(spark, "replaced"), partition_by=["forensic_flag"])
    replace_table(open_table(spark, path, flagged.schema).filter("forensic_flag IS NOT NULL"), path, sort_within=["pickup_time"])
    return finish(open_table(spark, path, flagged.schema))


@query("published_reports")
def q_published_reports(spark, sf_dir):
    """The reports of one published run, read through its manifest, in one long table."""
    def make(out: str) -> None:
        i = Inputs(spark, sf_dir)
        _, counts, audited = materialise_flags(spark, i.trips, spec=i.spec)
        reports, scalars = build_reports(audited, i.baseline, i.weather, i.spec, flag_counts=counts)
        publish_run(reports, out, scalars)

    found = read_published(spark, _once(spark, sf_dir, "exports", make))
    columns = {  # key, then up to three numbers
        "leakage": ("pickup_loc", "trip_count", "compliance_rate", "missing_surcharge_hits"), "volumes": ("period", "volume"),
        "vendors": ("concat_ws('/', VendorID, forensic_flag)", "ghost_count"), "border": ("loc_id", "count_24", "count_25", "change_rate"),
        "velocity_after": ("concat_ws('/', hour, dow)", "speed"), "tips": ("month", "avg_surcharge", "avg_tip_pct"), "rain_stats": ("'correlation'", "value"),
    }
    parts = []
    for name, (key, *values) in columns.items():
        cells = [f"CAST({c} AS DOUBLE) AS v{i + 1}" for i, c in enumerate([*values, *["NULL"] * (3 - len(values))])]
        parts.append(found[name].selectExpr(f"'{name}' AS report", f"CAST({key} AS STRING) AS key", *cells))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return finish(out)


@query("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    """The speed report as CSV and back."""
    i = Inputs(spark, sf_dir)
    report = velocity_after(i.clean, i.spec)
    path = write_report_csv(report, scratch_path(spark, "speeds.csv"))
    return finish(read_report_csv(spark, path, report.schema))


@query("scalar_text")
def q_scalar_text(spark, sf_dir):
    """The correlation as written text, read back, beside the KPI's display texts."""
    i = Inputs(spark, sf_dir)
    text = read_scalar(spark, write_scalar(rain_elasticity(i.rain), "correlation", scratch_path(spark, "rain_stats.txt")))
    kpi = volume_change_text(volume_change_kpi(period_volumes(i.baseline, i.clean, i.spec), i.spec))
    return kpi.select(F.lit(text).cast("string").alias("correlation"), "pct_label", "delta_label")


@query("weather_json")
def q_weather_json(spark, sf_dir):
    """Daily weather written as one JSON object of parallel arrays (a value per day) and read back."""
    days = Inputs(spark, sf_dir).weather.agg(F.sort_array(F.collect_list(F.struct("date", "precip_mm"))).alias("d"))
    path = scratch_path(spark, "weather.json")
    daily = F.struct(F.transform("d.date", lambda x: x.cast("string")).alias("time"), F.col("d.precip_mm").alias("precipitation_sum"))
    days.select(F.to_json(F.struct(daily.alias("daily"))).alias("value")).write.text(path)
    return finish(read_weather_json(spark, path))

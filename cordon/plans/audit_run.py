"""End-to-end audit: unify -> flag -> write once -> two report cubes -> reports -> files.

The flagged table is written once under the cluster's shared folder.  One pass over its clean
trips and one over the baseline give two cubes of a few thousand rows, which are written as well;
every report but the vendors' is a projection of those.  A written table survives the loss of any
executor, unlike cached blocks, and cuts the lineage of every report to one scan.
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cordon.functions.time import ts_lit
from cordon.operators import (
    audit_log,
    border_geo,
    clean_trips,
    flag_stats,
    flag_trips,
    impute_month,
    rain_elasticity,
    rain_trend,
    raw_to_trips,
    suspicious_vendors,
    unify_feeds,
    velocity_grid,
    volume_change_kpi,
    volume_change_text,
)
from cordon.operators.impute import donor_window
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
from cordon.plans.publish import export_run, publish_run
from cordon.session import scratch_path
from cordon.sinks import publish_reports, write_table
from cordon.sources.feeds import (
    DEFAULT_TEMPLATE,
    feed_path,
    is_complete,
    path_exists,
    read_feed_months,
    time_columns,
    write_month,
)
from cordon.spec import FLAG_SPEED, FLAG_STATIONARY, FLAG_TELEPORT, AuditSpec
from cordon.tablestore import open_table, replace_table


FLAGS = (FLAG_SPEED, FLAG_TELEPORT, FLAG_STATIONARY)

# fixed values: the report names that existing dashboards read
EXPORT_NAMES = {
    "leakage": "leakage_report", "volumes": "q1_decline", "vendors": "suspicious_vendors", "border": "border_effect",
    "velocity_before": "velocity_24", "velocity_after": "velocity_25", "tips": "tip_crowding", "rain_daily": "rain_data",
    "rain_stats": "rain_stats",
}


@dataclass
class AuditResult:
    table_path: str
    flag_counts: dict
    reports: dict[str, DataFrame]
    written: dict[str, str]


def materialise_flags(spark: SparkSession, trips: DataFrame, path: str | None = None,
                      layout: str = "sorted", spec: AuditSpec = AuditSpec()) -> tuple[str, dict, DataFrame]:
    """Flag and write the trips once, in place of what ``path`` held before; flag counts are observed
    during the write.

    ``layout="sorted"`` writes one file per task, rows ordered by flag then pickup time, and
    readers skip row groups by null counts and min/max statistics.  ``layout="by_flag"``
    partitions the table by flag (readers prune directories; each task writes up to four files).
    """
    if layout not in ("by_flag", "sorted"):
        raise ValueError(f"unknown layout {layout!r}")
    flagged = flag_trips(trips, spec)
    obs = Observation("flags")
    observed = flagged.observe(
        obs,
        F.count(F.lit(1)).alias("trips"),
        *[F.count_if(F.col("forensic_flag") == F.lit(name)).alias(name) for name in FLAGS],
    )
    path = path or scratch_path(spark, "audit_results")
    # sorting by the flag first satisfies the partitioned writer's required ordering, so
    # it adds no second sort and every file stays ordered by pickup time
    # what the path held before stays whole until the new table is
    replace_table(observed, path, partition_by=["forensic_flag"] if layout == "by_flag" else (),
                  sort_within=["forensic_flag", "pickup_time"])
    table = open_table(spark, path, flagged.schema)
    return path, dict(obs.get), table


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a small table to the shared folder and read it back."""
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def build_reports(audited: DataFrame, baseline: DataFrame, weather: DataFrame | None,
                  spec: AuditSpec, work_path: str | None = None, flag_counts: dict | None = None
                  ) -> tuple[dict[str, DataFrame], dict[str, tuple[DataFrame, str]]]:
    """All reports.  The clean trips, the baseline and the weather are read once each, into
    cubes under the shared folder (``work_path``); the vendor report reads the flagged rows.
    ``flag_counts``, as observed while the table was written, saves another pass."""
    spark = audited.sparkSession
    work = (work_path or scratch_path(spark, "reports")).rstrip("/")
    after = stored(clean_report_cube(clean_trips(audited), spec), f"{work}/clean_cube")
    before = stored(baseline_report_cube(baseline, spec), f"{work}/baseline_cube")
    if flag_counts is None:
        stats = flag_stats(audited)
    else:
        stats = spark.createDataFrame([(k, int(flag_counts[k])) for k in FLAGS if flag_counts.get(k)],
                                      "forensic_flag string, n bigint")
    reports = {
        "flag_stats": stats,
        "leakage": leakage_from(after, spec),
        "volumes": volume_from(before, spec.baseline_label).unionByName(volume_from(after, spec.analysis_label)),
        "vendors": suspicious_vendors(audit_log(audited), spec),
        "border": border_change(border_from(before, "count_24"), border_from(after, "count_25")),
        "velocity_before": speed_from(before),
        "velocity_after": speed_from(after),
        "tips": tips_from(after),
    }
    # what the dashboard derives, from the same small tables
    reports["velocity_grid_before"] = velocity_grid(reports["velocity_before"])
    reports["velocity_grid_after"] = velocity_grid(reports["velocity_after"])
    reports["border_geo"] = border_geo(reports["border"], spec)
    reports["volume_kpi"] = volume_change_text(volume_change_kpi(reports["volumes"], spec))
    scalars = {}
    if weather is not None:
        rain = stored(daily_from(after).join(weather.select("date", "precip_mm"), "date", "inner")
                      .select("date", "daily_trips", "precip_mm"), f"{work}/rain")
        reports["rain_daily"] = rain
        reports["rain_trend"] = rain_trend(rain)
        scalars["rain_stats"] = (rain_elasticity(rain), "correlation")
    return reports, scalars


def baseline_trips(baseline_raw: DataFrame | dict[str, DataFrame], spec: AuditSpec) -> DataFrame:
    """Baseline raw file(s) in the Trip schema; audited too when ``spec.audit_baseline``."""
    if not isinstance(baseline_raw, dict):
        baseline_raw = {spec.baseline_feed_list[0]: baseline_raw}
    frames = [raw_to_trips(df, feed, fill_surcharge=False) for feed, df in baseline_raw.items()]
    trips = frames[0]
    for f in frames[1:]:
        trips = trips.unionByName(f)
    if spec.audit_baseline:
        return clean_trips(flag_trips(trips, spec))
    return trips


def run_audit(spark: SparkSession, raw_feeds: dict[str, DataFrame],
              baseline_raw: DataFrame | dict[str, DataFrame],
              weather: DataFrame | None, spec: AuditSpec, out_dir: str,
              table_path: str | None = None, keep: tuple[str, ...] = (),
              layout: str = "sorted", names: Mapping[str, str] | None = None, runs: bool = False) -> AuditResult:
    """``baseline_raw``: one raw frame of the baseline feed, or one per baseline feed;
    ``keep``: extra raw columns carried into the audit table (e.g. ``imputed``);
    ``names``: other file names for reports (e.g. :data:`EXPORT_NAMES`); ``runs`` publishes in two phases
    (:mod:`cordon.plans.publish`) and then exports the run as single files."""
    trips = unify_feeds(raw_feeds, keep=keep)
    path, counts, audited = materialise_flags(spark, trips, table_path, layout, spec)
    baseline = baseline_trips(baseline_raw, spec)
    reports, scalars = build_reports(audited, baseline, weather, spec, flag_counts=counts)
    if runs:
        publish_run(reports, out_dir, scalars)
        written = export_run(spark, out_dir, out_dir, names)
    else:
        written = publish_reports(reports, out_dir, scalars, names=names)
    return AuditResult(path, counts, reports, written)


def feeds_with_imputation(spark: SparkSession, root: str, spec: AuditSpec,
                          template: str = DEFAULT_TEMPLATE, write_imputed: bool = False,
                          mark_imputed: bool = False) -> dict[str, DataFrame]:
    """Every feed of the analysis year from its monthly files.  A month of ``spec.impute_only``
    that is absent is rebuilt from the donor years; other gaps stay gaps.  A missing donor
    raises, and so does a feed without any month.  Donor files are sampled as a whole; with
    ``align_weekdays`` from the days that land in the month.

    Presence is a file-system check, so no data is scanned for it.  A folder without its
    writer's ``_SUCCESS`` mark is not a month: it is rebuilt like an absent one if it may be,
    and otherwise raises.

    With ``write_imputed`` the rebuilt month is written as that month's file under
    ``root`` (S7) and read back, so a later run finds it present and skips the work (S4).
    With ``mark_imputed`` every row gets a boolean ``imputed`` column.
    """
    y = spec.analysis_year
    feeds = {}
    for feed in spec.feeds:
        paths = {m: feed_path(root, feed, y, m, template) for m in range(1, 13)}
        present = [m for m, p in paths.items() if is_complete(spark, p)]
        absent = [m for m in paths if m not in present and (spec.impute_only is None or m in spec.impute_only)]
        for m in set(paths) - set(present) - set(absent):
            if path_exists(spark, paths[m]):
                raise ValueError(f"{paths[m]} has no _SUCCESS mark: its writer did not finish")
        if not present and spec.impute_only is not None:
            raise FileNotFoundError(f"no monthly file of feed {feed!r} for {y} under {root}")
        frame = read_feed_months(spark, root, feed, [(y, m) for m in present], template) if present else None
        if frame is not None and mark_imputed:
            # months written by an earlier run carry the mark, the others have none
            known = next((c for c in frame.columns if c.lower() == "imputed"), None)
            mark = F.coalesce(F.col(known), F.lit(False)) if known else F.lit(False)
            frame = frame.withColumn("imputed", mark)
        for m in absent:
            donors = []
            for d in spec.donors:
                start, end = donor_window(y, m, d, spec.align_weekdays)
                months = _months_between(start, end)
                for yy, mm in months:
                    donor_path = feed_path(root, feed, yy, mm, template)
                    if not path_exists(spark, donor_path):
                        raise FileNotFoundError(f"donor {donor_path} for imputing {feed} {y}-{m:02d} is missing")
                    if not is_complete(spark, donor_path):
                        raise ValueError(f"donor {donor_path} has no _SUCCESS mark: its writer did not finish")
                frame_d = read_feed_months(spark, root, feed, months, template)
                if spec.align_weekdays:  # the window reaches into neighbouring months' files
                    pickup = F.col(time_columns(feed)[0])
                    frame_d = frame_d.filter((pickup >= ts_lit(start)) & (pickup < ts_lit(end)))
                donors.append((frame_d, d))
            imputed = impute_month(donors, feed, align_weekdays=spec.align_weekdays,
                                   mark_column="imputed" if mark_imputed else None)
            if write_imputed:
                write_month(imputed, paths[m])
                imputed = read_feed_months(spark, root, feed, [(y, m)], template)
            frame = imputed if frame is None else frame.unionByName(imputed, allowMissingColumns=True)
        feeds[feed] = frame
    return feeds


def read_baseline(spark: SparkSession, root: str, spec: AuditSpec, template: str = DEFAULT_TEMPLATE) -> dict[str, DataFrame]:
    """The baseline months of each baseline feed; one that is missing or half written raises with its path."""
    for feed in spec.baseline_feed_list:
        for y, m in spec.baseline_periods:
            path = feed_path(root, feed, y, m, template)
            if not path_exists(spark, path):
                raise FileNotFoundError(f"baseline month {path} is missing")
            if not is_complete(spark, path):
                raise ValueError(f"baseline month {path} has no _SUCCESS mark: its writer did not finish")
    return {f: read_feed_months(spark, root, f, spec.baseline_periods, template) for f in spec.baseline_feed_list}


def _months_between(start: str, end: str) -> list[tuple[int, int]]:
    """Calendar months overlapping ``[start, end)``."""
    y, m = int(start[:4]), int(start[5:7])
    ey, em = int(end[:4]), int(end[5:7])
    last = (ey, em) if end[8:10] != "01" else ((ey, em - 1) if em > 1 else (ey - 1, 12))
    out = []
    while (y, m) <= last:
        out.append((y, m))
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def main(argv=None) -> None:
    from cordon.plans.registry import Inputs
    from cordon.session import apply_cluster_conf, local_session
    from cordon.sources.files import read_weather_checked

    ap = argparse.ArgumentParser(description="run the audit and publish its reports")
    ap.add_argument("--out", required=True, help="report folder (any Hadoop file system)")
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01", help="test tables (when --root is not given)")
    ap.add_argument("--root", help="folder of monthly files {feed}_tripdata_{year}-{month:02d}.parquet")
    ap.add_argument("--weather-json", help="daily weather JSON of parallel arrays")
    ap.add_argument("--weather-optional", action="store_true", help="go on without the rain reports if the weather file is missing")
    ap.add_argument("--runs", action="store_true", help="publish as one run with a manifest, then export single files under fixed names")
    ap.add_argument("--year", type=int, help="analysis year (with --root)")
    ap.add_argument("--policy-start", help="policy start date, YYYY-MM-DD (with --root)")
    ap.add_argument("--like-for-like", action="store_true", help="baseline = same quarter and feeds")
    ap.add_argument("--align-weekdays", action="store_true", help="impute with 364-day shifts")
    ap.add_argument("--write-imputed", action="store_true", help="write rebuilt months back under --root")
    ap.add_argument("--impute-only", type=lambda v: None if v == "any" else tuple(int(m) for m in v.split(",")), default=(12,),
                    help="months that may be rebuilt, e.g. 11,12, or 'any' (default 12)")
    ap.add_argument("--mark-imputed", action="store_true", help="carry a boolean column 'imputed' into the audit table")
    ap.add_argument("--layout", choices=("by_flag", "sorted"), default="sorted", help="audit table layout")
    ap.add_argument("--export-names", action="store_true", help="name the reports as existing dashboards expect them")
    ap.add_argument("--local", action="store_true", help="run on this machine, whatever master was submitted")
    args = ap.parse_args(argv)
    # the submitted master and settings hold unless --local asks for this machine
    spark = local_session() if args.local else SparkSession.builder.appName("cordon-audit").getOrCreate()
    apply_cluster_conf(spark)
    if args.root:
        spec = AuditSpec()
        if args.year:
            y = args.year
            spec = spec.with_(analysis_year=y, q1_start=f"{y}-01-01", q1_end=f"{y}-03-31",
                              policy_start=f"{y}-01-05", baseline_year=y - 1)
        if args.policy_start:
            spec = spec.with_(policy_start=args.policy_start)
        if args.like_for_like:
            spec = spec.like_for_like()
        if args.align_weekdays:
            spec = spec.with_(align_weekdays=True)
        spec = spec.with_(impute_only=args.impute_only)
        feeds = feeds_with_imputation(spark, args.root, spec, write_imputed=args.write_imputed, mark_imputed=args.mark_imputed)
        baseline = read_baseline(spark, args.root, spec)
        weather = None
        if args.weather_json and (path_exists(spark, args.weather_json) or not args.weather_optional):
            weather, bad = read_weather_checked(spark, args.weather_json)
            write_table(bad, f"{args.out.rstrip('/')}/quarantine/weather")
    else:
        i = Inputs(spark, args.sf_dir)
        spec, feeds, baseline, weather = i.spec, i.raw_feeds, i.baseline_raw, i.weather
    res = run_audit(spark, feeds, baseline, weather, spec, args.out, layout=args.layout,
                    keep=("imputed",) if args.root and args.mark_imputed else (), names=EXPORT_NAMES if args.export_names else None, runs=args.runs)
    print({"table": res.table_path, "flags": res.flag_counts, "written": sorted(res.written)})


if __name__ == "__main__":
    main()

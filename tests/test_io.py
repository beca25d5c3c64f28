"""Sources and sinks: monthly files by path template, schema drift, imputation of an
absent month, end-to-end audit run, report CSVs, scalar text, weather JSON."""

import json
import os

import pytest
from pyspark.sql import functions as F

from cordon.plans.audit_run import feeds_with_imputation, run_audit
from cordon.plans.registry import Inputs
from cordon.sinks import write_report_csv, write_scalar, write_table
from cordon.sources import read_feed, read_report_csv, read_scalar, read_weather_json
from cordon.sources.feeds import feed_path, raw_schema
from cordon.spec import Donor, fixture_spec

from conftest import SF_SMALL


def land_months(spark, root, feed, periods, drop_surcharge=()):
    """Write monthly raw files derived from lineitem (what a feed would deliver)."""
    i = Inputs(spark, SF_SMALL)
    for y, m in periods:
        df = i.feed_month(feed, y, m)
        if (y, m) in drop_surcharge:  # an older file: no surcharge column, int ids
            df = df.drop("congestion_surcharge").withColumn("VendorID", F.col("VendorID").cast("int"))
        df.coalesce(1).write.mode("overwrite").parquet(feed_path(root, feed, y, m))


def test_read_feed_conforms_drifting_months(spark, scratch):
    land_months(spark, scratch, "yellow", [(2000, 1), (2000, 2)], drop_surcharge=[(2000, 1)])
    df = read_feed(spark, scratch, "yellow", 2000)  # months 3..12 absent: skipped like a glob
    assert [f.name for f in df.schema.fields][:9] == [f.name for f in raw_schema("yellow").fields]
    assert dict(df.dtypes)["VendorID"] == "bigint"
    jan = df.filter(F.month("tpep_pickup_datetime") == 1)
    assert jan.count() > 0 and jan.filter(F.col("congestion_surcharge").isNotNull()).count() == 0
    want = Inputs(spark, SF_SMALL).feed_month("yellow", 2000, 1).count() + \
        Inputs(spark, SF_SMALL).feed_month("yellow", 2000, 2).count()
    assert df.count() == want


def test_absent_month_is_imputed_and_missing_donor_raises(spark, scratch):
    spec = fixture_spec()
    months = [(2000, m) for m in range(1, 12)]
    for feed in spec.feeds:
        land_months(spark, scratch, feed, months + [(1998, 12), (1999, 12)])
    feeds = feeds_with_imputation(spark, scratch, spec)
    y = feeds["yellow"]
    dec = y.filter(F.month("tpep_pickup_datetime") == 12)
    want = Inputs(spark, SF_SMALL)
    assert dec.count() > 0
    assert dec.filter(F.year("tpep_pickup_datetime") != 2000).count() == 0
    # every imputed row comes from a donor row
    donors = want.feed_month("yellow", 1998, 12).unionByName(want.feed_month("yellow", 1999, 12))
    assert dec.join(donors, "trip_key", "left_anti").count() == 0
    # written back as the month's file: a second run reads it instead of imputing again
    first = feeds_with_imputation(spark, scratch, spec, write_imputed=True)["yellow"]
    n_dec = first.filter(F.month("tpep_pickup_datetime") == 12).count()
    assert n_dec == dec.count()
    assert os.path.exists(feed_path(scratch, "yellow", 2000, 12))
    again = feeds_with_imputation(spark, scratch, spec)["yellow"]  # would raise if it re-imputed into an existing file
    assert again.filter(F.month("tpep_pickup_datetime") == 12).count() == n_dec
    # a missing donor is an error
    other = scratch + "-nodonor"
    land_months(spark, other, "yellow", months)
    with pytest.raises(FileNotFoundError):
        feeds_with_imputation(spark, other, spec.with_(feeds=("yellow",)))


def test_run_audit_publishes_reports(spark, scratch):
    i = Inputs(spark, SF_SMALL)
    out = os.path.join(scratch, "exports")
    res = run_audit(spark, i.raw_feeds, i.baseline_raw, i.weather, i.spec, out)
    assert res.flag_counts == {"trips": 907, "Impossible Physics": 87, "Teleporter": 1, "Stationary Ride": 22}
    assert res.table_path.startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))
    leak = read_report_csv(spark, f"{out}/leakage.csv",
                           "pickup_loc long, trip_count long, compliance_rate double, missing_surcharge_hits long")
    assert sorted(r.pickup_loc for r in leak.collect()) == [10, 26, 27]
    assert read_scalar(spark, f"{out}/rain_stats.txt") == "-0.0187"
    kpi = read_report_csv(spark, f"{out}/volume_kpi.csv", "v_before long, v_after long, pct_change double, delta long, pct_label string, delta_label string").first()
    assert (kpi.v_before, kpi.v_after, kpi.pct_label, kpi.delta_label) == (15, 58, "286.7%", "-43 trips")
    assert read_report_csv(spark, f"{out}/never_written.csv", "a int") is None
    # the written table is partitioned by flag and reads back whole
    table = spark.read.parquet(res.table_path)
    assert table.count() == 907 and table.filter(F.col("forensic_flag").isNull()).count() == 797


def test_scalar_and_csv_roundtrip(spark, scratch):
    df = spark.createDataFrame([(0.123456,)], "c double")
    write_scalar(df, "c", f"{scratch}/s.txt")
    assert read_scalar(spark, f"{scratch}/s.txt") == "0.1235"
    write_scalar(spark.createDataFrame([(None,)], "c double"), "c", f"{scratch}/n.txt")
    assert read_scalar(spark, f"{scratch}/n.txt") is None
    rep = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    write_report_csv(rep, f"{scratch}/r.csv")
    back = read_report_csv(spark, f"{scratch}/r.csv", "k string, v long")
    assert sorted(map(tuple, back.collect())) == [("a", 1), ("b", 2)]


def test_partition_overwrite_is_dynamic(spark, scratch):
    path = f"{scratch}/t"
    a = spark.createDataFrame([(1, "x"), (2, "y")], "v int, p string")
    write_table(a, path, partition_by=["p"])
    write_table(spark.createDataFrame([(3, "y")], "v int, p string"), path, partition_by=["p"], replace_partitions=True)
    got = sorted(map(tuple, spark.read.parquet(path).select("v", "p").collect()))
    assert got == [(1, "x"), (3, "y")]
    write_table(spark.createDataFrame([(4, "y")], "v int, p string"), path, partition_by=["p"])  # the whole table
    assert [tuple(r) for r in spark.read.parquet(path).select("v", "p").collect()] == [(4, "y")]


def test_weather_json_parallel_arrays(spark, scratch):
    path = os.path.join(scratch, "weather.json")
    with open(path, "w") as fh:
        json.dump({"latitude": 40.78, "daily": {"time": ["2025-01-01", "2025-01-02", "2025-01-03"],
                                                 "precipitation_sum": [0.0, None, 4.2]}}, fh)
    rows = sorted(read_weather_json(spark, path).collect())
    assert [(r.date.isoformat(), r.precip_mm) for r in rows] == [
        ("2025-01-01", 0.0), ("2025-01-02", None), ("2025-01-03", 4.2)]


def test_dashboard_reads_published_reports(spark, scratch):
    from cordon.plans.dashboard import dashboard_tables

    i = Inputs(spark, SF_SMALL)
    out = os.path.join(scratch, "exports")
    run_audit(spark, i.raw_feeds, i.baseline_raw, i.weather, i.spec, out)
    d = dashboard_tables(spark, out, i.spec)
    assert d["rain_stats"] == "-0.0187"
    kpi = d["volume_kpi"].first()
    assert (kpi.v_before, kpi.v_after) == (15, 58)
    (tr,) = d["rain_trend"].collect()
    assert abs(tr.slope - (-0.000048)) < 1e-6 and abs(tr.intercept - 2.4369) < 1e-4
    assert d["grid_after"].count() > 0 and d["border_map"].count() == 0
    empty = dashboard_tables(spark, os.path.join(scratch, "nothing"), i.spec)
    assert empty["volume_kpi"] is None and empty["rain_stats"] is None


def test_cli_runs_on_monthly_files(spark, scratch):
    from cordon.plans.audit_run import main

    spec = fixture_spec()
    for feed in spec.feeds:
        land_months(spark, scratch, feed, [(2000, m) for m in range(1, 12)] + [(1998, 12), (1999, 12), (1999, 1)])
    out = os.path.join(scratch, "exports")
    main(["--root", scratch, "--year", "2000", "--out", out, "--write-imputed", "--layout", "sorted"])
    assert os.path.exists(feed_path(scratch, "green", 2000, 12))
    vols = read_report_csv(spark, f"{out}/volumes.csv", "period string, volume long").collect()
    assert {r.period: r.volume for r in vols}["1999_Q1"] == 15


def test_schema_cache_follows_file_changes(spark, scratch):
    import shutil

    from cordon.sources.feeds import read_parquet

    spark.createDataFrame([(1, "a")], "x long, y string").coalesce(1).write.parquet(f"{scratch}/d")
    part = [f for f in os.listdir(f"{scratch}/d") if f.endswith(".parquet")][0]
    single = f"{scratch}/one.parquet"
    shutil.copy(f"{scratch}/d/{part}", single)
    assert read_parquet(spark, single).columns == ["x", "y"]
    assert read_parquet(spark, single).collect()[0].x == 1  # cached schema
    spark.createDataFrame([(2.5,)], "z double").coalesce(1).write.parquet(f"{scratch}/e")
    part = [f for f in os.listdir(f"{scratch}/e") if f.endswith(".parquet")][0]
    shutil.copy(f"{scratch}/e/{part}", single)
    os.utime(single, (1, 1))
    assert read_parquet(spark, single).columns == ["z"]


def test_imputed_rows_are_traceable(spark, scratch):
    spec = fixture_spec()
    for feed in spec.feeds:
        land_months(spark, scratch, feed, [(2000, m) for m in range(1, 12)] + [(1998, 12), (1999, 12)])
    feeds = feeds_with_imputation(spark, scratch, spec, mark_imputed=True)
    i = Inputs(spark, SF_SMALL)
    res = run_audit(spark, feeds, i.baseline_raw, None, spec, os.path.join(scratch, "out"), keep=("imputed",))
    table = spark.read.parquet(res.table_path)
    marked = table.filter("imputed")
    assert marked.count() > 0
    assert marked.filter(F.month("pickup_time") != 12).count() == 0
    assert table.filter(~F.col("imputed") & (F.month("pickup_time") == 12)).count() == 0
    assert table.filter(F.col("imputed").isNull()).count() == 0


def test_impute_only_december_skips_other_gaps(spark, scratch):
    spec = fixture_spec().with_(feeds=("yellow",), impute_only=(12,))
    land_months(spark, scratch, "yellow", [(2000, m) for m in range(1, 12) if m != 6] + [(1998, 12), (1999, 12)])
    y = feeds_with_imputation(spark, scratch, spec)["yellow"]
    months = {r[0] for r in y.select(F.month("tpep_pickup_datetime")).distinct().collect()}
    assert 12 in months and 6 not in months


def test_a_second_run_replaces_the_first_ones_rows(spark, scratch):
    i = Inputs(spark, SF_SMALL)
    path = f"{scratch}/audit"
    for layout in ("by_flag", "sorted"):
        run_audit(spark, i.raw_feeds, i.baseline_raw, None, i.spec, f"{scratch}/out", table_path=path, layout=layout)
        few = {f: df.filter("trip_distance > 0 AND fare_amount < 15") for f, df in i.raw_feeds.items()}
        res = run_audit(spark, few, i.baseline_raw, None, i.spec, f"{scratch}/out", table_path=path, layout=layout)
        table = spark.read.parquet(path)
        assert table.count() == res.flag_counts["trips"]
        assert table.filter("forensic_flag = 'Teleporter'").count() == res.flag_counts["Teleporter"] == 0


def test_the_imputed_mark_outlives_a_second_run(spark, scratch):
    spec = fixture_spec().with_(feeds=("yellow",))
    land_months(spark, scratch, "yellow", [(2000, m) for m in range(1, 12)] + [(1998, 12), (1999, 12)])
    first = feeds_with_imputation(spark, scratch, spec, write_imputed=True, mark_imputed=True)["yellow"]
    counts = lambda df: {r.imputed: r["count"] for r in df.groupBy("imputed").count().collect()}
    want = counts(first)
    assert set(want) == {True, False}
    assert counts(feeds_with_imputation(spark, scratch, spec, write_imputed=True, mark_imputed=True)["yellow"]) == want


def test_a_half_written_month_is_rebuilt(spark, scratch):
    spec = fixture_spec().with_(feeds=("yellow",))
    land_months(spark, scratch, "yellow", [(2000, m) for m in range(1, 12)] + [(1998, 12), (1999, 12)])
    whole = feeds_with_imputation(spark, scratch, spec, write_imputed=True)["yellow"].count()
    december = feed_path(scratch, "yellow", 2000, 12)
    os.remove(f"{december}/_SUCCESS")
    part = next(f for f in os.listdir(december) if f.startswith("part-"))
    os.remove(f"{december}/{part}")
    assert feeds_with_imputation(spark, scratch, spec, write_imputed=True)["yellow"].count() == whole
    assert os.path.exists(f"{december}/_SUCCESS")
    os.remove(f"{feed_path(scratch, 'yellow', 2000, 3)}/_SUCCESS")
    with pytest.raises(ValueError, match="2000-03"):
        feeds_with_imputation(spark, scratch, spec)


def test_nine_landed_months_can_be_audited(spark, scratch):
    spec = fixture_spec().with_(feeds=("yellow",))
    land_months(spark, scratch, "yellow", [(2000, m) for m in range(1, 10)] + [(1998, 12), (1999, 12)])
    y = feeds_with_imputation(spark, scratch, spec)["yellow"]
    assert {r[0] for r in y.select(F.month("tpep_pickup_datetime")).distinct().collect()} <= {*range(1, 10), 12}
    only = feeds_with_imputation(spark, scratch, spec.with_(impute_only=()))["yellow"]
    assert only.filter(F.month("tpep_pickup_datetime") == 12).count() == 0
    with pytest.raises(FileNotFoundError, match="green"):
        feeds_with_imputation(spark, scratch, spec.with_(feeds=("green",)))


def test_donor_files_are_sampled_whole(spark, scratch):
    """Stray pickups in a donor file belong to the file, as they do for the reader of it."""
    spec = fixture_spec().with_(feeds=("yellow",), donors=(Donor(1, 1.0),))
    land_months(spark, scratch, "yellow", [(2000, m) for m in range(1, 12)])
    i = Inputs(spark, SF_SMALL)
    stray = i.feed_month("yellow", 1999, 12).unionByName(i.feed_month("yellow", 1999, 11).limit(4))
    stray.coalesce(1).write.parquet(feed_path(scratch, "yellow", 1999, 12))
    y = feeds_with_imputation(spark, scratch, spec, mark_imputed=True)["yellow"]
    assert y.filter("imputed").count() == stray.count()


def test_kept_columns_are_found_in_any_case(spark):
    from cordon.operators import raw_to_trips

    raw = Inputs(spark, SF_SMALL).feed_month("yellow", 2000, 1).withColumn("Airport_fee", F.lit(1.25))
    assert {r[0] for r in raw_to_trips(raw, "yellow", keep=("airport_fee",)).select("airport_fee").collect()} == {1.25}


def test_reports_under_the_names_dashboards_read(spark, scratch):
    from cordon.plans.audit_run import EXPORT_NAMES

    i = Inputs(spark, SF_SMALL)
    run_audit(spark, i.raw_feeds, i.baseline_raw, i.weather, i.spec, f"{scratch}/out", names=EXPORT_NAMES)
    for name in ("leakage_report.csv", "q1_decline.csv", "velocity_24.csv", "rain_data.csv", "rain_stats.txt"):
        assert os.path.exists(f"{scratch}/out/{name}/_SUCCESS")


def test_the_submitted_master_holds_and_a_cluster_needs_a_shared_folder(scratch):
    """In sessions of their own: the CLI takes the submitted master; without a shared folder only a local master gets one."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    cli = f"""
import os, sys
os.environ["PYSPARK_SUBMIT_ARGS"] = "--master local[2] --conf spark.ui.enabled=false --conf spark.checkpoint.dir={scratch}/ckpt pyspark-shell"
from cordon.plans.audit_run import main
main(["--sf-dir", "{SF_SMALL}", "--out", "{scratch}/cli"])
from pyspark.sql import SparkSession
print("MASTER", SparkSession.getActiveSession().sparkContext.master)
"""
    done = subprocess.run([sys.executable, "-c", cli], cwd=root, capture_output=True, text=True, timeout=300)
    assert "MASTER local[2]" in done.stdout, done.stderr[-2000:]
    from types import SimpleNamespace

    from cordon.session import ensure_work_dir

    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: None),
                              sparkContext=SimpleNamespace(master="spark://host:7077", getConf=lambda: {}))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_work_dir(cluster)


def half_written(folder):
    """One of the folder's parts and its mark are gone."""
    parts = sorted(p for p in os.listdir(folder) if p.startswith("part-"))
    for name in (parts[0], "_SUCCESS"):
        os.rename(f"{folder}/{name}", f"{folder}/_gone-{name}")


def test_half_written_donor_and_baseline_months_raise(spark, scratch):
    from cordon.plans.audit_run import read_baseline

    spec = fixture_spec().with_(feeds=("yellow",))
    land_months(spark, scratch, "yellow", [(2000, m) for m in range(1, 12)] + [(1998, 12), (1999, 12), (1999, 1)])
    assert read_baseline(spark, scratch, spec)["yellow"].count() > 0
    for year, month, call in ((1998, 12, lambda: feeds_with_imputation(spark, scratch, spec)), (1999, 1, lambda: read_baseline(spark, scratch, spec))):
        path = feed_path(scratch, "yellow", year, month)
        half_written(path)
        with pytest.raises(ValueError, match=f"{os.path.basename(path)}.*_SUCCESS"):
            call()
    with pytest.raises(FileNotFoundError, match="baseline month"):
        read_baseline(spark, scratch, spec.with_(baseline_year=1901))


def test_a_run_in_two_phases_gives_single_files(spark, scratch):
    from cordon.plans.audit_run import EXPORT_NAMES
    from cordon.plans.publish import read_published

    i = Inputs(spark, SF_SMALL)
    res = run_audit(spark, i.raw_feeds, i.baseline_raw, i.weather, i.spec, scratch, names=EXPORT_NAMES, runs=True)
    assert os.path.isfile(res.written["leakage"]) and res.written["leakage"].endswith("/leakage_report.csv")
    assert read_scalar(spark, f"{scratch}/rain_stats.txt") == read_published(spark, scratch, ["rain_stats"])["rain_stats"].first()[0]
    assert {n for n in os.listdir(scratch) if os.path.isfile(f"{scratch}/{n}") and n.endswith(".csv")} == \
        {f"{EXPORT_NAMES.get(n, n)}.csv" for n in res.reports}


def test_local_session_starts_without_any_settings(scratch):
    """A session of its own process, with no defaults file: the work folder is there and holds a written table."""
    import subprocess
    import sys
    from pathlib import Path

    code = ("from cordon.session import local_session, scratch_path, work_dir\n"
            "s = local_session(2)\np = scratch_path(s, 't')\ns.range(5).write.parquet(p)\n"
            "print('rows', s.read.parquet(p).count(), p.startswith(work_dir(s)))\n"
            "from pyspark.sql import SparkSession\ns.stop()\n"
            "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
            "from cordon.session import ensure_work_dir\nprint('later', scratch_path(s, 'x').startswith(ensure_work_dir(s)))\n")
    env = {k: v for k, v in os.environ.items() if k != "SPARK_CONF_DIR"} | {"SPARK_CONF_DIR": scratch, "PYTHONPATH": str(Path(__file__).resolve().parents[1])}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    assert "rows 5 True" in out.stdout and "later True" in out.stdout, out.stderr[-2000:]

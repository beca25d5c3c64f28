"""Replacement of tables, two-phase publishing and exact samples."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from cordon import tablestore
from cordon.functions import sample
from cordon.functions.sample import exact_sample, hash_sample
from cordon.plans import publish
from cordon.plans.publish import current_run, drop_runs, export_run, manifest, publish_run, read_published
from cordon.tablestore import open_table, read_text, recover_table, replace_table, write_text


def names(folder):
    return sorted(n for n in os.listdir(folder) if not n.startswith("."))


# ------------------------------------------------------------------- replacement

def test_replace_and_open(spark, scratch):
    path = f"{scratch}/t"
    replace_table(spark.range(10), path)
    replace_table(open_table(spark, path).filter("id < 4"), path)  # reads what it replaces
    assert sorted(r.id for r in open_table(spark, path).collect()) == [0, 1, 2, 3] and names(scratch) == ["t"]
    replace_table(spark.range(6).withColumn("k", F.col("id") % 2), path, partition_by=["k"])
    assert names(path) == ["_SUCCESS", "k=0", "k=1"] and names(scratch) == ["t"]


def test_a_failed_write_keeps_the_old_table(spark, scratch):
    path = f"{scratch}/t"
    replace_table(spark.range(10), path)
    bad = spark.range(1000).select(F.when(F.col("id") == 999, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="boom"):
        replace_table(bad, path)
    assert open_table(spark, path).count() == 10 and names(scratch) == ["t"]


@pytest.mark.parametrize("step", range(4))
def test_an_interrupted_swap_is_carried_through(spark, scratch, monkeypatch, step):
    """The run dies after the intent, after the old table moved, after the new one moved, and before the intent goes."""
    path = f"{scratch}/t"
    replace_table(spark.range(10), path)
    real, calls = tablestore.file_system, []

    class Dying:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            def call(*args):
                if name in ("rename", "delete"):
                    if len(calls) == step:
                        raise KeyboardInterrupt
                    calls.append(name)
                return getattr(self.fs, name)(*args)
            return call

    dying = False

    def watched(spark_, p):
        fs, place = real(spark_, p)
        return (Dying(fs) if dying else fs), place

    written = tablestore.write_text

    def then_die(*a):
        nonlocal dying
        written(*a)
        dying = True

    monkeypatch.setattr(tablestore, "file_system", watched)
    monkeypatch.setattr(tablestore, "write_text", then_die)
    with pytest.raises(KeyboardInterrupt):
        replace_table(spark.range(3), path)
    dying = False
    assert open_table(spark, path).count() == 3
    assert names(scratch) == ["t"] and not recover_table(spark, path)


def test_small_files_are_replaced_whole(spark, scratch):
    path = f"{scratch}/x"
    assert read_text(spark, path) is None
    for text in ("a", "", "é\n" * 1000):
        write_text(spark, path, text)
        assert read_text(spark, path) == text and names(scratch) == ["x"]


# -------------------------------------------------------------------- publishing

def frames(spark, k):
    leak = spark.createDataFrame([(1, 5 + k, 0.5, 2), (2, 9, 0.1, 3)], "pickup_loc long, trip_count long, compliance_rate double, missing_surcharge_hits long")
    return {"leakage": leak, "tips": spark.createDataFrame([(2, 1.5), (1, 2.5 + k)], "month int, avg_tip_pct double"),
            "border": spark.createDataFrame([], "loc_id long, count_24 long")}


def scalar(spark, v):
    return {"rain_stats": (spark.createDataFrame([(v,)], "correlation double"), "correlation")}


def test_publish_and_read(spark, scratch):
    assert current_run(spark, scratch) is None
    with pytest.raises(FileNotFoundError):
        read_published(spark, scratch)
    run = publish_run(frames(spark, 0), scratch, scalar(spark, 0.25))
    assert current_run(spark, scratch) == run
    assert names(f"{scratch}/runs/{run}") == ["border.csv", "leakage.csv", "manifest.json", "rain_stats.txt", "tips.csv"]
    assert all(os.path.isfile(f"{scratch}/runs/{run}/{n}") for n in names(f"{scratch}/runs/{run}"))
    got = read_published(spark, scratch)
    assert [tuple(r) for r in got["leakage"].collect()] == [(2, 9, 0.1, 3), (1, 5, 0.5, 2)]
    assert [tuple(r) for r in got["tips"].collect()] == [(1, 2.5), (2, 1.5)] and got["border"].collect() == []
    assert got["border"].dtypes == [("loc_id", "bigint"), ("count_24", "bigint")] and got["rain_stats"].first()[0] == "0.2500"
    assert set(json.loads(open(f"{scratch}/runs/{run}/manifest.json").read())["reports"]) == {"leakage", "tips", "border", "rain_stats"}


def test_a_run_that_breaks_between_two_reports_is_not_seen(spark, scratch, monkeypatch):
    first = publish_run(frames(spark, 0), scratch)
    real = publish._one_file

    def failing(df, folder, name, file):
        if name == "tips":
            raise OSError("disk")
        return real(df, folder, name, file)

    monkeypatch.setattr(publish, "_one_file", failing)
    with pytest.raises(OSError, match="disk"):
        publish_run(frames(spark, 1), scratch, parallel=1)
    monkeypatch.setattr(publish, "_one_file", real)
    assert current_run(spark, scratch) == first
    assert read_published(spark, scratch, ["leakage"])["leakage"].filter("pickup_loc = 1").first().trip_count == 5
    second = publish_run(frames(spark, 1), scratch)
    assert read_published(spark, scratch, ["leakage"])["leakage"].filter("pickup_loc = 1").first().trip_count == 6
    gone = drop_runs(spark, scratch, keep=2)  # the broken one; the first is kept
    assert len(gone) == 1 and names(f"{scratch}/runs") == sorted([first, second])
    assert drop_runs(spark, scratch) == [first] and names(f"{scratch}/runs") == [second]


def test_fixed_names_are_single_files(spark, scratch):
    out, dest = f"{scratch}/out", f"{scratch}/dash"
    publish_run(frames(spark, 0), out, scalar(spark, None))
    export_run(spark, out, dest, {"leakage": "leakage_report"})
    assert names(dest) == ["border.csv", "leakage_report.csv", "rain_stats.txt", "tips.csv"] and os.path.isfile(f"{dest}/leakage_report.csv")
    import pandas as pd

    assert list(pd.read_csv(f"{dest}/leakage_report.csv")["pickup_loc"]) == [2, 1]
    publish_run(frames(spark, 7), out)
    export_run(spark, out, dest, {"leakage": "leakage_report"})
    assert pd.read_csv(f"{dest}/leakage_report.csv")["trip_count"].max() == 12
    assert manifest(spark, out)["reports"]["tips"]["file"] == "tips.csv"


# ----------------------------------------------------------------------- samples

def brute(rows, keys, n):
    mark = lambda v: sample.NULL_MARK if v is None else str(v)
    md5 = lambda vs: hashlib.md5("-".join(map(mark, vs)).encode()).hexdigest()
    return sorted(map(str, sorted(rows, key=lambda r: (md5([r[k] for k in keys]), md5(list(r))))[:n]))


@pytest.mark.parametrize("n", [0, 1, 7, 50, 199, 200, 500])
def test_exact_sample_matches_brute_force(spark, n, monkeypatch):
    monkeypatch.setattr(sample, "SORTED", 2)
    monkeypatch.setattr(sample, "STEP", 1)
    rows = [(i % 40, f"t{i % 90}" if i % 3 else None) for i in range(200)]  # ties, repeated rows, nulls
    df = spark.createDataFrame(rows, "k long, t string")
    for keys in (["k"], ["t"], ["k", "t"]):
        got = exact_sample(df.repartition(3), n, keys)
        at = [df.columns.index(k) for k in keys]
        assert sorted(str(tuple(r)) for r in got.collect()) == brute(rows, at, n)


def test_exact_sample_of_many_equal_rows(spark, monkeypatch):
    """A key with most rows is cut without sorting them."""
    monkeypatch.setattr(sample, "SORTED", 100)
    df = spark.range(5000).select(F.when(F.col("id") < 4000, F.lit(None)).otherwise(F.col("id")).cast("long").alias("k"), F.lit("x").alias("_of"))
    for n in (10, 3000, 4200):
        got = exact_sample(df, n, ["k"])
        assert got.count() == n and got.columns == df.columns
        assert "TakeOrdered" not in got._jdf.queryExecution().executedPlan().toString() or n != 3000


def test_exact_sample_plan_sorts_one_bucket_only(spark):
    plan = exact_sample(spark.range(100_000), 5000, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Sort [" not in plan and "SinglePartition" not in plan and "TakeOrderedAndProject" in plan and "StartsWith" in plan


def test_null_keys_are_values(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), (None, None)], "x string, y string")
    assert hash_sample(df, 1.0, ["x"]).count() == 3 and hash_sample(df, 1.0).count() == 3
    keys = {r[0] for r in df.select(sample.sample_key(["x", "y"])).collect()}
    assert len(keys) == 3

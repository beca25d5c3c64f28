"""Feed table by period, ledger of published periods, mergeable cubes."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from cordon.operators.flags import clean_trips, flag_trips
from cordon.operators.onepass import clean_report_cube, leakage_from, tips_from
from cordon.operators.reports import surcharge_leakage, tip_crowding
from cordon.plans import periods
from cordon.plans.periods import gone_periods, input_periods, merged_cube, pending_periods, publish_periods, read_ledger, read_trips
from cordon.sources.partitioned import PERIOD, in_periods, land_periods, read_feed_table, table_to_trips
from cordon.spec import AuditSpec

SPEC = AuditSpec(analysis_year=2024, policy_start="2024-01-05", q1_start="2024-01-01", q1_end="2024-03-31")
RAW = ("VendorID long, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, lpep_pickup_datetime timestamp_ntz, "
       "lpep_dropoff_datetime timestamp_ntz, trip_distance double, PULocationID long, DOLocationID long, fare_amount double, total_amount double, "
       "congestion_surcharge double, feed string, year int, month int")


def rows(feed, year, month, n, seed=0):
    rng = random.Random(f"{feed}{year}{month}{seed}")
    out = []
    for _ in range(n):
        start = dt.datetime(year, month, rng.randrange(1, 28), rng.randrange(24), rng.randrange(60))
        times = (start, start + dt.timedelta(seconds=rng.randrange(10, 4000)))
        t = (*times, None, None) if feed == "yellow" else (None, None, *times)
        out.append((rng.randrange(3), *t, rng.choice([0.0, 1.5, 90.0]), rng.choice([4, 12, 200, 236]), rng.choice([4, 13, 201, 237]),
                    rng.choice([-3.0, 10.0, 25.0]), 30.0, rng.choice([None, 0.0, 2.5]), feed, year, month))
    return out


def land(spark, root, *parts):
    land_periods(spark.createDataFrame([r for p in parts for r in p], RAW), root)


def partition_files(table):
    """Files of each partition folder: new names mean that it was rewritten."""
    return {os.path.relpath(d, table): sorted(f for f in files if f.endswith(".parquet"))
            for d, _, files in os.walk(table) if any(f.endswith(".parquet") for f in files)}


def published(spark, out):
    return sorted(map(str, read_trips(spark, out, SPEC).collect()))


@pytest.fixture()
def landed(spark, scratch):
    root, out = f"{scratch}/in", f"{scratch}/out"
    land(spark, root, rows("yellow", 2024, 1, 60), rows("yellow", 2024, 2, 40), rows("green", 2024, 1, 30), rows("yellow", 2023, 12, 20))
    return root, out


def test_only_new_and_changed_periods_are_rewritten(spark, landed, scratch):
    root, out = landed
    first = publish_periods(spark, root, out, SPEC)
    assert first.replaced == [("green", 2024, 1), ("yellow", 2023, 12), ("yellow", 2024, 1), ("yellow", 2024, 2)] and first.removed == []
    before = partition_files(f"{out}/trips"), partition_files(f"{out}/cubes")
    # nothing new: nothing is done
    assert publish_periods(spark, root, out, SPEC).replaced == []
    assert (partition_files(f"{out}/trips"), partition_files(f"{out}/cubes")) == before
    # one month changes, one is new
    land(spark, root, rows("yellow", 2024, 1, 70, seed=1), rows("green", 2024, 3, 10))
    again = publish_periods(spark, root, out, SPEC)
    assert again.replaced == [("green", 2024, 3), ("yellow", 2024, 1)]
    for old, table in zip(before, ("trips", "cubes")):
        new = partition_files(f"{out}/{table}")
        assert {p for p in new if new[p] != old.get(p)} == {"feed=green/year=2024/month=3", "feed=yellow/year=2024/month=1"}
    # the same as one run over everything
    one = f"{scratch}/one"
    publish_periods(spark, root, one, SPEC)
    assert published(spark, out) == published(spark, one) and len(published(spark, out)) == 70 + 40 + 30 + 20 + 10


def test_removed_and_emptied_periods_leave_the_tables(spark, landed):
    root, out = landed
    publish_periods(spark, root, out, SPEC)
    os.rename(f"{root}/feed=yellow/year=2024/month=2", f"{root}/_aside")
    # a month whose files hold no row any more
    empty = spark.createDataFrame([], RAW).drop(*PERIOD).coalesce(1)
    empty.write.mode("overwrite").parquet(f"{root}/feed=green/year=2024/month=1")
    done = publish_periods(spark, root, out, SPEC)
    assert (done.replaced, done.removed) == ([("green", 2024, 1)], [("yellow", 2024, 2)])
    for table in ("trips", "cubes"):
        assert set(partition_files(f"{out}/{table}")) == {"feed=yellow/year=2023/month=12", "feed=yellow/year=2024/month=1"}
    assert {tuple(r)[:3] for r in read_ledger(spark, f"{out}/ledger").collect()} == {("green", 2024, 1), ("yellow", 2023, 12), ("yellow", 2024, 1)}
    assert publish_periods(spark, root, out, SPEC).replaced == []
    # and a month that comes back is new
    os.rename(f"{root}/_aside", f"{root}/feed=yellow/year=2024/month=2")
    assert publish_periods(spark, root, out, SPEC).replaced == [("yellow", 2024, 2)]


def test_a_broken_run_is_done_again(spark, landed, monkeypatch):
    root, out = landed
    real = periods.write_table

    def failing(df, path, **kw):
        if path.endswith("/cubes"):
            raise OSError("lost")
        return real(df, path, **kw)

    monkeypatch.setattr(periods, "write_table", failing)
    with pytest.raises(OSError, match="lost"):
        publish_periods(spark, root, out, SPEC)
    monkeypatch.setattr(periods, "write_table", real)
    assert read_ledger(spark, f"{out}/ledger").collect() == []
    assert len(publish_periods(spark, root, out, SPEC).replaced) == 4
    assert len(published(spark, out)) == 150 and publish_periods(spark, root, out, SPEC).replaced == []


def test_merged_cube_equals_the_direct_one(spark, landed):
    root, out = landed
    publish_periods(spark, root, out, SPEC)
    land(spark, root, rows("green", 2024, 4, 50))
    publish_periods(spark, root, out, SPEC)
    clean = clean_trips(flag_trips(table_to_trips(read_feed_table(spark, root, SPEC.feeds), SPEC.feeds), SPEC)).drop(*PERIOD)
    key = lambda r: tuple(round(v, 9) if isinstance(v, float) else str(v) for v in r)
    cube = merged_cube(spark, out, SPEC)
    direct = clean_report_cube(clean, SPEC)
    assert sorted(map(str, map(key, cube.select(*sorted(cube.columns)).collect()))) == sorted(map(str, map(key, direct.select(*sorted(cube.columns)).collect())))
    year = clean.filter(F.year("pickup_time") == 2024)
    cube = merged_cube(spark, out, SPEC, 2024)
    assert list(map(key, leakage_from(cube, SPEC).collect())) == list(map(key, surcharge_leakage(year, SPEC).collect()))
    assert list(map(key, tips_from(cube).collect())) == list(map(key, tip_crowding(year, SPEC).collect()))


def executed(spark, df):
    """The plan as it ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def scanned_partitions(df):
    """Partition folders that the scans of an executed plan read."""
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(p):
        if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            p = p.executedPlan()
        if p.getClass().getSimpleName() == "FileSourceScanExec" and p.metrics().contains("numPartitions"):
            found.append(int(p.metrics().apply("numPartitions").value()))
        kids = p.children()
        if p.getClass().getSimpleName().endswith("QueryStageExec"):
            walk(p.plan())
        for k in range(kids.size()):
            walk(kids.apply(k))

    walk(plan)
    return found


def test_static_and_dynamic_pruning(spark, landed, scratch):
    root, _ = landed
    table = read_feed_table(spark, root, SPEC.feeds)
    one = table.filter("feed = 'yellow' AND year = 2024 AND month = 2")
    text = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(one._jdf.queryExecution(), "formatted")
    filters = next(line for line in text.splitlines() if line.startswith("PartitionFilters"))
    assert all(f" = {v})" in filters for v in ("yellow", "2024", "2")) and "DataFilters" not in text.replace("DataFilters: []", "") and one.count() == 40
    spark.createDataFrame([("yellow", 2024, 2), ("green", 2024, 1), ("yellow", 2031, 1)], "feed string, year int, month int").coalesce(1).write.parquet(f"{scratch}/expected")
    expected = spark.read.parquet(f"{scratch}/expected").filter("month = 2")
    pruned = in_periods(table, expected).select("trip_distance")
    text = executed(spark, pruned)
    assert "dynamicpruning" in text and scanned_partitions(pruned) == [1] and pruned.count() == 40


def test_a_new_month_scans_one_month(spark, landed, monkeypatch):
    root, out = landed
    publish_periods(spark, root, out, SPEC)
    land(spark, root, rows("green", 2024, 3, 10))
    scans, real = [], periods.write_table

    def watching(df, path, **kw):
        if path.endswith("/trips"):
            df.collect()  # so that the plan has run and its counts are there
            scans.extend(scanned_partitions(df))
        return real(df, path, **kw)

    monkeypatch.setattr(periods, "write_table", watching)
    publish_periods(spark, root, out, SPEC)
    assert 1 in scans and max(scans) == 1


def test_old_schemas_and_one_scan(spark, scratch):
    """Narrower ids and a column that came later are read by the one scan of the table's schema."""
    root = f"{scratch}/in"
    land(spark, root, rows("yellow", 2024, 1, 20))
    old = spark.createDataFrame(rows("yellow", 2023, 1, 15), RAW).withColumns({c: F.col(c).cast("int") for c in ("VendorID", "PULocationID", "DOLocationID")})
    land_periods(old.drop("congestion_surcharge"), root)
    table = read_feed_table(spark, root, SPEC.feeds)
    trips = table_to_trips(table, SPEC.feeds, fill_surcharge=False)
    assert trips.count() == 35 and trips.filter("year = 2023 AND congestion_surcharge IS NOT NULL").count() == 0
    assert trips.agg(F.sum("pickup_loc")).first()[0] > 0 and executed(spark, trips).count("FileScan parquet") == 1


def test_fingerprints_see_every_change(spark, landed):
    root, _ = landed
    before = input_periods(spark, root).collect()
    ledger = spark.createDataFrame([(r.feed, r.year, r.month, r.files, r.bytes, r.fingerprint, 1) for r in before], periods.LEDGER)
    assert pending_periods(input_periods(spark, root), ledger).collect() == []
    folder = f"{root}/feed=green/year=2024/month=1"
    part = next(f for f in os.listdir(folder) if f.endswith(".parquet"))
    os.utime(f"{folder}/{part}", (1_000_000, 1_000_000))  # the same file at another time
    found = input_periods(spark, root)
    assert [tuple(r)[:3] for r in pending_periods(found, ledger).collect()] == [("green", 2024, 1)]
    assert gone_periods(found.filter("feed = 'green'"), ledger).count() == 3


def test_monthly_file_names_give_periods(spark, scratch):
    for name in ("yellow_tripdata_2024-01.parquet", "green_tripdata_2024-11.parquet"):
        spark.range(3).coalesce(1).write.parquet(f"{scratch}/{name}")
    found = {tuple(r)[:4] for r in input_periods(spark, scratch, periods.BY_NAME.replace(r"\.parquet", r"\.parquet")).collect()}
    assert found == {("yellow", 2024, 1, 1), ("green", 2024, 11, 1)}


def test_landing_keeps_files_open_instead_of_sorting(spark, scratch):
    """While months are landed a task may hold a file open for each (a sort by month would spill); the setting comes back."""
    from cordon.sources import partitioned

    name, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    before = spark.conf.get(name, None)

    class Raw:
        sparkSession = spark

        def __getattr__(self, method):
            seen.append(int(spark.conf.get(name)))
            return self if method == "write" else lambda *a: self

    land_periods(Raw(), f"{scratch}/none")
    assert set(seen) == {64} and spark.conf.get(name, None) == before
    rows = spark.range(3000).selectExpr("id", "'yellow' AS feed", "CAST(2000 + id % 9 AS INT) AS year", "CAST(1 + id % 12 AS INT) AS month")
    for files in (64, 2):  # two: the months beyond are sorted
        partitioned.OPEN_FILES, kept = files, partitioned.OPEN_FILES
        try:
            land_periods(rows, f"{scratch}/{files}")
        finally:
            partitioned.OPEN_FILES = kept
        got = spark.read.parquet(f"{scratch}/{files}").select("id", "feed", "year", "month")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))

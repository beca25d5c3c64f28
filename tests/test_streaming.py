"""Incremental audit: each run flags only files it has not seen."""

from pyspark.sql import functions as F

from cordon.operators import flag_trips, raw_to_trips
from cordon.plans.registry import Inputs
from cordon.sources.feeds import feed_path
from cordon.spec import fixture_spec
from cordon.streaming import start_incremental_audit

from conftest import SF_SMALL


def test_incremental_runs_process_new_files_once(spark, scratch):
    i = Inputs(spark, SF_SMALL)
    landing, table = f"{scratch}/landing", f"{scratch}/audit_yellow"

    def land(m):
        i.feed_month("yellow", 2000, m).drop("trip_key").coalesce(1).write.parquet(
            feed_path(landing, "yellow", 2000, m))

    land(1)
    land(2)
    # a baseline year's file in the same folder is none of the stream's
    i.feed_month("yellow", 1999, 1).drop("trip_key").coalesce(1).write.parquet(feed_path(landing, "yellow", 1999, 1))
    q = start_incremental_audit(spark, landing, "yellow", table, spec=fixture_spec())
    q.awaitTermination(120)
    first = spark.read.parquet(table).count()
    expected12 = sum(i.feed_month("yellow", 2000, m).count() for m in (1, 2))
    assert first == expected12

    land(3)
    q = start_incremental_audit(spark, landing, "yellow", table, spec=fixture_spec())  # resumes from the checkpoint
    q.awaitTermination(120)
    out = spark.read.parquet(table)
    assert out.count() == expected12 + i.feed_month("yellow", 2000, 3).count()

    # same flags as the batch operator
    batch = flag_trips(raw_to_trips(i.feed_year("yellow", 2000), "yellow")).filter(
        F.month("pickup_time") <= 3).groupBy("forensic_flag").count()
    stream = out.groupBy("forensic_flag").count()
    assert sorted(map(tuple, batch.collect()), key=str) == sorted(map(tuple, stream.collect()), key=str)


def test_both_feeds_stream_into_their_own_folders(spark, scratch):
    from cordon.streaming import read_incremental_table, start_incremental_audits

    i = Inputs(spark, SF_SMALL)
    landing, table = f"{scratch}/landing", f"{scratch}/audit"
    for feed in ("yellow", "green"):
        i.feed_month(feed, 2000, 1).drop("trip_key").coalesce(1).write.parquet(feed_path(landing, feed, 2000, 1))
    for q in start_incremental_audits(spark, landing, ["yellow", "green"], table, spec=fixture_spec()):
        q.awaitTermination(120)
    out = read_incremental_table(spark, table, ["yellow", "green"])
    want = {f: i.feed_month(f, 2000, 1).count() for f in ("yellow", "green")}
    got = {r.feed: r["count"] for r in out.groupBy("feed").count().collect()}
    assert got == want

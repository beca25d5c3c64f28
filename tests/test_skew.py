"""A zone holding a third of all trips: the shuffle carries partial aggregates only."""

import datetime as dt

from pyspark.sql import functions as F

from cordon.operators import surcharge_leakage, tip_crowding
from cordon.spec import AuditSpec

SPEC = AuditSpec()


def shuffle_records(df) -> int:
    """Sum of 'shuffle records written' over the exchanges of the executed (AQE) plan."""
    root = df._jdf.queryExecution().executedPlan()
    total, stack = 0, [root]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        if name.startswith("ShuffleQueryStage") or name.startswith("TableCacheQueryStage"):
            stack.append(node.plan())
            continue
        metrics = node.metrics()
        if "Exchange" in name and metrics.contains("shuffleRecordsWritten"):
            total += int(metrics.apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            stack.append(children.apply(i))
    return total


def skewed_trips(spark, n=300_000):
    """n trips entering the zone; every third one from pickup zone 1, the rest spread."""
    t0 = dt.datetime(2025, 2, 1)
    return spark.range(n, numPartitions=8).select(
        F.lit(t0).cast("timestamp_ntz").alias("pickup_time"),
        (F.lit(t0).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(10))).alias("dropoff_time"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.lit(1000) + F.col("id") % 500).cast("bigint").alias("pickup_loc"),
        F.lit(4).cast("bigint").alias("dropoff_loc"),
        F.lit(2.0).alias("trip_distance"),
        F.lit(10.0).alias("fare"),
        F.lit(14.0).alias("total_amount"),
        F.when(F.col("id") % 2 == 0, F.lit(0.0)).otherwise(F.lit(2.5)).alias("congestion_surcharge"),
        F.lit("yellow").alias("taxi_type"),
        F.lit(1).cast("bigint").alias("VendorID"),
    )


def test_hot_zone_is_combined_before_the_shuffle(spark):
    trips = skewed_trips(spark)
    rep = surcharge_leakage(trips, SPEC)
    top = rep.collect()[0]
    assert top.pickup_loc == 1 and top.trip_count == 100_000 and top.missing_surcharge_hits == 50_000
    # at most (tasks x distinct zones) partial rows cross the shuffle, not 300k trips
    assert shuffle_records(rep) <= 8 * 501
    tips = tip_crowding(trips, SPEC)
    # half the trips tip (14 - 10 - 0) / 10 = 40 %, half (14 - 10 - 2.5) / 10 = 15 %
    assert abs(tips.collect()[0].avg_tip_pct - 27.5) < 1e-9
    assert shuffle_records(tips) <= 8

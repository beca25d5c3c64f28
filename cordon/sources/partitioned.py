"""Raw trips of all feeds as one table by ``feed, year, month``.

One scan reads any set of months: a filter on the period columns prunes folders when the plan is made, and
a join with a table of periods prunes them when it runs (dynamic partition pruning), so the months to read
may come from data.  Files of older schemas (narrower ids, columns that came later) are read by the same
scan under the table's schema.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cordon.operators.unify import raw_to_trips
from cordon.sources.feeds import raw_schema, time_columns

PERIOD = ("feed", "year", "month")
#: Spark's own setting: files that one writing task holds open, so that it need not sort by folder
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
OPEN_FILES = 64
_PERIOD_FIELDS = [T.StructField("feed", T.StringType()), T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())]


def feed_table_schema(feeds: Iterable[str], extra: Sequence[T.StructField] = ()) -> T.StructType:
    """The raw columns of all ``feeds`` (each feed has its own time columns), ``extra`` ones and the period."""
    fields: dict[str, T.StructField] = {}
    for feed in feeds:
        for f in raw_schema(feed).fields:
            fields.setdefault(f.name, f)
    return T.StructType([*fields.values(), *extra, *_PERIOD_FIELDS])


def land_periods(raw: DataFrame, root: str, replace: bool = True) -> str:
    """Write raw rows that carry ``feed, year, month`` into their folders; those periods are replaced, others stay.

    ``rebalance`` lets the adaptive plan cut a month that holds many of the rows into several files.  A task then holds
    few months and keeps a file open for each, so its rows are not sorted by month (a sort spills what does not fit);
    only rows of months beyond ``OPEN_FILES`` are.
    """
    conf = raw.sparkSession.conf
    before = conf.get(WRITERS, None)
    conf.set(WRITERS, str(OPEN_FILES))
    try:
        raw.hint("rebalance", *PERIOD).write.mode("overwrite" if replace else "append").option("partitionOverwriteMode", "dynamic") \
            .partitionBy(*PERIOD).parquet(root)
    finally:
        conf.unset(WRITERS) if before is None else conf.set(WRITERS, before)
    return root


def read_feed_table(spark: SparkSession, root: str, feeds: Iterable[str], extra: Sequence[T.StructField] = ()) -> DataFrame:
    """The landed table as one scan; nothing is listed by month and no footer is read while planning."""
    return spark.read.schema(feed_table_schema(feeds, extra)).parquet(root)


def in_periods(table: DataFrame, periods: DataFrame) -> DataFrame:
    """The rows of ``table`` whose period is in ``periods``.

    With a selective filter on ``periods`` (or a written table of them), the scan lists only their folders: the
    periods are at most feeds times months, so Spark broadcasts them by their measured size.
    """
    return table.join(periods.select(*PERIOD).distinct(), list(PERIOD), "left_semi")


def table_to_trips(table: DataFrame, feeds: Iterable[str], keep: Sequence[str] = (), fill_surcharge: bool = True) -> DataFrame:
    """Rows of the feed table in the Trip schema, with the period they landed in; no union, so one scan stays one."""
    feeds = list(feeds)

    def own(which: int):
        out = F.lit(None).cast("timestamp_ntz")
        for feed in feeds:
            out = F.when(F.col("feed") == feed, F.col(time_columns(feed)[which])).otherwise(out)
        return out

    pickup, dropoff = time_columns(feeds[0])
    one = table.withColumns({pickup: own(0), dropoff: own(1)})
    return raw_to_trips(one, feeds[0], fill_surcharge, keep=[*keep, *PERIOD]).withColumn("taxi_type", F.col("feed"))

"""Only new work: published periods, a ledger of their inputs, and an anti-join.

The ledger holds, for each published ``(feed, year, month)``, a fingerprint of the files it came from: their
names, lengths and times.  Months whose fingerprint is not in the ledger are new or changed; an anti-join
finds them, dynamic pruning reads only them, and a dynamic overwrite replaces only their partitions.  The
ledger is written last, so a run that breaks is done again and gives the same tables.  Report cubes (C20)
are kept per period in the same way: a new month costs one month's scan, and reports are merged from states.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cordon.operators.flags import clean_trips, flag_trips
from cordon.operators.onepass import merge_cubes, period_cube
from cordon.session import scratch_path
from cordon.sinks import write_table
from cordon.sources.feeds import _file_system, path_exists
from cordon.sources.partitioned import PERIOD, feed_table_schema, in_periods, read_feed_table, table_to_trips
from cordon.spec import AuditSpec

#: where the period stands in a path: folders by period, or monthly files by name
BY_FOLDER = r"feed=([^/]+)/year=(\d+)/month=(\d+)/"
BY_NAME = r"([A-Za-z]+)_tripdata_(\d{4})-(\d{2})\.parquet"
LEDGER = "feed string, year int, month int, files bigint, bytes bigint, fingerprint string, run bigint"


@dataclass(frozen=True)
class PublishedPeriods:
    """What a run did: the periods it replaced and those it removed."""

    run: int
    replaced: list[tuple[str, int, int]]
    removed: list[tuple[str, int, int]]


def input_periods(spark: SparkSession, root: str, pattern: str = BY_FOLDER) -> DataFrame:
    """``feed, year, month, files, bytes, fingerprint`` of what lies under ``root``: one row per period.

    The files are listed as a table (names, lengths and times, no contents).  The fingerprint is a sum over the
    files, so it does not depend on their order and is added up before the shuffle.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root) \
        .select("path", "length", F.unix_micros("modificationTime").alias("time"))
    part = lambda i: F.regexp_extract("path", pattern, i)
    known = files.filter(part(1) != "").withColumn("name", F.regexp_extract("path", f"{pattern}.*$", 0))
    return known.groupBy(part(1).alias("feed"), part(2).cast("int").alias("year"), part(3).cast("int").alias("month")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
        F.sum(F.xxhash64("name", "length", "time").cast("decimal(38,0)")).cast("string").alias("fingerprint"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The latest entry of each period; a period that was removed has none.  Runs only append to the ledger."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    entries = spark.read.schema(LEDGER).parquet(path)
    latest = entries.groupBy(*PERIOD).agg(F.max_by(F.struct("files", "bytes", "fingerprint", "run"), "run").alias("e"))
    return latest.select(*PERIOD, "e.*").filter("files > 0")


def pending_periods(inputs: DataFrame, ledger: DataFrame) -> DataFrame:
    """New and changed periods: those whose fingerprint the ledger lacks."""
    return inputs.filter("files > 0").join(ledger.select(*PERIOD, "fingerprint"), [*PERIOD, "fingerprint"], "left_anti")


def gone_periods(inputs: DataFrame, ledger: DataFrame) -> DataFrame:
    """Published periods without any input file left."""
    return ledger.join(inputs.select(*PERIOD), list(PERIOD), "left_anti")


def publish_periods(spark: SparkSession, root: str, out: str, spec: AuditSpec = AuditSpec(), extra: Sequence[T.StructField] = ()) -> PublishedPeriods:
    """Bring ``out/trips`` (flagged trips by period) and ``out/cubes`` (report states by period) up to date with
    the feed table under ``root``, doing only the periods that are new, changed or gone.

    ``extra`` names further raw columns to carry along.  One publisher at a time.  The periods themselves (feeds
    times months) are all that comes to the driver.
    """
    out = out.rstrip("/")
    inputs = _kept(input_periods(spark, root), "inputs")
    ledger = read_ledger(spark, f"{out}/ledger")
    todo, gone = _kept(pending_periods(inputs, ledger), "pending"), _periods(gone_periods(inputs, ledger))
    replaced = _periods(todo)
    run = (ledger.agg(F.max("run")).first()[0] or 0) + 1
    if not replaced and not gone:
        return PublishedPeriods(run, [], [])
    drop = {"trips": set(gone), "cubes": set(gone)}  # an overwrite leaves the old rows of a period that has none now
    if replaced:
        raw = in_periods(read_feed_table(spark, root, spec.feeds, extra), todo.filter("files > 0"))
        trips = table_to_trips(raw, spec.feeds, keep=[f.name for f in extra])
        write_table(flag_trips(trips, spec), f"{out}/trips", partition_by=PERIOD, replace_partitions=True, sort_within=[*PERIOD, "forensic_flag", "pickup_time"])
        drop["trips"] |= set(replaced) - set(_periods(raw.groupBy(*PERIOD).count()))
    _remove(spark, f"{out}/trips", drop["trips"])
    if replaced:
        clean = clean_trips(in_periods(read_trips(spark, out, spec, extra), todo.filter("files > 0")))
        cubes = _kept(period_cube(clean, spec, PERIOD), "cubes")
        write_table(cubes.repartition(1), f"{out}/cubes", partition_by=PERIOD, replace_partitions=True)
        drop["cubes"] |= set(replaced) - set(_periods(cubes.groupBy(*PERIOD).count()))
    _remove(spark, f"{out}/cubes", drop["cubes"])
    done = todo.select(*PERIOD, "files", "bytes", "fingerprint", F.lit(run).cast("long").alias("run"))
    if gone:
        done = done.unionByName(spark.createDataFrame([(*p, 0, 0, "", run) for p in gone], LEDGER))
    write_table(done.repartition(1), f"{out}/ledger", mode="append")
    return PublishedPeriods(run, replaced, gone)


def read_trips(spark: SparkSession, out: str, spec: AuditSpec, extra: Sequence[T.StructField] = ()) -> DataFrame:
    """The published trips, flagged and clean, with the period they landed in."""
    schema, path = _trips_schema(spark, spec, extra), f"{out.rstrip('/')}/trips"
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def _trips_schema(spark: SparkSession, spec: AuditSpec, extra: Sequence[T.StructField] = ()) -> T.StructType:
    raw = spark.createDataFrame([], feed_table_schema(spec.feeds, extra))
    return flag_trips(table_to_trips(raw, spec.feeds, keep=[f.name for f in extra]), spec).schema


def read_cubes(spark: SparkSession, out: str, spec: AuditSpec) -> DataFrame:
    path = f"{out.rstrip('/')}/cubes"
    empty = spark.createDataFrame([], _trips_schema(spark, spec))
    schema = period_cube(clean_trips(empty), spec, PERIOD).schema
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def merged_cube(spark: SparkSession, out: str, spec: AuditSpec, year: int | None = None) -> DataFrame:
    """The report cube of a year (of all years by default), merged from the states of its periods.  What
    ``leakage_from``, ``volume_from``, ``speed_from``, ``tips_from``, ``daily_from`` and ``border_from`` take."""
    states = read_cubes(spark, out, spec)
    return merge_cubes(states.filter(F.col("year") == year) if year is not None else states)


def _kept(df: DataFrame, name: str) -> DataFrame:
    """A small table under the shared folder: read again by later jobs, and of known size to the planner."""
    path = write_table(df.repartition(1), scratch_path(df.sparkSession, name))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _periods(df: DataFrame) -> list[tuple[str, int, int]]:
    return sorted(tuple(r) for r in df.select(*PERIOD).collect())


def _remove(spark: SparkSession, table: str, periods: set[tuple[str, int, int]]) -> None:
    for feed, year, month in periods:
        fs, place = _file_system(spark, f"{table}/feed={feed}/year={year}/month={month}")
        fs.delete(place, True)

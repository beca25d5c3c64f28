"""Raw monthly trip feeds.

Files are addressed by ``(feed, year, month)`` through a path template over any
Hadoop-compatible file system root (S12).  Monthly files drift in schema (a column
added in a later year, ``int`` vs ``bigint`` ids), so each month is read on its own,
cast to the feed's raw schema and combined with ``unionByName`` (S2).  Each month
stays its own scan: column pruning and pushed filters still apply per file.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cordon.spec import FEED_TIME_COLUMNS

DEFAULT_TEMPLATE = "{root}/{feed}_tripdata_{year}-{month:02d}.parquet"

# columns every consumer needs, in raw-file order (times are per feed)
RAW_COLUMNS = (
    "VendorID", "{pickup}", "{dropoff}", "trip_distance", "PULocationID", "DOLocationID",
    "fare_amount", "total_amount", "congestion_surcharge",
)

_RAW_TYPES = {
    "VendorID": T.LongType(),
    "trip_distance": T.DoubleType(),
    "PULocationID": T.LongType(),
    "DOLocationID": T.LongType(),
    "fare_amount": T.DoubleType(),
    "total_amount": T.DoubleType(),
    "congestion_surcharge": T.DoubleType(),
}


def time_columns(feed: str) -> tuple[str, str]:
    try:
        return FEED_TIME_COLUMNS[feed]
    except KeyError:
        raise ValueError(f"unknown feed {feed!r}; expected one of {sorted(FEED_TIME_COLUMNS)}") from None


def raw_schema(feed: str) -> T.StructType:
    pickup, dropoff = time_columns(feed)
    fields = []
    for name in RAW_COLUMNS:
        name = name.format(pickup=pickup, dropoff=dropoff)
        dtype = _RAW_TYPES.get(name, T.TimestampNTZType())
        fields.append(T.StructField(name, dtype, True))
    return T.StructType(fields)


def feed_path(root: str, feed: str, year: int, month: int, template: str = DEFAULT_TEMPLATE) -> str:
    return template.format(root=root.rstrip("/"), feed=feed, year=year, month=month)


def conform(df: DataFrame, feed: str) -> DataFrame:
    """Cast the known raw columns to the feed schema; absent ones become typed nulls.
    Extra columns are kept (imputation writes them back unchanged)."""
    present = {c.lower(): c for c in df.columns}
    out = []
    for field in raw_schema(feed).fields:
        src = present.get(field.name.lower())
        if src is None:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            out.append(F.col(src).cast(field.dataType).alias(field.name))
    known = {f.name.lower() for f in raw_schema(feed).fields}
    extras = [F.col(c) for c in df.columns if c.lower() not in known]
    return df.select(*out, *extras)


def read_feed_months(
    spark: SparkSession,
    root: str,
    feed: str,
    periods: Iterable[tuple[int, int]],
    template: str = DEFAULT_TEMPLATE,
) -> DataFrame:
    """Read the given ``(year, month)`` files of one feed as one DataFrame.

    Files with the same footer schema are read by one scan; each distinct schema gets
    its own scan, conformed to the feed schema, and the scans are unioned by name.
    """
    paths = [feed_path(root, feed, y, m, template) for y, m in periods]
    if not paths:
        raise ValueError("no periods given")
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    with ThreadPoolExecutor(max_workers=min(8, len(paths))) as pool:  # a footer each, no data
        schemas = list(pool.map(lambda p: read_parquet(spark, p).schema, paths))
    for path, schema in zip(paths, schemas):
        groups.setdefault(schema.json(), (schema, []))[1].append(path)
    frames = [conform(spark.read.schema(schema).parquet(*group), feed) for schema, group in groups.values()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def read_feed(
    spark: SparkSession,
    root: str,
    feed: str,
    year: int | Iterable[int],
    months: Iterable[int] = range(1, 13),
    template: str = DEFAULT_TEMPLATE,
    skip_missing: bool = True,
    complete_only: bool = True,
) -> DataFrame:
    """All monthly files of one feed and year (or years); absent months are skipped like a glob, and so are
    folders without a ``_SUCCESS`` mark unless ``complete_only`` is off (one write may fill many months)."""
    months = list(months)
    periods = [(y, m) for y in ([year] if isinstance(year, int) else year) for m in months]
    if skip_missing:
        there = is_complete if complete_only else path_exists
        periods = [(y, m) for y, m in periods if there(spark, feed_path(root, feed, y, m, template))]
    return read_feed_months(spark, root, feed, periods, template)


def _file_system(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path (works for any scheme)."""
    fs, jpath = _file_system(spark, path)
    return bool(fs.exists(jpath))


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a month is there as a whole: a file, or a folder that its writer marked ``_SUCCESS``."""
    fs, jpath = _file_system(spark, path)
    if not fs.exists(jpath):
        return False
    return bool(fs.getFileStatus(jpath).isFile()) or path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def write_month(df: DataFrame, path: str) -> None:
    """Write a month beside its place and rename it there when it is whole, so that no reader ever sees part
    of it.  What an earlier, broken write left in the place is moved aside, not deleted."""
    spark, tag = df.sparkSession, uuid.uuid4().hex[:12]
    head, _, name = path.rstrip("/").rpartition("/")
    building, aside = f"{head}/_building-{tag}-{name}", f"{head}/_incomplete-{tag}-{name}"
    df.write.mode("errorifexists").parquet(building)
    fs, place = _file_system(spark, path)
    to_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    if is_complete(spark, path):
        raise FileExistsError(path)
    if fs.exists(place) and not fs.rename(place, to_path(aside)):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(to_path(building), place):
        raise OSError(f"cannot rename {building} to {path}")


# footer schemas of single parquet files, keyed by (path, length, modification time)
_SCHEMA_CACHE: dict[tuple[str, int, int], T.StructType] = {}


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """``spark.read.parquet(path)``, skipping the footer read for schema inference when
    the same unchanged single file was read before.  Directories are always inferred."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    try:
        status = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(jpath)
    except Exception:  # absent path: let the reader raise its usual error
        return spark.read.parquet(path)
    if not status.isFile():
        return spark.read.parquet(path)
    key = (path, int(status.getLen()), int(status.getModificationTime()))
    schema = _SCHEMA_CACHE.get(key)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMA_CACHE[key] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)

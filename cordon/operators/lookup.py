"""Lookup with a default by joining a dimension table (J3, R2), for lookups that come from data."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordon.session import scratch_path
from cordon.sinks import write_table
from cordon.tablestore import file_system

#: a dimension of up to so many bytes on disk goes to every task; a larger one is joined by a shuffle
BROADCAST_BYTES = 8 << 20


def lookup_join(df: DataFrame, dimension: DataFrame, keys: Mapping[str, str], defaults: Mapping[str, object], limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with the columns ``defaults`` of ``dimension``; ``keys`` maps key columns of ``df`` to the dimension's.

    A row whose key is null or not in the dimension gets the defaults, and so does a null value.  A key that the
    dimension has twice raises a ``ValueError`` that names it, since rows would multiply; null keys of the dimension match
    nothing and may repeat.  The dimension's needed columns are written once, which gives its size: only up to
    ``limit`` bytes are they broadcast.  Beyond that a shuffle join takes over, whose hot keys the adaptive plan splits.
    """
    spark = df.sparkSession
    names = {own: f"_key_{i}" for i, own in enumerate(keys)}
    clash = set(defaults) & set(df.columns)
    if clash:
        raise ValueError(f"columns are already there: {sorted(clash)}")
    slim = dimension.select(*[F.col(d).alias(names[o]) for o, d in keys.items()], *defaults).dropna(subset=list(names.values()))
    path = write_table(slim, scratch_path(spark, "dimension"))
    held = spark.read.schema(slim.schema).parquet(path)
    twice = held.groupBy(*names.values()).count().filter("count > 1").first()
    if twice is not None:
        raise ValueError(f"the dimension has the key {tuple(twice)[:-1]} {twice['count']} times")
    fs, place = file_system(spark, path)
    small = fs.getContentSummary(place).getLength() <= limit
    held = held.withColumnsRenamed({c: f"_value_{c}" for c in defaults})
    right = F.broadcast(held) if small else held.hint("merge")
    on = [F.col(o) == F.col(n) for o, n in names.items()]
    joined = df.join(right, on, "left")
    values = [F.coalesce(F.col(f"_value_{c}"), F.lit(v)).alias(c) for c, v in defaults.items()]
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *values)

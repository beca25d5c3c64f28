"""Reproducible row sampling by hash.

``substr(md5(key), 1, 8) < threshold`` keeps a row iff the first 32 bits of the md5 of
its key fall below ``fraction * 2**32``. The decision depends only on the row, so it is
the same under any partitioning, on re-runs and after a lost executor recomputes a
partition -- unlike a seeded ``df.sample``, whose draw depends on partition layout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_fraction_threshold(fraction: float) -> str:
    if not 0.0 <= fraction <= 1.0:
        raise ValueError(f"fraction must be within [0, 1], got {fraction}")
    bound = min(int(fraction * 2**32), 2**32 - 1)
    if fraction >= 1.0:
        return "g"  # sorts above every hex digit: keep everything
    return f"{bound:08x}"


#: stands for null in a key, so that a null is a value like any other
NULL_MARK = "\\N"


def sample_key(cols: Sequence[str]) -> Column:
    """Key text of a row: its columns joined by '-', nulls as ``\\N``."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in cols]
    return parts[0] if len(parts) == 1 else F.concat_ws("-", *parts)


def in_hash_sample(key: Column, fraction: float) -> Column:
    return F.substring(F.md5(key), 1, 8) < F.lit(hash_fraction_threshold(fraction))


def hash_sample(df: DataFrame, fraction: float, key_cols: Sequence[str] | None = None) -> DataFrame:
    """Keep about ``fraction`` of the rows, chosen by a hash of ``key_cols``
    (default: every column, so equal rows are kept or dropped together)."""
    cols = list(key_cols) if key_cols else df.columns
    return df.filter(in_hash_sample(sample_key(cols), fraction))


#: hex digits of the hash that one histogram tells apart: 65,536 buckets
STEP = 4
#: a cut bucket of up to so many rows is settled by sorting it
SORTED = 10_000


def exact_sample(df: DataFrame, n: int, key_cols: Sequence[str] | None = None) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer): those with the least md5 of their key, ties by the md5 of the
    whole row.

    Nothing is sorted as a whole.  A histogram of hash prefixes gives the bucket in which the ``n``-th row lies; the
    rows of the buckets before it are taken by a filter, and only that bucket is looked into, by a longer prefix or,
    once it is small, by sorting it.  Equal rows that are left over at the cut are interchangeable, so they are
    made again in the number that is missing.  The result depends on the rows alone.
    """
    if n <= 0:
        return df.limit(0)
    own = list(df.columns)
    order = F.concat(F.md5(sample_key(list(key_cols) if key_cols else own)), F.md5(sample_key(own)))
    name, same = "_order", "_same"
    while {name.lower(), same.lower()} & {c.lower() for c in own}:
        name, same = name + "_", same + "_"
    rows, left, prefix = df.withColumn(name, order), n, ""
    whole = 64
    while True:
        inside = rows.filter(F.col(name).startswith(prefix)) if prefix else rows
        size = len(prefix) + STEP
        counts = inside.groupBy(F.substring(name, 1, size).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
        # at most 65,536 rows, whatever the table
        buckets = sorted((r["bucket"], r["n"]) for r in counts.collect())
        cut = None
        for bucket, count in buckets:
            if count > left:
                cut = bucket, count
                break
            left -= count
        if cut is None:  # everything inside is taken
            upto = rows if not prefix else rows.filter(F.substring(name, 1, len(prefix)) <= prefix)
            return upto.drop(name)
        prefix = cut[0]
        taken = rows.filter(F.substring(name, 1, len(prefix)) < prefix)
        if left == 0:
            return taken.drop(name)
        bucket = rows.filter(F.col(name).startswith(prefix))
        if cut[1] <= SORTED:
            rest = bucket.orderBy(name).limit(left)
        elif len(prefix) == whole:  # very many equal rows
            one = bucket.limit(1).withColumn(same, F.lit(0))
            made = df.sparkSession.range(left).select(F.lit(0).alias(same))
            rest = made.join(F.broadcast(one), same).drop(same)
        else:
            continue
        return taken.unionByName(rest).drop(name)

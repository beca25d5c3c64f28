"""Sinks: parquet tables (S6, S7), report CSVs (S8, C20) and scalar text.

Reports are already aggregated to at most a few hundred rows; ``repartition(1)`` gives one
CSV part per report and leaves the aggregation before it as parallel as it is.  Writing a
table replaces it; ``replace_partitions=True`` replaces only the partitions that the new rows
fall into (tables partitioned by period).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
                sort_within: Sequence[str] = (), replace_partitions: bool = False) -> str:
    """Parquet table; ``sort_within`` orders rows inside each file so that min/max
    statistics let later range filters skip row groups."""
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    writer = out.write.mode(mode).option("partitionOverwriteMode", "dynamic" if replace_partitions else "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_report_csv(df: DataFrame, path: str, order_by: Sequence[str] = ()) -> str:
    """A finished report as one CSV with a header row (no index column), sorted by ``order_by``."""
    one = df.repartition(1)
    (one.sortWithinPartitions(*order_by) if order_by else one).write.mode("overwrite").option("header", "true").csv(path)
    return path


def format_scalar(value: Column, fmt: str = "%.4f") -> Column:
    return F.when(value.isNull(), F.lit(None)).otherwise(F.format_string(fmt, value))


def write_scalar(df: DataFrame, column: str, path: str, fmt: str = "%.4f") -> str:
    """The one value of a one-row report as text, e.g. a correlation as ``%.4f``."""
    df.select(format_scalar(F.col(column), fmt).alias("value")).repartition(1) \
        .write.mode("overwrite").text(path)
    return path


# reports whose rows are sorted, and by what
REPORT_ORDER = {
    "leakage": ("missing_surcharge_hits desc", "pickup_loc"), "vendors": ("ghost_count desc", "VendorID", "forensic_flag"),
    "tips": ("month",), "rain_daily": ("date",), "velocity_grid_before": ("dow",), "velocity_grid_after": ("dow",),
}


def publish_reports(reports: Mapping[str, DataFrame], out_dir: str,
                    scalars: Mapping[str, tuple[DataFrame, str]] | None = None,
                    parallel: int = 4, names: Mapping[str, str] | None = None) -> dict[str, str]:
    """Write each report as ``{out_dir}/{name}.csv`` and each scalar as ``{name}.txt``; ``names``
    gives some of them other file names.

    The reports are independent small jobs, so up to ``parallel`` are submitted at once
    (a SparkSession accepts jobs from several driver threads)."""
    out, names = out_dir.rstrip("/"), names or {}
    order = {k: [F.desc(c.split()[0]) if c.endswith(" desc") else F.asc_nulls_last(c) for c in v] for k, v in REPORT_ORDER.items()}
    tasks = [(name, lambda df=df, name=name: write_report_csv(df, f"{out}/{names.get(name, name)}.csv", order.get(name, ())))
             for name, df in reports.items()]
    tasks += [(name, lambda df=df, c=c, name=name: write_scalar(df, c, f"{out}/{names.get(name, name)}.txt"))
              for name, (df, c) in (scalars or {}).items()]
    if parallel <= 1:
        return {name: fn() for name, fn in tasks}
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks}
        return {name: f.result() for name, f in futures.items()}

"""Reports published as one run, in two phases.

Each report is one data file in a folder of its own run, and a manifest lists them with their columns and
row counts.  Only when all are there, one small file, ``CURRENT``, is replaced to name the run.  Readers go
through it, so they see all reports of one run or all of another, whenever a run breaks.  ``export_run`` puts
the current run's files under the fixed names that existing dashboards open, one whole file at a time.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cordon.sinks import REPORT_ORDER, format_scalar
from cordon.tablestore import file_system, read_text, write_text

POINTER = "CURRENT"


def publish_run(reports: Mapping[str, DataFrame], out: str, scalars: Mapping[str, tuple[DataFrame, str]] | None = None, parallel: int = 4) -> str:
    """Write ``reports`` (CSV) and ``scalars`` (``name: (one-row frame, column)``, text) as a run under ``out``, then
    make it the current one; its id.

    A run that breaks is never named by the pointer; its folder stays for a look and :func:`drop_runs` deletes it.
    """
    if not reports and not scalars:
        raise ValueError("nothing to publish")
    spark = next(iter(reports.values()), None) or next(iter((scalars or {}).values()))[0]
    spark, out = spark.sparkSession, out.rstrip("/")
    run = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    folder = f"{out}/runs/{run}"
    tasks = {name: (df, f"{name}.csv") for name, df in reports.items()}
    tasks |= {name: (df.select(format_scalar(F.col(c)).alias("value")), f"{name}.txt") for name, (df, c) in (scalars or {}).items()}
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        futures = {name: pool.submit(_one_file, df, folder, name, file) for name, (df, file) in tasks.items()}
        entries = {name: f.result() for name, f in futures.items()}
    write_text(spark, f"{folder}/manifest.json", json.dumps({"run": run, "reports": entries}, indent=1))
    write_text(spark, f"{out}/{POINTER}", run)
    return run


def _one_file(df: DataFrame, folder: str, name: str, file: str) -> dict:
    """Write the finished report as the one file ``folder/file``; its entry in the manifest."""
    spark, parts = df.sparkSession, f"{folder}/_parts-{name}"
    one = df.repartition(1)
    if name in REPORT_ORDER:
        one = one.sortWithinPartitions(*[F.desc(c.split()[0]) if c.endswith(" desc") else F.asc_nulls_last(c) for c in REPORT_ORDER[name]])
    writer = one.write.mode("errorifexists")
    if file.endswith(".txt"):
        writer.text(parts)
    else:
        writer.option("header", "true").csv(parts)
    fs, place = file_system(spark, parts)
    found = [s.getPath() for s in fs.listStatus(place) if s.getPath().getName().startswith("part-")]
    target = file_system(spark, f"{folder}/{file}")[1]
    if not found:  # no row, no part: the header alone
        write_text(spark, f"{folder}/{file}", "" if file.endswith(".txt") else ",".join(df.columns) + "\n")
    elif len(found) > 1 or not fs.rename(found[0], target):
        raise OSError(f"report {name}: {len(found)} parts in {parts}")
    fs.delete(place, True)
    return {"file": file, "schema": df.schema.jsonValue(), "bytes": int(fs.getFileStatus(target).getLen())}


def current_run(spark: SparkSession, out: str) -> str | None:
    """The id of the published run, None where there is none yet."""
    return read_text(spark, f"{out.rstrip('/')}/{POINTER}")


def manifest(spark: SparkSession, out: str, run: str | None = None) -> dict:
    run = run or current_run(spark, out)
    text = read_text(spark, f"{out.rstrip('/')}/runs/{run}/manifest.json") if run else None
    if text is None:
        raise FileNotFoundError(f"no published run under {out}")
    return json.loads(text)


def read_published(spark: SparkSession, out: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """The reports of the current run, all of the same one, with the columns they were written with."""
    found = manifest(spark, out)
    folder, frames = f"{out.rstrip('/')}/runs/{found['run']}", {}
    for name in names or found["reports"]:
        entry = found["reports"][name]
        schema, path = T.StructType.fromJson(entry["schema"]), f"{folder}/{entry['file']}"
        frames[name] = spark.read.text(path) if entry["file"].endswith(".txt") else spark.read.schema(schema).option("header", "true").csv(path)
    return frames


def export_run(spark: SparkSession, out: str, dest: str, names: Mapping[str, str] | None = None) -> dict[str, str]:
    """Copy the current run's files to ``dest`` under fixed names (``names`` renames some), each file in one step."""
    found, dest, done = manifest(spark, out), dest.rstrip("/"), {}
    for name, entry in found["reports"].items():
        kind = entry["file"].rsplit(".", 1)[1]
        path = f"{dest}/{(names or {}).get(name, name)}.{kind}"
        write_text(spark, path, read_text(spark, f"{out.rstrip('/')}/runs/{found['run']}/{entry['file']}"))
        done[name] = path
    return done


def drop_runs(spark: SparkSession, out: str, keep: int = 1) -> list[str]:
    """Delete runs that are older than the current one but for the ``keep - 1`` latest of them, and broken ones that
    began before it; their ids."""
    current = current_run(spark, out)
    if current is None:
        return []
    fs, place = file_system(spark, f"{out.rstrip('/')}/runs")
    earlier = sorted((s.getPath().getName() for s in fs.listStatus(place) if s.getPath().getName() < current), reverse=True)
    whole = [r for r in earlier if read_text(spark, f"{out.rstrip('/')}/runs/{r}/manifest.json") is not None]
    gone = [r for r in earlier if r not in whole[:max(0, keep - 1)]]
    for run in gone:
        fs.delete(file_system(spark, f"{out.rstrip('/')}/runs/{run}")[1], True)
    return gone

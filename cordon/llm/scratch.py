"""Tables written between jobs, in the folder that the whole cluster shares."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cordon.session import scratch_path


#: Spark's own setting: an execution's shuffle files go when it ends
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back: the lineage ends
    there, and losing an executor later costs nothing that was computed before.  The shuffle files
    of the write are not needed again and go at once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode("errorifexists").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete tables that ``written`` made and nothing reads any more."""
    for df in tables:
        path = getattr(df, "_written_to", None)
        if path:
            spark = df.sparkSession
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def importable(spark) -> None:
    """Let Python workers import this package from where the driver did.  A cluster that ships the package
    (``--py-files``) or has it installed finds it there as well."""
    import os
    from pathlib import Path

    root = str(Path(__file__).resolve().parents[2])
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*paths, root])

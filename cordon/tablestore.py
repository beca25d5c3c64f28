"""Tables that are replaced as a whole, or not at all (S6), on any Hadoop file system.

A replacement is written beside the table.  Then an intent file names it, and two renames swap it in; the
intent file goes last.  A run that breaks before the intent leaves the old table as it was; one that breaks
after it is carried through by whoever opens or replaces the table next.  No reader ever sees a part.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cordon.sinks import write_table


def file_system(spark: SparkSession, path: str):
    """``(file system, path)`` of the JVM for ``path``."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, whole or not there: written beside its place and renamed over it in one step."""
    fs, place = file_system(spark, path)
    jvm = spark.sparkContext._jvm
    beside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:12]}.tmp")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(context.makeQualified(beside), context.makeQualified(place), options)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The small file's text, or None where there is none."""
    fs, place = file_system(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _intent(path: str) -> str:
    head, _, name = path.rstrip("/").rpartition("/")
    return f"{head}/_swap-{name}.json"


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_within: Sequence[str] = ()) -> str:
    """Write ``df`` as the table at ``path``.  Until it is whole, the table keeps what it held; ``df`` may read the
    table itself.  One writer at a time."""
    spark, path = df.sparkSession, path.rstrip("/")
    recover_table(spark, path)
    head, _, name = path.rpartition("/")
    tag = uuid.uuid4().hex[:12]
    staged, old = f"{head}/_staged-{tag}-{name}", f"{head}/_old-{tag}-{name}"
    try:
        write_table(df, staged, partition_by, mode="errorifexists", sort_within=sort_within)
    except BaseException:
        fs, place = file_system(spark, staged)
        fs.delete(place, True)
        raise
    write_text(spark, _intent(path), json.dumps({"staged": staged, "old": old}))
    recover_table(spark, path)
    return path


def recover_table(spark: SparkSession, path: str) -> bool:
    """Carry an interrupted swap through; whether there was one.

    The intent file is there only once the staged table is whole.  The old table is moved away unless that was
    done, the staged one into its place unless that was done, and the old one deleted.
    """
    path = path.rstrip("/")
    text = read_text(spark, _intent(path))
    if text is None:
        return False
    names = json.loads(text)
    fs, place = file_system(spark, path)
    staged, old = file_system(spark, names["staged"])[1], file_system(spark, names["old"])[1]
    if fs.exists(staged):
        if fs.exists(place) and not fs.rename(place, old):
            raise OSError(f"cannot move {path} aside")
        if not fs.rename(staged, place):
            raise OSError(f"cannot move {names['staged']} to {path}")
    fs.delete(old, True)
    fs.delete(file_system(spark, _intent(path))[1], False)
    return True


def open_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read the table, after carrying an interrupted swap through."""
    recover_table(spark, path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)

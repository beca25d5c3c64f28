"""Small file sources: report CSVs (S9), weather JSON (S11), scalar text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cordon.sources.feeds import path_exists

WEATHER_SCHEMA = T.StructType([
    T.StructField("daily", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("precipitation_sum", T.ArrayType(T.DoubleType())),
    ])),
])


def read_weather_json(spark: SparkSession, path: str) -> DataFrame:
    """Daily weather from a JSON object of parallel arrays -> ``(date, precip_mm)`` rows.

    The arrays are zipped element-wise, so day i pairs with value i; a null precipitation
    stays null.  Days are local calendar days of the zone, like trip times.
    """
    raw = spark.read.schema(WEATHER_SCHEMA).option("multiLine", "true").json(path)
    zipped = raw.select(F.explode(F.arrays_zip(F.col("daily.time").alias("t"),
                                               F.col("daily.precipitation_sum").alias("p"))).alias("d"))
    return zipped.select(
        F.to_date(F.col("d.t")).alias("date"),
        F.col("d.p").cast("double").alias("precip_mm"),
    ).filter(F.col("date").isNotNull())


#: as text first, so that a value of another kind spoils its own day and not the file
_LOOSE_SCHEMA = "daily struct<time:array<string>,precipitation_sum:array<string>>, _corrupt string"


def read_weather_checked(spark: SparkSession, path: str, line_per_object: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(good, quarantined)``: the days of the weather JSON, and what could not be read as one.

    ``good`` is ``date, precip_mm``; a null precipitation stays null.  ``quarantined`` is ``file, position, day, value,
    reason``: an object that is no JSON of this shape as a whole (position null, its text as ``value``), a day that
    is no date, a value that is no finite number, and what has no partner where the arrays differ in length.  Each
    object is a file, or a line with ``line_per_object``.  Nothing raises for its contents; a missing file does.
    """
    raw = spark.read.text(path, wholetext=not line_per_object).select(
        "value", F.col("_metadata.file_name").alias("file"),
        F.from_json("value", _LOOSE_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("j"))
    if line_per_object:
        raw = raw.filter(F.trim("value") != "")
    times, values = F.col("j.daily.time"), F.col("j.daily.precipitation_sum")
    unreadable = F.col("j").isNull() | F.col("j._corrupt").isNotNull() | times.isNull() | values.isNull()
    broken = raw.filter(unreadable).select("file", F.lit(None).cast("int").alias("position"), F.lit(None).cast("string").alias("day"), "value",
                                           F.lit("unreadable object").alias("reason"))
    days = raw.filter(~unreadable).select("file", F.size(times).alias("n_days"), F.size(values).alias("n_values"),
                                          F.posexplode(F.arrays_zip(times.alias("t"), values.alias("v"))).alias("position", "d"))
    date, number = F.to_date(F.try_to_timestamp(F.col("day"), F.lit("yyyy-MM-dd"))), F.expr("try_cast(value AS DOUBLE)")
    reason = (F.when(F.col("position") >= F.col("n_days"), "no day for the value").when(F.col("position") >= F.col("n_values"), "no value for the day")
              .when(date.isNull(), "day is no date")
              .when(F.col("value").isNotNull() & ~F.coalesce(F.abs(number) < float("inf"), F.lit(False)), "value is no number"))
    judged = days.select("file", "position", F.col("d.t").alias("day"), F.col("d.v").alias("value"), "n_days", "n_values") \
        .withColumn("reason", reason).withColumns({"date": date, "precip_mm": number})
    bad = judged.filter(F.col("reason").isNotNull()).select("file", "position", "day", "value", "reason")
    return judged.filter(F.col("reason").isNull()).select("date", "precip_mm"), broken.unionByName(bad)


def read_report_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """A published report, or ``None`` when it was never written."""
    if not path_exists(spark, path):
        return None
    return spark.read.schema(schema).option("header", "true").csv(path)


def read_scalar(spark: SparkSession, path: str) -> str | None:
    """The one text value of a scalar report (e.g. a correlation written as ``%.4f``)."""
    if not path_exists(spark, path):
        return None
    rows = spark.read.text(path).limit(1).collect()
    text = rows[0][0].strip() if rows and rows[0][0] is not None else ""
    return text or None  # an undefined value (e.g. a null correlation) is written empty

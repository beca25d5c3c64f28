"""Lookup joins, SQL table functions, the weather quarantine and order-free sums."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from cordon.functions.exact import exact_avg, exact_corr, exact_ols, exact_sum
from cordon.operators.lookup import lookup_join
from cordon.operators.reports import surcharge_leakage, suspicious_vendors
from cordon.plans.registry import Inputs
from cordon.plans.views import register_functions
from cordon.sources.files import read_weather_checked

from conftest import SF_MID


def plan_of(spark, df, mode="formatted"):
    return spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


# ------------------------------------------------------------------------ lookup

def test_lookup_defaults(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (9, "d"), (1, "e")], "k long, x string")
    dim = spark.createDataFrame([(1, "one", 1.5), (2, None, 2.5), (None, "null", 0.0), (None, "again", 0.0)], "id long, name string, v double")
    want = {("a", "one", 1.5), ("b", "none", 2.5), ("c", "none", -1.0), ("d", "none", -1.0), ("e", "one", 1.5)}
    for limit in (8 << 20, 0):
        got = lookup_join(df, dim, {"k": "id"}, {"name": "none", "v": -1.0}, limit)
        assert {tuple(r)[1:] for r in got.collect()} == want and got.count() == 5
        assert ("BroadcastHashJoin" in plan_of(spark, got)) == (limit > 0)
    assert lookup_join(df, dim.limit(0), {"k": "id"}, {"name": "none"}).filter("name = 'none'").count() == 5


def test_lookup_refuses_duplicates_and_clashes(spark):
    df = spark.createDataFrame([(1, "a")], "k long, name string")
    dim = spark.createDataFrame([(1, 2, "x"), (1, 2, "y"), (1, 3, "z")], "id long, part long, name string")
    with pytest.raises(ValueError, match=r"\(1, 2\) 2 times"):
        lookup_join(df.drop("name").withColumn("p", F.lit(2)), dim, {"k": "id", "p": "part"}, {"name": "-"})
    with pytest.raises(ValueError, match="already there"):
        lookup_join(df, dim, {"k": "id"}, {"name": "-"})


def test_lookup_of_a_hot_key(spark):
    """A third of the rows share a key, a third have none; a dimension beyond the limit is joined by a shuffle."""
    df = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id")).cast("long").alias("k"))
    dim = spark.range(5_000).select(F.col("id").alias("d"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    got = lookup_join(df, dim, {"k": "d"}, {"name": "?"}, limit=0)
    counts = {r["name"]: r["count"] for r in got.groupBy("name").count().collect()}
    assert counts["n7"] == 10_000 and got.count() == 30_000 and "SortMergeJoin" in plan_of(spark, got)


# --------------------------------------------------------------------- functions

def test_sql_functions_equal_the_operators(spark):
    i = Inputs(spark, SF_MID)
    i.flagged.createOrReplaceTempView("flagged_for_functions")
    assert register_functions(spark, "flagged_for_functions", i.spec, "f_") == ["f_leakage", "f_vendors", "f_volume"]
    rows = lambda df: [tuple(r) for r in df.collect()]
    assert rows(spark.sql("SELECT * FROM f_leakage()")) == rows(surcharge_leakage(i.clean, i.spec)) != []
    other = i.spec.with_(zone_ids=tuple(range(1, 120)), policy_start="2000-03-01", top_leakage=7)
    got = spark.sql("SELECT * FROM f_leakage(zones => sequence(1L, 119L), since => TIMESTAMP_NTZ '2000-03-01 00:00:00', top => 7)")
    assert rows(got) == rows(surcharge_leakage(i.clean, other)) and len(rows(got)) == 7
    assert rows(spark.sql("SELECT * FROM f_vendors(2)")) == rows(suspicious_vendors(i.log, i.spec.with_(top_vendors=2)))
    n = i.clean.filter("pickup_time >= '2000-02-01' AND pickup_time < '2000-03-01' AND (pickup_loc = 4 OR dropoff_loc = 4)").count()
    assert rows(spark.sql("SELECT * FROM f_volume(array(4), TIMESTAMP_NTZ '2000-02-01 00:00:00', TIMESTAMP_NTZ '2000-03-01 00:00:00')")) == [(n,)]


def test_sql_function_plans_like_the_operator(spark):
    """The same columns are read and the same filters pushed as by the DataFrame."""
    i = Inputs(spark, SF_MID)
    i.flagged.createOrReplaceTempView("flagged_for_plans")
    register_functions(spark, "flagged_for_plans", i.spec, "p_")
    line = lambda df, name: sorted({x for x in plan_of(spark, df).splitlines() if x.startswith(name)})
    sql, frame = spark.sql("SELECT * FROM p_leakage()"), surcharge_leakage(i.clean, i.spec)
    pushed = lambda df: {f for x in line(df, "PushedFilters") for f in re.findall(r"\w+\([^)]*\)", x)}
    assert line(sql, "ReadSchema") == line(frame, "ReadSchema") and pushed(frame) <= pushed(sql)
    assert plan_of(spark, sql).count("Scan parquet") == plan_of(spark, frame).count("Scan parquet")


# ------------------------------------------------------------------------ weather

def test_weather_quarantine(spark, scratch):
    import os

    os.makedirs(f"{scratch}/w")
    files = {
        "a.json": '{"daily": {"time": ["2024-01-01", "2024-01-02", "2024-13-01", null, "2024-01-05", "2024-01-06"],'
                  ' "precipitation_sum": [1.5, null, 2, 3, "n/a", "NaN"]}}',
        "b.json": '{"daily": {"time": ["2024-02-01", "2024-02-02"], "precipitation_sum": [0]}}',
        "c.json": '{"daily": {"time": ["2024-03-01"], "precipitation_sum": [4, 5]}}',
        "d.json": '{"daily": {"time": ["2024-04-01"], "prec', "e.json": "[]", "f.json": '{"hourly": 1}', "g.json": "",
        "h.json": '{"daily": {"time": [], "precipitation_sum": []}}',
    }
    for name, text in files.items():
        with open(f"{scratch}/w/{name}", "w") as f:
            f.write(text)
    good, bad = read_weather_checked(spark, f"{scratch}/w")
    assert {(str(r.date), r.precip_mm) for r in good.collect()} == {
        ("2024-01-01", 1.5), ("2024-01-02", None), ("2024-02-01", 0.0), ("2024-03-01", 4.0)}
    got = {(r.file, r.position, r.reason) for r in bad.collect() if r.file != "g.json"}  # an empty file may be no object at all
    assert got == {
        ("a.json", 2, "day is no date"), ("a.json", 3, "day is no date"), ("a.json", 4, "value is no number"), ("a.json", 5, "value is no number"),
        ("b.json", 1, "no value for the day"), ("c.json", 1, "no day for the value"), ("d.json", None, "unreadable object"),
        ("e.json", None, "unreadable object"), ("f.json", None, "unreadable object")}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_weather_checked(spark, f"{scratch}/none")


# ---------------------------------------------------------------------- exact sums

def bits(row):
    return [None if v is None else v.hex() if isinstance(v, float) else v for v in row]


def test_sums_do_not_depend_on_partitions(spark):
    rng = random.Random(9)
    rows = [(rng.choice([1e-9, 1.0, 1e6]) * rng.uniform(-1, 1), rng.gauss(50, 7)) for _ in range(3000)]
    rows += [(None, 1.0), (2.0, None)]
    df = spark.createDataFrame(rows, "x double, y double")
    aggregates = [exact_sum(F.col("x")).alias("s"), exact_avg(F.col("y")).alias("a"), exact_corr("y", "x").alias("c"), *exact_ols("y", "x")]
    results = [bits(df.orderBy(order).repartition(n).agg(*aggregates).first()) for n in (1, 7, 200) for order in ("x", "y")]
    assert all(r == results[0] for r in results)
    both = [(x, y) for x, y in rows if x is not None and y is not None]
    s, a, c, slope, intercept, r2 = df.agg(*aggregates).first()
    assert s == pytest.approx(math.fsum(x for x, _ in rows if x is not None), abs=1e-6)
    mx, my = math.fsum(x for x, _ in both) / len(both), math.fsum(y for _, y in both) / len(both)
    sxx, sxy, syy = (math.fsum(v) for v in zip(*[((x - mx) ** 2, (x - mx) * (y - my), (y - my) ** 2) for x, y in both]))
    assert (c, slope, intercept, r2) == pytest.approx((sxy / math.sqrt(sxx * syy), sxy / sxx, my - sxy / sxx * mx, sxy ** 2 / sxx / syy), rel=1e-6)


def test_exact_sums_of_odd_values(spark):
    df = lambda *v: spark.createDataFrame([(x,) for x in v], "x double")
    value = lambda d, f: d.agg(f(F.col("x")).alias("v")).first().v
    assert value(df(), exact_sum) is None and value(df(None), exact_avg) is None
    assert math.isnan(value(df(1.0, float("nan")), exact_sum)) and math.isnan(value(df(1.0, float("inf")), exact_avg))
    assert value(df(0.1, 0.2, None), exact_sum) == 0.3
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert tuple(flat.agg(exact_corr("y", "x"), *exact_ols("y", "x")).first()) == (None, None, None, None)

"""The driver contract of __spark_entry__."""

from pyspark.sql import DataFrame

import __spark_entry__ as E
from cordon.plans.registry import registry

from conftest import SF_SMALL


def test_entry_schema_is_stable(spark):
    a, b = E.entry(spark), E.entry(spark)
    assert isinstance(a, DataFrame)
    assert a.schema == b.schema
    assert [f.name for f in a.schema.fields] == ["pickup_loc", "trip_count", "compliance_rate", "missing_surcharge_hits"]


def test_queries_and_oracles_align(spark):
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs) and set(registry()) <= set(sqls)
    for name, fn in registry().items():
        df = fn(spark, SF_SMALL)
        assert isinstance(df, DataFrame), name
        assert len(set(df.columns)) == len(df.columns), name
        assert all(not c.startswith("(") and "(" not in c for c in df.columns), name  # every column aliased

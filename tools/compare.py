"""Order-insensitive comparison of a Spark result with a DuckDB oracle result."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def canonical(cols, rows) -> Counter:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> tuple[bool, str]:
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    if sorted(df.columns) != sorted(ocols):
        return False, f"columns differ: {df.columns} vs {ocols}"
    a, b = canonical(df.columns, srows), canonical(ocols, orows)
    if a != b:
        return False, (f"rows {len(srows)} vs {len(orows)}; only spark {list((a - b).elements())[:3]}; "
                       f"only oracle {list((b - a).elements())[:3]}")
    return True, f"{len(srows)} rows"

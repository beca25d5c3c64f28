"""Benchmark: every registered query plus the end-to-end audit run.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is executed in full through the ``noop`` sink (no collect to the driver).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))


HEADLINE = (
    "unify_feeds", "missing_periods", "impute_month", "impute_month_green", "flag_trips", "audit_log",
    "clean_trips", "flag_stats", "surcharge_leakage", "period_volumes", "suspicious_vendors",
    "border_effect", "velocity_before", "velocity_after", "tip_crowding", "rain_daily",
    "rain_elasticity", "rain_trend", "velocity_grid_before", "velocity_grid_after", "border_geo",
    "volume_change_kpi",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from cordon.plans.audit_run import run_audit
    from cordon.plans.registry import Inputs, registry
    from cordon.session import local_session, scratch_path

    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="cordon-bench")
    queries = registry()

    # warm-up: JVM JIT and file-system caches, not timed
    for name in ("flag_stats", "border_effect", "rain_daily"):
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in sorted(queries):
        t0 = time.perf_counter()
        try:
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # keep timing the rest; the failure is reported
            errors[name] = str(exc).splitlines()[0][:200]

    i = Inputs(spark, sf_dir)
    out = scratch_path(spark, "bench-exports")  # under the session's shared folder
    t0 = time.perf_counter()
    try:
        run_audit(spark, i.raw_feeds, i.baseline_raw, i.weather, i.spec, out)
        pipeline = round(time.perf_counter() - t0, 3)
    except Exception as exc:
        pipeline = None
        errors["pipeline"] = str(exc).splitlines()[0][:200]

    m = re.search(r"sf([0-9.]+)", sf_dir)
    headline = round(sum(times[q] for q in HEADLINE if q in times), 3)
    print(json.dumps({
        "metric": "headline_query_sec",
        "value": headline,
        "all_queries_sec": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "pipeline_sec": pipeline,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

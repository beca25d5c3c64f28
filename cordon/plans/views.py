"""SQL surface: the audit's relations as temporary views.

Users who query views by name can keep doing so with ``spark.sql``; Catalyst plans
the SQL exactly like the DataFrame operators (same pushdown and pruning).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cordon.operators import audit_log, clean_trips, flag_trips, surcharge_leakage, unify_feeds
from cordon.spec import AuditSpec


def register_views(spark: SparkSession, raw_feeds: dict[str, DataFrame], baseline_raw: DataFrame | None = None,
                   audited: DataFrame | None = None, prefix: str = "", spec: AuditSpec = AuditSpec()) -> dict[str, DataFrame]:
    """Create or replace ``trips_raw``, ``audit_results``, ``audit_log``, ``clean_trips``
    (and ``baseline_raw``).  ``audited`` may be a materialised flagged table."""
    trips = unify_feeds(raw_feeds)
    flagged = audited if audited is not None else flag_trips(trips, spec)
    views = {
        "trips_raw": trips,
        "audit_results": flagged,
        "audit_log": audit_log(flagged),
        "clean_trips": clean_trips(flagged),
    }
    if baseline_raw is not None:
        views["baseline_raw"] = baseline_raw
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return views


def register_leakage_view(spark: SparkSession, spec: AuditSpec, source: str = "clean_trips", name: str = "leakage_report") -> DataFrame:
    """The leakage report as a view of its own over ``clean_trips``, so that SQL users read the same
    definition as everyone else: ``SELECT * FROM leakage_report``."""
    report = surcharge_leakage(spark.table(source), spec)
    report.createOrReplaceTempView(name)
    return report


def register_functions(spark: SparkSession, source: str, spec: AuditSpec = AuditSpec(), prefix: str = "") -> list[str]:
    """Reports as SQL table functions over the flagged trips in the view or table ``source``, with parameters:

    ``SELECT * FROM leakage(zones => array(4, 12), since => TIMESTAMP_NTZ '2025-02-01 00:00:00', top => 10)``

    What is left out is the spec's value.  Spark puts the function's body in place of the call, so filters on its
    result are pushed down and the scan is pruned as in any query.  Returns the functions' names.
    """
    zones = f"array({', '.join(f'CAST({z} AS BIGINT)' for z in spec.zone_ids)})" if spec.zone_ids else "CAST(array() AS ARRAY<BIGINT>)"
    since = f"TIMESTAMP_NTZ '{spec.policy_start} 00:00:00'"
    functions = {
        "leakage": (f"zones ARRAY<BIGINT> DEFAULT {zones}, since TIMESTAMP_NTZ DEFAULT {since}, top INT DEFAULT {spec.top_leakage}",
                    "pickup_loc BIGINT, trip_count BIGINT, compliance_rate DOUBLE, missing_surcharge_hits BIGINT", f"""
SELECT pickup_loc, trip_count, compliance_rate, missing_surcharge_hits FROM (
  SELECT *, row_number() OVER (ORDER BY missing_surcharge_hits DESC, pickup_loc ASC NULLS LAST) AS place FROM (
    SELECT pickup_loc, count(*) AS trip_count, avg(CASE WHEN congestion_surcharge > 0 THEN 1 ELSE 0 END) AS compliance_rate,
           count_if(congestion_surcharge = 0) AS missing_surcharge_hits
    FROM {source} WHERE forensic_flag IS NULL AND pickup_time >= leakage.since
      AND NOT array_contains(leakage.zones, pickup_loc) AND array_contains(leakage.zones, dropoff_loc)
    GROUP BY pickup_loc)) WHERE place <= leakage.top"""),
        "vendors": (f"top INT DEFAULT {spec.top_vendors}", "VendorID BIGINT, forensic_flag STRING, ghost_count BIGINT", f"""
SELECT VendorID, forensic_flag, ghost_count FROM (
  SELECT *, row_number() OVER (ORDER BY ghost_count DESC, VendorID ASC NULLS LAST, forensic_flag) AS place FROM (
    SELECT VendorID, forensic_flag, count(*) AS ghost_count FROM {source} WHERE forensic_flag IS NOT NULL GROUP BY VendorID, forensic_flag))
WHERE place <= vendors.top"""),
        "volume": (f"zones ARRAY<BIGINT> DEFAULT {zones}, since TIMESTAMP_NTZ DEFAULT {since}, until TIMESTAMP_NTZ DEFAULT NULL",
                   "volume BIGINT", f"""
SELECT count(*) AS volume FROM {source} WHERE forensic_flag IS NULL AND pickup_time >= volume.since
  AND (volume.until IS NULL OR pickup_time < volume.until)
  AND (array_contains(volume.zones, pickup_loc) OR array_contains(volume.zones, dropoff_loc))"""),
    }
    for name, (parameters, columns, body) in functions.items():
        full = prefix + name
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {full}({parameters}) RETURNS TABLE ({columns}) RETURN {body.replace(f'{name}.', f'{full}.')}")
    return [prefix + name for name in functions]

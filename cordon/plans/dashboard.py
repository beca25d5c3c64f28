"""Dashboard data: read the published reports back and derive what the dashboard shows.

The reference's dashboard is a separate process that reads the exported CSVs (absent
file -> nothing shown), pivots the speed reports, looks up map coordinates, computes the
volume KPI and fits a trendline.  These functions do the same from the files with
declared schemas (no inference), so the dashboard side needs no access to the trip data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cordon.operators import border_geo, rain_trend, velocity_grid, volume_change_kpi, volume_change_text
from cordon.sources.files import read_report_csv, read_scalar
from cordon.spec import AuditSpec

REPORT_SCHEMAS = {
    "leakage": "pickup_loc long, trip_count long, compliance_rate double, missing_surcharge_hits long",
    "volumes": "period string, volume long",
    "vendors": "VendorID long, forensic_flag string, ghost_count long",
    "border": "loc_id long, count_24 long, count_25 long, change_rate double",
    "velocity_before": "hour long, dow string, speed double",
    "velocity_after": "hour long, dow string, speed double",
    "tips": "month long, avg_surcharge double, avg_tip_pct double",
    "rain_daily": "date date, daily_trips long, precip_mm double",
}


def load_reports(spark: SparkSession, out_dir: str) -> dict[str, DataFrame | None]:
    out = out_dir.rstrip("/")
    return {name: read_report_csv(spark, f"{out}/{name}.csv", schema) for name, schema in REPORT_SCHEMAS.items()}


def dashboard_tables(spark: SparkSession, out_dir: str, spec: AuditSpec) -> dict[str, DataFrame | str | None]:
    """Map points, both speed grids, the KPI with display text, the trendline and the
    correlation text; each is ``None`` when its source report is absent."""
    r = load_reports(spark, out_dir)
    return {
        "border_map": border_geo(r["border"], spec) if r["border"] is not None else None,
        "grid_before": velocity_grid(r["velocity_before"]) if r["velocity_before"] is not None else None,
        "grid_after": velocity_grid(r["velocity_after"]) if r["velocity_after"] is not None else None,
        "volume_kpi": volume_change_text(volume_change_kpi(r["volumes"], spec)) if r["volumes"] is not None else None,
        "rain_trend": rain_trend(r["rain_daily"]) if r["rain_daily"] is not None else None,
        "rain_stats": read_scalar(spark, f"{out_dir.rstrip('/')}/rain_stats.txt"),
        "leakage": r["leakage"],
        "vendors": r["vendors"],
        "tips": r["tips"],
    }

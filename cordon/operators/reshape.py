"""Report reshapes done by the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordon.spec import AuditSpec

HOURS = list(range(24))


def hour_column(h: int) -> str:
    return f"h{h:02d}"


def velocity_grid(speeds: DataFrame) -> DataFrame:
    """Weekday x hour matrix of speeds (``h00`` .. ``h23``); a missing cell is null.

    The long report holds one row per (hour, weekday), at most 168 rows, so the pivot is
    one conditional aggregation by weekday: one tiny shuffle, no pivot-value job.
    Rows come out sorted by weekday name.
    """
    cells = [F.max(F.when(F.col("hour") == h, F.col("speed"))).alias(hour_column(h)) for h in HOURS]
    return speeds.groupBy("dow").agg(*cells).orderBy("dow")


def _coordinate(spec: AuditSpec, index: int):
    default = F.lit(float(spec.default_coord[index]))
    if not spec.zone_coords:
        return default
    pairs = []
    for loc, coord in spec.zone_coords.items():
        pairs += [F.lit(loc).cast("bigint"), F.lit(float(coord[index]))]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col("loc_id").cast("bigint")), default)


def border_geo(border: DataFrame, spec: AuditSpec = AuditSpec()) -> DataFrame:
    """Border report with the spec's map coordinates; unknown zones get its default point.

    The coordinates are a lookup of a few entries, so they travel inside the plan as map
    literals: a per-row hash lookup with no join, no broadcast and no Python data.
    """
    return border.select(*border.columns, _coordinate(spec, 0).alias("lat"), _coordinate(spec, 1).alias("lon"))


def volume_change_kpi(volumes: DataFrame, spec: AuditSpec) -> DataFrame:
    """Baseline and analysis volumes side by side, % change and the trip difference."""
    wide = volumes.agg(
        F.max(F.when(F.col("period") == spec.baseline_label, F.col("volume"))).alias("v_before"),
        F.max(F.when(F.col("period") == spec.analysis_label, F.col("volume"))).alias("v_after"),
    )
    pct = (F.col("v_after") - F.col("v_before")).cast("double") / F.nullif(F.col("v_before"), F.lit(0)) * F.lit(100.0)
    return wide.select(
        "v_before", "v_after", pct.alias("pct_change"), (F.col("v_before") - F.col("v_after")).alias("delta"),
    )


def volume_change_text(kpi: DataFrame) -> DataFrame:
    """The KPI row plus display text: percent with one decimal (``-12.5%``) and the trip
    difference with thousands separators (``1,234 trips``)."""
    return kpi.withColumns({
        "pct_label": F.when(F.col("pct_change").isNull(), F.lit(None))
        .otherwise(F.format_string("%.1f%%", F.col("pct_change"))),
        "delta_label": F.concat(F.format_number(F.col("delta"), 0), F.lit(" trips")),
    })

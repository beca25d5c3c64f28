"""Composite operators: each is ``(DataFrame(s), AuditSpec) -> DataFrame``."""

from cordon.operators.flags import audit_log, clean_trips, flag_stats, flag_trips
from cordon.operators.impute import impute_month
from cordon.operators.reports import (
    border_effect,
    period_volumes,
    surcharge_leakage,
    suspicious_vendors,
    tip_crowding,
    velocity,
    velocity_after,
    velocity_before,
)
from cordon.operators.reshape import border_geo, velocity_grid, volume_change_kpi, volume_change_text
from cordon.operators.unify import (
    TRIP_COLUMNS,
    missing_periods,
    observed_periods,
    raw_to_trips,
    unify_feeds,
)
from cordon.operators.weather import daily_trips, rain_daily, rain_elasticity, rain_trend

__all__ = [
    "audit_log", "clean_trips", "flag_stats", "flag_trips", "impute_month",
    "border_effect", "period_volumes", "surcharge_leakage", "suspicious_vendors", "tip_crowding",
    "velocity", "velocity_after", "velocity_before",
    "border_geo", "velocity_grid", "volume_change_kpi", "volume_change_text",
    "TRIP_COLUMNS", "missing_periods", "observed_periods", "raw_to_trips", "unify_feeds",
    "daily_trips", "rain_daily", "rain_elasticity", "rain_trend",
]

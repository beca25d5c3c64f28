"""Audit parameters.

The reference hard-codes its analysis year, policy date, zone lists and thresholds;
here they live in one frozen dataclass so that every operator is a pure function of
``(DataFrame, AuditSpec)``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's for identical results:
# zone ids of the priced zone, ids of the zones along its border, flag labels,
# flag thresholds, and the map coordinates used by the border report.
# ---------------------------------------------------------------------------
ZONE_IDS: tuple[int, ...] = (
    4, 12, 13, 43, 45, 48, 50, 68, 79, 87, 88, 90, 100, 103, 104, 105, 107, 113, 114,
    125, 137, 140, 141, 142, 143, 144, 148, 158, 161, 162, 163, 164, 170, 186, 209,
    211, 224, 229, 230, 231, 232, 233, 234, 236, 237, 238, 239, 246, 249, 261, 262, 263,
)
BORDER_IDS: tuple[int, ...] = (236, 237, 238, 239, 140, 141, 142, 143, 262, 263)

FLAG_SPEED = "Impossible Physics"
FLAG_TELEPORT = "Teleporter"
FLAG_STATIONARY = "Stationary Ride"

MAX_SPEED_MPH = 65
MIN_DURATION_SEC = 60
TELEPORT_MIN_FARE = 20

ZONE_COORDS: dict[int, tuple[float, float]] = {
    236: (40.77, -73.95), 237: (40.76, -73.96), 238: (40.79, -73.97), 239: (40.78, -73.98),
    140: (40.76, -73.96), 141: (40.77, -73.96), 142: (40.77, -73.98), 143: (40.78, -73.99),
}
DEFAULT_COORD: tuple[float, float] = (40.75, -73.98)

FEEDS: tuple[str, ...] = ("yellow", "green")
# pickup / dropoff column names of each feed's raw files
FEED_TIME_COLUMNS: dict[str, tuple[str, str]] = {
    "yellow": ("tpep_pickup_datetime", "tpep_dropoff_datetime"),
    "green": ("lpep_pickup_datetime", "lpep_dropoff_datetime"),
}


@dataclass(frozen=True)
class Donor:
    """One donor period for imputation: ``years_back`` earlier, sampled at ``fraction``."""

    years_back: int
    fraction: float


@dataclass(frozen=True)
class AuditSpec:
    analysis_year: int = 2025
    policy_start: str = "2025-01-05"
    # closed range ``BETWEEN q1_start AND q1_end``; the end is a midnight timestamp,
    # so the last day is (almost) excluded, as in the reference.  ``half_open``
    # switches to ``>= start AND < end + 1 day``.
    q1_start: str = "2025-01-01"
    q1_end: str = "2025-03-31"
    half_open: bool = False
    # baseline: by default one month (January) of one feed, as the reference; the
    # like-for-like option takes the same months and feeds as the analysis Q1
    baseline_feed: str = "yellow"
    baseline_year: int = 2024
    baseline_month: int = 1
    baseline_last_month: int | None = None
    baseline_feeds: tuple[str, ...] | None = None
    # audit the baseline with the same flag rule before speed / volume reports
    audit_baseline: bool = False
    # border report: the analysis side covers every clean trip (as the reference) unless
    # bounded to pickups in [border_start, border_end)
    border_start: str | None = None
    border_end: str | None = None
    zone_ids: tuple[int, ...] = ZONE_IDS
    border_ids: tuple[int, ...] = BORDER_IDS
    feeds: tuple[str, ...] = FEEDS
    # imputation of a missing month from earlier years (row mixture); ``impute_only``
    # limits which absent months are rebuilt: December alone by default, other gaps stay
    # gaps, so a year in progress can be audited; None rebuilds any absent month
    impute_month: int = 12
    impute_only: tuple[int, ...] | None = (12,)
    donors: tuple[Donor, ...] = field(default_factory=lambda: (Donor(2, 0.3), Donor(1, 0.7)))
    # shift donors by whole years (reference) or by 364 days per year, which keeps the
    # weekday; with the latter the donor window is the target month moved back as much
    align_weekdays: bool = False
    top_leakage: int = 3
    top_vendors: int = 5
    # flag rule
    max_speed_mph: float = MAX_SPEED_MPH
    min_duration_sec: float = MIN_DURATION_SEC
    teleport_min_fare: float = TELEPORT_MIN_FARE
    # map points of the border report
    zone_coords: Mapping[int, tuple[float, float]] = field(default_factory=lambda: dict(ZONE_COORDS))
    default_coord: tuple[float, float] = DEFAULT_COORD

    @property
    def baseline_label(self) -> str:
        return f"{self.baseline_year}_Q1"

    @property
    def analysis_label(self) -> str:
        return f"{self.analysis_year}_Q1"

    @property
    def baseline_feed_list(self) -> tuple[str, ...]:
        return self.baseline_feeds or (self.baseline_feed,)

    @property
    def baseline_periods(self) -> list[tuple[int, int]]:
        last = self.baseline_last_month or self.baseline_month
        return [(self.baseline_year, m) for m in range(self.baseline_month, last + 1)]

    def like_for_like(self) -> "AuditSpec":
        """Baseline = the same quarter months and feeds one year earlier."""
        return replace(self, baseline_month=1, baseline_last_month=3, baseline_feeds=self.feeds)

    def with_(self, **kw) -> "AuditSpec":
        return replace(self, **kw)


def fixture_spec() -> AuditSpec:
    """Spec for trips derived from the TPC-H-like test tables (see FIXTURES.md §4)."""
    return AuditSpec(
        analysis_year=2000,
        policy_start="2000-01-05",
        q1_start="2000-01-01",
        q1_end="2000-03-31",
        baseline_feed="yellow",
        baseline_year=1999,
        baseline_month=1,
    )

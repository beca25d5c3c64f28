"""Sources: raw monthly feeds, table adapters and small file sources."""

from cordon.sources.feeds import (
    RAW_COLUMNS,
    feed_path,
    raw_schema,
    read_feed,
    read_feed_months,
)
from cordon.sources.files import read_report_csv, read_scalar, read_weather_json

__all__ = [
    "RAW_COLUMNS", "feed_path", "raw_schema", "read_feed", "read_feed_months",
    "read_report_csv", "read_scalar", "read_weather_json",
]

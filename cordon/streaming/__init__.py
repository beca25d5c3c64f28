"""Incremental flagging of monthly files as they land (Structured Streaming)."""

from cordon.streaming.incremental import (
    feed_table_path,
    read_incremental_table,
    start_incremental_audit,
    start_incremental_audits,
)

__all__ = ["feed_table_path", "read_incremental_table", "start_incremental_audit", "start_incremental_audits"]

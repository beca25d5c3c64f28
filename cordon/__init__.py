"""cordon: a Spark-native audit of trip records around a priced zone.

Layout:
  spec        -- AuditSpec, the constants every query is parameterised by
  session     -- session builder and the shared work folder
  sources/    -- feeds (parquet by path template), table adapters, file sources
  functions/  -- column expressions: time, zones, sampling, statistics
  operators/  -- composite DataFrame operators (unify, impute, flag, reports, ...)
  plans/      -- query registry, DuckDB oracle SQL, end-to-end audit run
  streaming/  -- incremental flagging of newly landed monthly files
"""

from cordon.spec import AuditSpec, fixture_spec

__all__ = ["AuditSpec", "fixture_spec"]

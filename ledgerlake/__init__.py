"""ledgerlake: change-data lake and banking analytics on Spark DataFrames.

Layout:
  functions/  column expressions (safe casts, ids, risk score, rule cascades)
  operators/  DataFrame operators (dedup, upsert, SCD2, ranking, joins, checks)
  sources/    change-event decoding, lake files, RAW landing, test fixtures
  plans/      the named datasets, reports and the pipeline run
  streaming/  Structured Streaming ingest and stream upserts
"""

from ledgerlake.context import RunContext

__all__ = ["RunContext"]

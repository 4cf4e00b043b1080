"""strata: layered, incremental keyed tables on plain parquet, built on PySpark.

Layers:
  operators/  pure DataFrame -> DataFrame semantics (precombine, upserts, versions, joins)
  sources/    scans, landing writer, file inventory, the keyed table on disk
  functions/  scalar helpers (JSON text, ISO timestamps, flags, key lists)
  plans/      user-level jobs: source loader, gold job, chained run, query registry
  streaming/  new-files ingest and gold on Structured Streaming, progress documents
"""

from strata.spec import TableSpec, as_bool

__all__ = ["TableSpec", "as_bool"]

"""lakeops: sales reports, a medallion ETL, an order stream and a ticket log,
written as plain Spark DataFrame jobs.

Layout:
  sources/    readers (parquet tables, JSON-lines logs, message streams)
  sinks/      writers (full refresh, insert-or-ignore, atomic snapshots, logs)
  functions/  column expressions (JSON decode, typed coercion, time tests)
  operators/  reusable relational pieces (first-per-key, top-k, audits, ...)
  plans/      the jobs users call (reports, medallion, ticket log, generator)
  streaming/  Structured Streaming forms of the order ingest and replica sync
"""

__version__ = "0.1.0"

"""marquee — recommendation data operators expressed as Spark DataFrame jobs.

Sub-packages:
  functions  column-expression kernels (vectors, text, fixed vocabulary)
  sources    file readers, input discovery, fixture views over the given tables
  operators  merges, validation, features, split, samples, retrieval, losses, lookups, metrics
  plans      registered queries and their DuckDB oracle SQL
  streaming  incremental ingest with Structured Streaming
"""

__all__ = ["functions", "sources", "operators", "plans", "streaming"]

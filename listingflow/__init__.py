"""listingflow: Spark jobs that turn stored listing pages into a typed, queryable table.

Layout:
  sources/    table readers, site registry, derived test views
  functions/  Column-expression builders (text normalisation) and the in-task HTML helper
  operators/  DataFrame operators: links, frontier, listing typing/validation, store, stats, enrichment
  plans/      the registered query catalogue and its DuckDB oracle SQL
  streaming/  Structured Streaming jobs (ingest, dedup, progress, routing)
"""

__version__ = "0.1.0"

"""Structured Streaming jobs: ingest, ingest+enrich+upsert, dedup, progress and routing."""

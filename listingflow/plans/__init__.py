"""The registered query catalogue and its DuckDB oracle SQL."""

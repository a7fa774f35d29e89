"""Readers for the given tables, the site registry and the derived test views."""

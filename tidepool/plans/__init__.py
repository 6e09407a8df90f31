"""Fixtures, registered analog queries, their DuckDB oracle, and end-to-end jobs."""

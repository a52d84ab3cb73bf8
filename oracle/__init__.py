"""Reference answers in plain SQL, run by DuckDB on the same tables."""

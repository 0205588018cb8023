"""Queries over the supplied Parquet tables and their DuckDB counterparts."""

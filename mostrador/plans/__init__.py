"""Star schema, reports, incremental window, table snapshots and the daily run."""

"""Retail analytics on Spark: landing, cleaning, keyed upserts, star schema, quality rules and reports."""

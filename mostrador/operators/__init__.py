"""Reusable DataFrame operators: last-record-wins, upsert, as-of join, quality rules, audit."""

"""Compare a query with its DuckDB counterpart: column names, row count and values, in any row order.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        return str(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(plain(row[i]) for i in order) for row in rows)


DUCK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


def type_differences(df, connection, sql: str) -> list[str]:
    """Columns whose types differ."""
    theirs = {row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()}
    ours = {name: DUCK_TYPES.get(kind, kind.upper()) for name, kind in df.dtypes}
    return [f"{n}: {kind} / {theirs.get(n)}" for n, kind in ours.items() if kind != theirs.get(n, "")]


def difference(df, connection, sql: str) -> str | None:
    """None when equal, else what differs."""
    types = type_differences(df, connection, sql)
    if types:
        return f"types {types}"
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    expected_names, expected = rows_of(names, cursor.fetchall())
    found_names, found = rows_of(df.columns, [tuple(row) for row in df.collect()])
    if found_names != expected_names:
        return f"columns {found_names} != {expected_names}"
    if found != expected:
        more, less = list((found - expected).items())[:3], list((expected - found).items())[:3]
        return f"{found.total()} rows, expected {expected.total()}; only here {more}; only there {less}"
    return None if found.total() else "no rows"


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from mostrador.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(queries())
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    for name in chosen:
        start = time.time()
        try:
            problem = difference(queries()[name](spark, sf_dir), connection, oracle_sql()[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if problem is None else 'DIFF'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)

"""Compare a registered query with its SQL oracle, as sorted rows with columns in name order."""

from __future__ import annotations

import math

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else f"{value:.9g}")
    if isinstance(value, bool):
        return (2, str(value))
    if isinstance(value, int):
        return (1, f"{float(value):.9g}")
    return (3, str(value))


def rows_in_name_order(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(canonical(row[i]) for i in order) for row in rows)


def difference(frame, con, sql) -> str | None:
    """None when equal, else a short account."""
    left = rows_in_name_order(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    right = rows_in_name_order([d[0] for d in cursor.description], cursor.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} / {len(right[1])}"
    for a, b in zip(left[1], right[1]):
        if a != b:
            return f"first difference\n  {a}\n  {b}"
    return None

"""Compare Spark results with the SQL counterparts in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return float(f"{value:.12g}")
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is not None, str(v)) for v in row))


def difference(df, con, sql: str) -> str | None:
    """What differs between a DataFrame and a SQL result, None if nothing."""
    rows = df.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    wanted = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(rows) != len(wanted):
        return f"{len(rows)} rows != {len(wanted)}"
    ours, theirs = _sorted_rows(df.columns, rows), _sorted_rows(names, wanted)
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None

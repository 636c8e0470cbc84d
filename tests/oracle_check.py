"""Compare queries with their SQL in DuckDB."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def differences(df, connection, sql: str) -> str | None:
    """None when both results have the same columns, types of values and rows."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    expected = [dict(zip(names, row)) for row in result.fetchall()]
    left = Counter(tuple(_plain(row[c]) for c in order) for row in df.collect())
    right = Counter(tuple(_plain(row[c]) for c in order) for row in expected)
    if left != right:
        only_left = list((left - right).elements())[:3]
        only_right = list((right - left).elements())[:3]
        return f"{order}: {sum(left.values())} rows != {sum(right.values())}; {only_left} != {only_right}"
    kinds = {c: {type(row[c]) for row in expected if row[c] is not None} for c in order}
    for row in left:
        for c, value in zip(order, row):
            if value is not None and kinds[c] and type(value) not in kinds[c]:
                return f"{c}: {type(value)} not in {kinds[c]}"
    return None

"""Compare a Spark result with the result of its SQL, value by value."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def compare(spark_df, sql: str, connection) -> list[str]:
    """Differences, empty if the two agree in columns, rows and values."""
    names = sorted(spark_df.columns)
    actual = Counter(tuple(_plain(row[n]) for n in names) for row in spark_df.collect())
    cursor = connection.execute(sql)
    found = [c[0] for c in cursor.description]
    if sorted(found) != names:
        return [f"columns {names} against {sorted(found)}"]
    order = [found.index(n) for n in names]
    expected = Counter(tuple(_plain(row[i]) for i in order) for row in cursor.fetchall())
    problems = []
    if actual != expected:
        problems.append(f"rows {sum(actual.values())} against {sum(expected.values())}")
        problems += [f"only Spark: {dict(zip(names, r, strict=True))}" for r in list(actual - expected)[:3]]
        problems += [f"only SQL:   {dict(zip(names, r, strict=True))}" for r in list(expected - actual)[:3]]
    return problems

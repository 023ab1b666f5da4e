"""Compare a Spark query with its SQL counterpart, as multisets of typed rows."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else ("f", value)
    if isinstance(value, Decimal):
        return ("dec", str(value))
    if isinstance(value, datetime):
        return ("ts", value.replace(tzinfo=None).isoformat())
    if isinstance(value, date):
        return ("date", value.isoformat())
    return (type(value).__name__, value)


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> list[str]:
    """Differences between the two results; an empty list means equal."""
    found = con.execute(sql)
    sql_columns = [d[0] for d in found.description]
    problems = []
    if sorted(df.columns) != sorted(sql_columns):
        return [f"columns {sorted(df.columns)} != {sorted(sql_columns)}"]
    expected = rows_of(sql_columns, found.fetchall())
    actual = rows_of(df.columns, df.collect())
    if sum(actual.values()) == 0:
        problems.append("no rows")
    missing, extra = expected - actual, actual - expected
    if missing or extra:
        problems.append(
            f"{sum(actual.values())} vs {sum(expected.values())} rows; "
            f"missing {list(missing.items())[:2]}; extra {list(extra.items())[:2]}"
        )
    return problems

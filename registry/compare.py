"""Compare a Spark result with its DuckDB counterpart, ignoring row order."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pandas as pd


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value: object) -> str:
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value))
    if isinstance(value, pd.Timestamp):
        return str(value)
    return str(value)


def rows_of(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    columns = sorted(frame.columns)
    data = [[_plain(v) for v in frame[c].astype(object)] for c in columns]
    return sorted(zip(*data))


def difference(spark_frame: pd.DataFrame, duck_frame: pd.DataFrame) -> str | None:
    """None where both hold the same rows, else a short account of what differs."""
    if sorted(spark_frame.columns) != sorted(duck_frame.columns):
        return f"columns {sorted(spark_frame.columns)} vs {sorted(duck_frame.columns)}"
    left, right = rows_of(spark_frame), rows_of(duck_frame)
    if len(left) != len(right):
        return f"{len(left)} rows vs {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        return f"{len(wrong)} rows differ, first {wrong[0]}"
    return None

"""Runs the oracle SQL in DuckDB and compares it with a Spark result."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _sorted(frame: pd.DataFrame) -> pd.DataFrame:
    columns = sorted(frame.columns)
    return frame[columns].sort_values(columns, ignore_index=True)


def differences(spark_result, con, sql: str) -> str | None:
    """What differs, or None."""
    theirs = con.execute(sql).df()
    ours = spark_result.toPandas()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    if ours.empty:
        return None
    try:
        pd.testing.assert_frame_equal(_sorted(ours), _sorted(theirs), check_dtype=True)
    except AssertionError as problem:
        return str(problem)
    return None

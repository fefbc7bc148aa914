"""Compare a Spark result with a DuckDB result, order and column order aside."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def cell(v) -> str:
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return repr(int(v)) if v.is_integer() and abs(v) < 1e15 else repr(v)
    return str(v)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted(tuple(cell(r[n]) for n in names) for r in df.collect())


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    names = sorted(columns)
    at = [columns.index(n) for n in names]
    return names, sorted(tuple(cell(r[i]) for i in at) for r in cursor.fetchall())


def difference(df, con, sql: str) -> str | None:
    """None if equal, else a short account."""
    names, ours = spark_rows(df)
    expected_names, theirs = duck_rows(con, sql)
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if ours == theirs:
        return None
    extra, missing = sorted(set(ours) - set(theirs)), sorted(set(theirs) - set(ours))
    return (
        f"{names}\nrows {len(ours)} != {len(theirs)}; only in spark ({len(extra)}): {extra[:4]}; "
        f"only in sql ({len(missing)}): {missing[:4]}"
    )

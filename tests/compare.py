"""Compare a query with its SQL on a second engine."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(x) -> str:
    if x is None or x is pd.NA or x != x:
        return "~"
    if isinstance(x, float):
        return repr(x)
    return str(x)


def rows(table: pd.DataFrame) -> list[tuple[str, ...]]:
    names = sorted(table.columns)
    return sorted(tuple(_key(x) for x in row) for row in table[names].astype(object).itertuples(index=False))


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str, limit: int = 3) -> list[str]:
    """What differs; empty where the results are alike."""
    names = sorted(spark_df.columns)
    mine = [tuple(_key(r[n]) for n in names) for r in spark_df.collect()]
    result = con.execute(sql)
    other_names = [c[0] for c in result.description]
    if sorted(other_names) != names:
        return [f"columns {names} and {sorted(other_names)}"]
    order = [other_names.index(n) for n in names]
    other = [tuple(_key(row[i]) for i in order) for row in result.fetchall()]
    if len(mine) != len(other):
        return [f"{len(mine)} rows and {len(other)}"]
    pairs = [(m, o) for m, o in zip(sorted(mine), sorted(other)) if m != o]
    return [str(dict((n, (x, y)) for n, x, y in zip(names, m, o) if x != y)) for m, o in pairs[:limit]]

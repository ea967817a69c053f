"""Side-by-side run of a Spark query and its SQL, order-insensitive."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        values = frame[c]
        if isinstance(values.dtype, pd.DatetimeTZDtype) or str(values.dtype).startswith("datetime"):
            frame[c] = values.dt.strftime("%Y-%m-%d")
        frame[c] = [None if pd.isna(v) else v for v in frame[c].astype(object)]
        if any(isinstance(v, float) for v in frame[c]):
            frame[c] = [None if v is None else float(v) for v in frame[c]]
        frame[c] = [str(v) for v in frame[c]]
    return frame.sort_values(list(frame.columns), ignore_index=True)


def differences(spark_df, con, sql: str) -> str | None:
    left, right = canonical(spark_df.toPandas()), canonical(con.execute(sql).df())
    if list(left.columns) != list(right.columns):
        return f"columns {list(left.columns)} != {list(right.columns)}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    unequal = (left != right).any(axis=1)
    if unequal.any():
        where = unequal.idxmax()
        return f"{int(unequal.sum())} rows differ, first:\n{left.loc[where].to_dict()}\n{right.loc[where].to_dict()}"
    return None

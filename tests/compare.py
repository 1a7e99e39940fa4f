"""Order-free comparison of a query with its SQL on the same tables."""

from __future__ import annotations

import os

import duckdb
import pandas as pd


def connection(sf_dir: str):
    c = duckdb.connect()
    for p in os.listdir(sf_dir):
        at = f"{sf_dir}/{p}"
        at = at + "/**/*.parquet" if os.path.isdir(at) else at
        c.sql(f"create view {p.split('.')[0]} as select * from '{at}'")
    return c


def canonical(frame: pd.DataFrame) -> list[tuple]:
    def one(v):
        if v is None or pd.api.types.is_scalar(v) and pd.isna(v):
            return "NULL"
        if isinstance(v, (float, int)) and not isinstance(v, bool):  # pandas makes floats of nullable integers
            return f"{v:.6f}"
        return repr(list(v)) if hasattr(v, "__iter__") and not isinstance(v, (str, bytes)) else str(v)

    names = sorted(frame.columns)
    return [tuple(names), *sorted(tuple(one(v) for v in row) for row in frame[names].itertuples(index=False))]


def check(spark, sf_dir: str, query, sql: str) -> None:
    got = canonical(query(spark, sf_dir).toPandas())
    want = canonical(connection(sf_dir).sql(sql).df())
    assert got == want

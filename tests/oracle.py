"""Comparing a query with its SQL the way the driver does: columns by name, rows in any order."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
import pyarrow as pa

from workload.tables import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return tuple(value) if isinstance(value, list) else value


def _rows(table: pa.Table) -> Counter:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return Counter(tuple(_plain(v) for v in row) for row in zip(*columns))


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else what differs."""
    got = df.toArrow()
    want = con.execute(sql).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {sorted(got.column_names)} != {sorted(want.column_names)}"
    mine, theirs = _rows(got), _rows(want)
    if mine != theirs:
        return (
            f"rows {got.num_rows} != {want.num_rows}; only here {list((mine - theirs).items())[:3]}; "
            f"only there {list((theirs - mine).items())[:3]}"
        )
    return None if got.num_rows else "empty"

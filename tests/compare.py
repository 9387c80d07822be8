"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def rows_of(table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(name).to_pylist() for name in names]
    return sorted(zip(*columns), key=repr)


def compare(df, connection, sql: str) -> None:
    got = df.toArrow()
    want = connection.sql(sql).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    kinds = {n: (str(got.schema.field(n).type), str(want.schema.field(n).type)) for n in got.column_names}
    differing = {n: k for n, k in kinds.items() if k[0] != k[1]}
    assert not differing, differing
    got_rows, want_rows = rows_of(got), rows_of(want)
    assert len(got_rows) == len(want_rows), (len(got_rows), len(want_rows))
    wrong = [pair for pair in zip(got_rows, want_rows) if pair[0] != pair[1]]
    assert not wrong, (len(wrong), wrong[:3])

"""Runs named queries and their SQL on one folder and compares whole results."""

from __future__ import annotations

from pathlib import Path

import duckdb


def sql_result(sql: str, base: str):
    con = duckdb.connect()
    for path in Path(base).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    table = con.sql(sql)
    kinds = dict(zip(table.columns, map(str, table.types), strict=True))
    return kinds, table.fetchall(), table.columns


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(row[i] for i in order) for row in rows]
    return sorted(plain, key=repr)


SPARK_TO_SQL = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def difference(df, sql: str, base: str) -> str | None:
    """None when both engines agree on columns, types and all rows."""
    kinds, rows, columns = sql_result(sql, base)
    ours = {f.name: SPARK_TO_SQL.get(f.dataType.simpleString()) for f in df.schema.fields}
    if ours != kinds:
        return f"schema {ours} != {kinds}"
    left = normal_rows(df.columns, [tuple(row) for row in df.collect()])
    right = normal_rows(columns, rows)
    if left != right:
        only = [(a, b) for a, b in zip(left, right) if a != b][:3]
        return f"{len(left)} rows against {len(right)}; first differences {only}"
    return None

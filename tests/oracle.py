"""Run a query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb
from pyspark.sql import DataFrame

_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _row(values) -> tuple:
    return tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in values)


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences in columns, types, number of rows and values; none if both agree."""
    names = sorted(df.columns)
    cursor = con.execute(sql)
    described = {d[0]: str(d[1]) for d in cursor.description}
    if sorted(described) != names:
        return [f"columns {names} / {sorted(described)}"]
    order = [d[0] for d in cursor.description]
    theirs = [dict(zip(order, row)) for row in cursor.fetchall()]
    problems = []
    for field in df.schema:
        expected = _TYPES.get(field.dataType.simpleString(), "?")
        if described[field.name] != expected:
            problems.append(f"type of {field.name}: {expected} / {described[field.name]}")
    key = lambda row: tuple((v is not None, str(type(v)), v) if v is not None else (False,) for v in row)
    ours = sorted((_row(r[n] for n in names) for r in df.collect()), key=key)
    expected_rows = sorted((_row(r[n] for n in names) for r in theirs), key=key)
    if len(ours) != len(expected_rows):
        problems.append(f"rows {len(ours)} / {len(expected_rows)}")
    different = [(a, b) for a, b in zip(ours, expected_rows) if a != b]
    if different:
        problems.append(f"{len(different)} rows differ, first {names}: {different[0]}")
    return problems

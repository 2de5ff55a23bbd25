"""Run a registered query on Spark and its SQL on DuckDB and compare the rows."""

from __future__ import annotations

import math
from collections.abc import Iterable
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def _plain(value: object) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def normalized(columns: list[str], rows: Iterable[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(
    result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str
) -> list[str]:
    """What differs in names, types, row count or values; empty when equal."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = normalized(names, cursor.fetchall())
    if sorted(names) != sorted(result.columns):
        return [f"columns {sorted(result.columns)} != {sorted(names)}"]
    found = normalized(result.columns, [tuple(r) for r in result.collect()])
    problems = []
    if len(found) != len(expected):
        problems.append(f"rows {len(found)} != {len(expected)}")
    if found != expected:
        unlike = [(f, e) for f, e in zip(found, expected) if f != e]
        problems.append(f"{len(unlike)} rows differ, first {unlike[:1]}")
    described = connection.execute(f"describe {sql}").fetchall()
    family = {"BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double"}
    family |= {"BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp", "INTEGER": "int"}
    types = dict(result.dtypes)
    problems += [
        f"{name}: {types[name]} != {dtype}"
        for name, dtype, *_ in described
        if family.get(dtype) != types[name]
    ]
    return problems

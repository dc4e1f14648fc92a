"""Comparison of a Spark result with the same query in DuckDB."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("nation", "customer", "part", "orders", "lineitem")

# Spark type name to DuckDB type name.
SAME_TYPE = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
}


def duckdb_result(sql: str, sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    types = {row[0]: str(row[1]) for row in connection.execute(f"DESCRIBE {sql}").fetchall()}
    return types, connection.execute(sql).fetchall()


def _bag(rows, order):
    def plain(value):
        return "NaN" if isinstance(value, float) and math.isnan(value) else value

    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def assert_same(result, sql: str, sf_dir: str) -> int:
    types, expected = duckdb_result(sql, sf_dir)
    names = sorted(types)
    assert sorted(result.columns) == names
    spark_types = {f.name: SAME_TYPE[f.dataType.simpleString()] for f in result.schema}
    assert spark_types == types
    got = _bag([tuple(row) for row in result.collect()], [result.columns.index(n) for n in names])
    want = _bag(expected, [list(types).index(n) for n in names])
    assert got == want, (list((got - want).items())[:5], list((want - got).items())[:5])
    return sum(got.values())

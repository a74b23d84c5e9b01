"""Order-insensitive comparison of Spark and DuckDB results."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import DataFrame


def duckdb_over(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in ("lineitem", "orders", "part", "customer"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


SPARK_TYPES = {
    "VARCHAR": "string",
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def _normal(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    return repr(value)


def sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(_normal(row[i]) for i in order) for row in rows)


def spark_result(df: DataFrame):
    return dict(df.dtypes), sorted_rows(df.columns, df.collect())


def duckdb_result(con: duckdb.DuckDBPyConnection, sql: str):
    relation = con.sql(sql)
    types = {n: SPARK_TYPES.get(str(t), str(t)) for n, t in zip(relation.columns, relation.types, strict=True)}
    return types, sorted_rows(relation.columns, relation.fetchall())

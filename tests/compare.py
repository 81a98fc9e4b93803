"""Runs queries in Spark and their SQL in DuckDB and compares the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from larkmetric.plans.fixtures import TABLES

SF_DIR = "/root/testdata/sf0.001"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return float(f"{value:.12g}") + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda r: tuple((v is not None, str(v)) for v in r))


FAMILY = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "integer": "int",
    "float": "double", "double": "double", "string": "text", "varchar": "text",
    "boolean": "bool", "date": "date",
}


def family(kind: str) -> str:
    kind = kind.lower()
    return FAMILY.get(kind, kind)


def difference(df, con, sql: str) -> str | None:
    """None when names, types and rows agree; else what differs."""
    relation = con.sql(sql)
    names = list(relation.columns)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    spark_types = {n: family(t) for n, t in df.dtypes}
    duck_types = {n: family(str(t)) for n, t in zip(names, relation.types)}
    wrong = {n: (spark_types[n], duck_types[n]) for n in names if spark_types[n] != duck_types[n]}
    _, left = canonical(df.columns, df.collect())
    cols, right = canonical(names, relation.fetchall())
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}; types {wrong}"
    if left != right:
        pairs = [(a, b) for a, b in zip(left, right) if a != b]
        return f"{len(pairs)} rows differ, as {cols}: {pairs[0][0]} against {pairs[0][1]}; types {wrong}"
    return f"types {wrong}" if wrong else None

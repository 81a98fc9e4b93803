"""Relational table extract (SRC-10)."""

from __future__ import annotations

import datetime as dt
import decimal

from pyspark.sql import DataFrame, SparkSession

from ..config import ROWS_PER_TASK


def count_rows(spark: SparkSession, url: str, table: str, properties: dict) -> int:
    """Counted by the database: one row comes back."""
    return spark.read.jdbc(url, f"(SELECT count(*) AS n FROM {table}) b", properties=properties).first()[0]


def key_bounds(spark: SparkSession, url: str, table: str, key: str, parts: int, properties: dict) -> list:
    """The first key of each of ``parts`` ranges of about equally many rows, each once, smallest first.

    The database ranks the keys, over its index where there is one; a row a range comes back.
    """
    ranked = f"SELECT {key} AS k, ntile({parts}) OVER (ORDER BY {key}) AS part FROM {table} WHERE {key} IS NOT NULL"
    query = f"(SELECT min(k) AS first_key FROM ({ranked}) r GROUP BY part) b"
    return sorted({row[0] for row in spark.read.jdbc(url, query, properties=properties).collect()})


def _literal(value) -> str:
    if isinstance(value, (int, float, decimal.Decimal)):
        return str(value)
    if isinstance(value, (dt.date, dt.datetime)):
        value = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat()
    return "'" + str(value).replace("'", "''") + "'"


def range_predicates(key: str, bounds: list) -> list[str]:
    """Conditions of which each row meets exactly one, rows without a key and beyond the bounds too."""
    if len(bounds) < 2:
        return []
    inner = [_literal(b) for b in bounds[1:]]
    between = [f"{key} >= {low} AND {key} < {high}" for low, high in zip(inner, inner[1:])]
    return [f"{key} < {inner[0]} OR {key} IS NULL", *between, f"{key} >= {inner[-1]}"]


def extract_table(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    properties: dict | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    predicates: list[str] | None = None,
) -> DataFrame:
    """Distinct rows of a table, read in parallel key ranges of about ``rows_per_task`` rows.

    Ranges are of equal depth, however unevenly the keys lie; only rows of one key cannot be told apart
    by it. Rows that come in between lie in some range all the same. ``predicates`` gives the
    conditions to read by instead, one a task.
    """
    properties = properties or {}
    if not predicates:
        parts = -(-count_rows(spark, url, table, properties) // rows_per_task)
        bounds = key_bounds(spark, url, table, key, parts, properties) if parts > 1 else []
        predicates = range_predicates(key, bounds)
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=properties).dropDuplicates()
    return spark.read.jdbc(url, table, properties=properties).dropDuplicates()

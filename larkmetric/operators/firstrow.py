"""First row per key and cut-off rows (WIN-1 … WIN-3, SRT-2, LKP-1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(
    df: DataFrame, keys: list[str], order: list[str], columns: list[str], last: bool = False
) -> DataFrame:
    """``columns`` of the first (or last) row of each key by ``order``.

    ``min_by`` combines on the map side. A ranking window would bring a hot
    key whole into one task and sort it there. ``order`` must decide ties.
    """
    pick = F.max_by if last else F.min_by
    best = pick(F.struct(*columns), F.struct(*order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in columns])


def lookup(df: DataFrame, key: str, value, order: list[str]) -> DataFrame:
    """The first row whose ``key`` is ``value``, as a frame of at most one row."""
    rest = [c for c in df.columns if c != key]
    return first_per_key(df.where(F.col(key) == value), [key], order, rest).select(*df.columns)


def until_terminator(
    df: DataFrame, stop: Column, order: str, inclusive: bool = False, when_missing: str = "none"
) -> DataFrame:
    """Rows before the first row (by ``order``) on which ``stop`` holds.

    Without such a row nothing is returned, or everything with
    ``when_missing="all"``.
    """
    limit = df.where(stop).agg(F.min(order)).scalar()
    keep = (F.col(order) <= limit) if inclusive else (F.col(order) < limit)
    return df.where(F.coalesce(keep, F.lit(when_missing == "all")))


def earliest(df: DataFrame, column: str = "event_date") -> DataFrame:
    return df.agg(F.min(column).alias(column))

"""Writing daily snapshots and reports (SNK-1 … SNK-4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date
from .versions import publish, publish_bucketed


def save_snapshot(df: DataFrame, path: str, partitions: tuple[str, ...] = ("date",)) -> None:
    """Replace the days the frame has rows for; others, and an empty frame, change nothing.

    Rebalancing by partition column gives few files of even size, and splits a
    partition that holds most rows. Each day is published when all its files are there.
    """
    publish(df, path, partitions)


def save_day(df: DataFrame, path: str, day: str | dt.date, partitions: tuple[str, ...] = ()) -> None:
    """Replace a day whole, whatever partitions below it the day had before.

    An empty frame empties the day. A write that fails leaves the day as it was.
    """
    day = as_date(day)
    publish(df.withColumn("date", F.lit(day)), path, ("date", *partitions), [day])


def save_days(df: DataFrame, path: str, origins: dict[str, str]) -> None:
    """Replace several days whole by one write; each is noted with what it was made from."""
    publish(df, path, ("date",), [as_date(day) for day in origins], origins)


def save_bucketed_day(df: DataFrame, path: str, day: str | dt.date, key: str, buckets: int) -> None:
    """Replace a day whole with files bucketed and sorted by ``key``."""
    publish_bucketed(df, path, as_date(day), key, buckets)


def typed(df: DataFrame, doubles: list[str], flags: list[str]) -> DataFrame:
    """Zero and false for what is missing, then doubles and booleans."""
    cols = {c: F.coalesce(F.col(c).cast("string").try_cast("double"), F.lit(0.0)) for c in doubles}
    cols |= {c: F.coalesce(F.col(c).cast("string").try_cast("boolean"), F.lit(False)) for c in flags}
    return df.withColumns(cols)


def save_typed(df: DataFrame, path: str, doubles: list[str], flags: list[str]) -> None:
    save_snapshot(typed(df, doubles, flags), path)


def save_csv(df: DataFrame, path: str) -> None:
    """Gzip CSV with a header; NULL and NaN become 0, in text columns too."""

    def filled(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind in ("double", "float"):
            c = F.when(~F.isnan(c), c)
        return F.coalesce(c.cast("string"), F.lit("0")).alias(name)

    rows = df.select(*[filled(*column) for column in df.dtypes])
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path, compression="gzip")


def save_report(df: DataFrame, path: str, day: str | dt.date) -> None:
    save_day(df, path, day, ("period", "level"))

"""Names of the files and days of a folder, listed no further than a period goes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Periods of more days are listed by whole months.
SHORT = 62


def found_files(spark: SparkSession, path: str) -> DataFrame | None:
    """``path`` of each file under a folder or glob pattern; none is opened. None when nothing matches.

    Only what the pattern matches is listed.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        return reader.load(path).select("path")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def list_files(spark: SparkSession, path: str, regex: str = "") -> list[str]:
    """Names of the files under ``path`` that match; none is opened. Empty when there is no such folder."""
    files = found_files(spark, path)
    return [] if files is None else sorted(r.path for r in files.where(F.col("path").rlike(regex)).collect())


def _months(first: dt.date, last: dt.date) -> Iterator[dt.date]:
    at = first.replace(day=1)
    while at <= last:
        yield at
        at = (at + dt.timedelta(31)).replace(day=1)


def _either(names: list[str]) -> str:
    return names[0] if len(names) == 1 else f"{{{','.join(names)}}}"


def month_glob(first: dt.date | None, last: dt.date) -> str:
    """A glob pattern of the months of a period; without a ``first`` day, of all."""
    return "*" if first is None else _either([f"{m:%Y-%m}" for m in _months(first, last)])


def day_glob(first: dt.date | None, last: dt.date) -> str:
    """A glob pattern that matches all days of a period; longer ones by month, so it may match more."""
    if first is None:
        return "*"
    days = (last - first).days + 1
    if days > SHORT:
        return _either([f"{m:%Y-%m}-*" for m in _months(first, last)])
    return _either([f"{first + dt.timedelta(i):%Y-%m-%d}" for i in range(days)])


def months_back(day: dt.date, months: int = 12) -> Iterator[tuple[dt.date | None, dt.date]]:
    """The month of ``day`` up to it, then those before it, and at last all days before those."""
    last = day
    for _ in range(months):
        yield last.replace(day=1), last
        last = last.replace(day=1) - dt.timedelta(1)
    yield None, last

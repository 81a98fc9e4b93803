"""Days that are replaced whole, by a version that is written first and published last (SNK-1, SNK-4).

A write puts its rows into a folder of its own, which no reader knows. Only when that is
complete does one small file, with a line a day, name it in the month's log; the newest
version that the log has of a day is the day. A write that ends half-way leaves every day as it was.

    <table>/data/_version=1f0c/date=2024-01-30/part-….parquet
    <table>/log/month=2024-01/_version=00000002-1f0c/part-….json
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from .listing import found_files

#: The name Spark gives to the folder of rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
#: What the log says of a day's files by buckets: their number and key follow.
BUCKETED = "buckets="
LOG_SCHEMA = "day string, files long, columns string, origin string"


@dataclass(frozen=True)
class Version:
    """A published version of a day: its name, how many files it has, its columns, and what it was made from."""

    day: str
    name: str
    files: int
    columns: str
    origin: str


def _log(spark: SparkSession, path: str, months: str) -> list[Version]:
    """All publications of the months that match the glob pattern."""
    try:
        rows = spark.read.schema(LOG_SCHEMA).json(f"{path}/log/month={months}/_version=*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    name = F.regexp_extract("_metadata.file_path", "/_version=([^/]*)/[^/]*$", 1).alias("name")
    return [Version(**r.asDict()) for r in rows.select("*", name).collect()]


def published(spark: SparkSession, path: str, months: str = "*") -> dict[str, Version]:
    """The newest version of each day published in the months that match the glob pattern; no other month is listed."""
    newest: dict[str, Version] = {}
    for version in _log(spark, path.rstrip("/"), months):
        if version.day not in newest or newest[version.day].name < version.name:
            newest[version.day] = version
    return newest


def _month(day: str) -> str:
    return day[:7] if day_of(day) else "none"


def _announce(spark: SparkSession, path: str, unique: str, files: dict[str, int], columns: str, origins: dict[str, str]) -> None:
    """Make a complete version the newest of its days: one small file for each month, in one step."""
    by_month: dict[str, list[str]] = defaultdict(list)
    for day in sorted(files):
        by_month[_month(day)].append(day)
    for month, held in by_month.items():
        # Behind all there are of these days; of two writers at once the greater name is the later.
        last = max((int(v.name.split("-")[0]) for v in _log(spark, path, month)), default=0)
        lines = spark.createDataFrame([(day, files[day], columns, origins.get(day, "")) for day in held], LOG_SCHEMA)
        lines.coalesce(1).write.json(f"{path}/log/month={month}/_version={last + 1:08d}-{unique}")


def publish(
    df: DataFrame, path: str, partitions: tuple[str, ...], days: list[dt.date] | None = None, origins: dict[str, str] = {}
) -> None:
    """Replace days, each whole, with the rows of ``df``; ``partitions`` are the day's column and columns below it.

    ``days`` are replaced even where the frame has no row of them; without it, the days it has rows of.
    Other days stay as they are. Readers see a day's old rows until its new ones are all there. ``origins`` are noted
    in the log by day, such as the versions of the days that these were made from.
    """
    spark, path, date = df.sparkSession, path.rstrip("/"), partitions[0]
    unique = uuid.uuid4().hex
    folder = f"{path}/data/_version={unique}"
    rows = df.hint("rebalance", *[F.col(p) for p in partitions])
    rows.write.option("compression", "gzip").partitionBy(*partitions).parquet(folder)
    files = found_files(spark, folder)
    count: dict[str, int] = {}
    if files is not None:
        day = F.regexp_extract("path", rf"/{date}=([^/]*)/", 1).alias("day")
        count = {r["day"]: r["count"] for r in files.where(F.col("path").endswith(".parquet")).groupBy(day).count().collect()}
    every = {day: count.get(day, 0) for day in {*count, *map(str, days or [])}}
    _announce(spark, path, unique, every, df.schema.json(), origins)


def publish_bucketed(df: DataFrame, path: str, day: dt.date, key: str, buckets: int, date: str = "date") -> None:
    """Replace a day with rows in files by a hash of ``key``, sorted by it, so that joins on it need no shuffle of them."""
    spark, path, unique = df.sparkSession, path.rstrip("/"), uuid.uuid4().hex
    rows = df.drop(date)
    name = f"bucketed_{unique}"
    writer = rows.write.format("parquet").option("compression", "gzip").bucketBy(buckets, key).sortBy(key)
    writer.option("path", f"{path}/data/_version={unique}/{date}={day}").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay; the log says what they are
    columns = df.withColumn(date, F.lit(day)).schema.json()
    _announce(spark, path, unique, {str(day): buckets}, columns, {str(day): f"{BUCKETED}{buckets}:{key}"})


def read_bucketed(spark: SparkSession, path: str, version: Version, date: str = "date") -> DataFrame | None:
    """A bucketed version with its buckets known to the plan; None for a version of another kind."""
    if not version.origin.startswith(BUCKETED):
        return None
    buckets, key = version.origin.removeprefix(BUCKETED).split(":")
    unique = version.name.split("-")[1]
    fields = [f for f in StructType.fromJson(json.loads(version.columns)).fields if f.name != date]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    name = f"bucketed_{unique}"
    folder = f"{path.rstrip('/')}/data/_version={unique}/{date}={version.day}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{folder}'"
    )
    return spark.table(name).withColumn(date, F.lit(day_of(version.day)))


def read_versions(spark: SparkSession, path: str, versions: list[Version], date: str = "date") -> DataFrame:
    """The rows of these versions, stacked by column name. Their columns come from the log: no file is opened for them."""
    path = path.rstrip("/")
    by_columns: dict[str, list[Version]] = defaultdict(list)
    for version in versions:
        by_columns[version.columns].append(version)
    frames = []
    for columns, held in by_columns.items():
        schema = StructType.fromJson(json.loads(columns))
        folders = [f"{path}/data/_version={v.name.split('-')[1]}/{date}={v.day}" for v in held if v.files]
        if folders:
            whole = StructType([*schema.fields]).add("_version", StringType())
            frame = spark.read.schema(whole).option("basePath", f"{path}/data").parquet(*folders).drop("_version")
        else:
            frame = spark.createDataFrame([], schema)
        frames.append(frame)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def day_of(name: str) -> dt.date | None:
    """The day of a folder's name; None for another name."""
    return dt.date.fromisoformat(name) if re.fullmatch(r"\d{4}-\d{2}-\d{2}", name) else None

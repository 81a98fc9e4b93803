"""Reading daily files (SRC-1 … SRC-9, SRC-11, SRC-12).

Folders keep the date in the name of a file (``date=2024-01-30.parquet.gz``), of a
partition, or in the log of published days. Names of the period are listed first, and only
chosen files are opened, so what lies in other days can neither slow nor break a scan.
"""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..config import ATTRIBUTION_COLUMNS, ATTRIBUTION_KINDS, ATTRIBUTION_RENAMES, ATTRIBUTION_SKIPPED
from ..functions import days_before, text_to_date
from ..operators.clean import select_existing
from .listing import day_glob, found_files, list_files, month_glob, months_back
from .versions import Version, day_of, published, read_bucketed, read_versions

FILE_PATH = "_metadata.file_path"
FILE_NAME = "_file_path"
FILE_DATE = r"date=(\d{4}-\d{2}-\d{2})"
#: Files whose first lines are read at once.
HEADERS_AT_ONCE = 16


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*columns)


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON lines, plain, gzip or bzip2. A schema saves a pass over the data."""
    reader = spark.read.schema(schema) if schema else spark.read.option("primitivesAsString", True)
    return reader.json(path)


def read_csv(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """CSV with a header, every column as text.

    ``multi_line`` is for cells with line breaks; such files cannot be split.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    return reader.csv(path)


def _wanted(df: DataFrame, columns: list[str] | None) -> DataFrame:
    return df if columns is None else select_existing(df, columns)


def _chosen(spark: SparkSession, files: list[str], what: str) -> DataFrame:
    """These parquet files stacked by column name; others are not opened, not even for their schema."""
    if not files:
        raise LookupError(f"no file {what}")
    return spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(*files)


def read_matching(
    spark: SparkSession, path: str, regex: str, columns: list[str] | None = None, distinct: bool = False
) -> DataFrame:
    """Parquet files under ``path`` whose full name matches, stacked by column name.

    ``path`` may be a glob pattern, such as a month's folders; nothing beside what it matches is listed.
    """
    df = _wanted(_chosen(spark, list_files(spark, path, regex), f"in {path} matches {regex}"), columns)
    return df.dropDuplicates() if distinct else df


def file_date() -> Column:
    return F.regexp_extract(FILE_PATH, FILE_DATE, 1)


def _dated_files(spark: SparkSession, path: str, first: dt.date, last: dt.date) -> dict[str, list[str]]:
    """Files with a day of the period in their own name or in that of a folder right under ``path``, by day."""
    days: dict[str, list[str]] = {}
    for file in list_files(spark, f"{path.rstrip('/')}/*date={day_glob(first, last)}*", FILE_DATE):
        day = re.search(FILE_DATE, file)[1]
        if str(first) <= day <= str(last):
            days.setdefault(day, []).append(file)
    return days


def read_period_files(
    spark: SparkSession, path: str, start: str, end: str, columns: list[str] | None = None
) -> DataFrame:
    """Legacy daily parquet files from start to end, with the file's date as ``Date``."""
    days = _dated_files(spark, path, days_before(start, 0), days_before(end, 0))
    files = [f for held in days.values() for f in held]
    df = _chosen(spark, files, f"in {path} from {start} to {end}").select("*", file_date().alias("Date"))
    return df if columns is None else select_existing(df, columns)


def _headers(spark: SparkSession, files: list[str], multi_line: bool) -> dict[tuple[str, ...], list[str]]:
    """The CSV files that have the same header line, by its names. Of each file the first line alone is read, many at a time."""
    with ThreadPool(HEADERS_AT_ONCE) as pool:
        names = pool.map(lambda file: tuple(read_csv(spark, file, multi_line).columns), files)
    held: dict[tuple[str, ...], list[str]] = {}
    for header, file in zip(names, files):
        held.setdefault(header, []).append(file)
    held.pop((), None)  # files without a line
    return held


def read_by_header(spark: SparkSession, files: list[str], multi_line: bool = False) -> DataFrame:
    """CSV files stacked by the names in their own headers, every column as text, with ``FILE_PATH`` still to be had.

    A CSV reader knows a single header and goes by position in all its files, so
    files are read by one reader for each header there is. Headers may differ in order and in columns; a column that a file does not
    have is null. Names that differ in case only are one column.
    """
    frames = []
    for header, held in _headers(spark, files, multi_line).items():
        schema = StructType([StructField(name, StringType()) for name in header])
        reader = spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", multi_line)
        frames.append(reader.csv(held).select("*", F.col(FILE_PATH).alias(FILE_NAME)))
    if not frames:
        raise LookupError(f"no header in {files}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_period_csv(
    spark: SparkSession, path: str, start: str | dt.date, end: str | dt.date, columns: list[str] | None = None
) -> DataFrame:
    """Daily CSV files ``date=….csv.gz``, whose headers may differ from day to day and within a day."""
    first, last = days_before(start, 0), days_before(end, 0)
    days = _dated_files(spark, path, first, last)
    if not days:
        raise LookupError(f"no file in {path} from {first} to {last}")
    rows = read_by_header(spark, [f for held in days.values() for f in held])
    day = F.regexp_extract(FILE_NAME, FILE_DATE, 1)
    return _wanted(rows.withColumn("Date", day).drop(FILE_NAME), columns)


def _landed(spark: SparkSession, path: str, days: str, date: str) -> set[str]:
    """The matching days that have plain folders, as others write them."""
    files = found_files(spark, f"{path.rstrip('/')}/{date}={days}")
    if files is None:
        return set()
    names = files.select(F.regexp_extract("path", rf"/{date}=([^/]*)/", 1).alias("day")).distinct()
    return {r["day"] for r in names.collect()}


def days_of(
    spark: SparkSession, path: str, first: dt.date | None, last: dt.date, date: str = "date"
) -> dict[str, Version | None]:
    """The days of a period: their published version, or None for a plain folder. A published day hides a plain one."""
    found = {**dict.fromkeys(_landed(spark, path, day_glob(first, last), date)), **published(spark, path, month_glob(first, last))}
    return {name: v for name, v in found.items() if (day := day_of(name)) and (first is None or first <= day) and day <= last}


def read_days(spark: SparkSession, path: str, days: dict[str, Version | None], date: str = "date") -> DataFrame:
    """These days, stacked by column name; plain ones are opened for their columns, published ones are not."""
    frames = []
    if versions := [v for v in days.values() if v]:
        frames.append(read_versions(spark, path, versions, date))
    if folders := [f"{path.rstrip('/')}/{date}={day}" for day, v in days.items() if not v]:
        frames.append(spark.read.option("basePath", path).option("mergeSchema", True).parquet(*folders))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_all(spark: SparkSession, path: str, date: str = "date") -> DataFrame:
    """Every day of a snapshot folder, and rows without a day; none at all is an error."""
    days = {**dict.fromkeys(_landed(spark, path, "*", date)), **published(spark, path)}
    if not days:
        raise LookupError(f"no file in {path}")
    return read_days(spark, path, days, date)


def read_period(
    spark: SparkSession,
    path: str,
    start: str | dt.date,
    end: str | dt.date,
    columns: list[str] | None = None,
    date: str = "date",
) -> DataFrame:
    """A snapshot folder by ``date``: the days of the period it has.

    Other days are neither listed nor opened. A period without any day is an error.
    """
    first, last = days_before(start, 0), days_before(end, 0)
    days = days_of(spark, path, first, last, date)
    if not days:
        raise LookupError(f"no file in {path} from {first} to {last}")
    return _wanted(read_days(spark, path, days, date), columns)


def latest_snapshot(spark: SparkSession, path: str, as_of: str | dt.date, date: str = "date") -> DataFrame:
    """Rows of the newest day with rows, up to ``as_of``, however old; none is an error.

    Days are listed month by month, backwards, and all older ones at once only after a year without rows. Only days without
    rows and the one returned are opened.
    """
    as_of = days_before(as_of, 0)
    for first, last in months_back(as_of):
        found = days_of(spark, path, first, last, date)
        for name in sorted(found, reverse=True):
            if not (rows := read_days(spark, path, {name: found[name]}, date)).isEmpty():
                return rows
    raise LookupError(f"no snapshot in {path} up to {as_of}")


def read_state(spark: SparkSession, path: str, day: str | dt.date) -> DataFrame:
    """One day of a state, which must be there, with its buckets if it has some."""
    day = days_before(day, 0)
    version = days_of(spark, path, day, day).get(str(day))
    rows = read_bucketed(spark, path, version) if version else None
    return require_snapshot(read_period(spark, path, day, day) if rows is None else rows, day)


def require_snapshot(df: DataFrame, day: str | dt.date, date: str = "date") -> DataFrame:
    """Rows of one day; an absent day is an error, not an empty result."""
    rows = df.where(F.col(date) == days_before(day, 0))
    if rows.isEmpty():
        raise LookupError(f"no snapshot for {day}")
    return rows


def read_report(
    spark: SparkSession, path: str, period: str, date: str | dt.date, columns: list[str] | None = None
) -> DataFrame:
    """One period's report of one day; no other day is listed."""
    day = days_before(date, 0)
    rows = read_period(spark, path, day, day).where(F.col("period") == period)
    return rows if columns is None else rows.select(*columns)


def read_attribution(spark: SparkSession, path: str, date: str | dt.date) -> DataFrame:
    """A day's attribution CSV files of all apps and kinds, tagged ``appsflyer_type``.

    Names (of a file or of a folder of parts) end in ``<date>_<kind>.csv.gz``.
    Re-attribution files are skipped. Files may have columns in any order, and columns of their
    own: each is read by its own header.
    """
    day = str(days_before(date, 0))
    kind = rf"{day}_({'|'.join(ATTRIBUTION_KINDS)})\.csv\.gz(/|$)"
    files = [f for f in list_files(spark, f"{path.rstrip('/')}/*{day}*.csv.gz", kind) if not re.search("|".join(ATTRIBUTION_SKIPPED), f)]
    if not files:
        raise LookupError(f"no attribution file in {path} of {day}")
    rows = read_by_header(spark, files)
    return rows.withColumn("appsflyer_type", F.regexp_extract(FILE_NAME, kind, 1)).drop(FILE_NAME)


def shape_attribution(df: DataFrame) -> DataFrame:
    """The attribution columns kept, renamed, with the date of the event."""
    kept = select_existing(df, ATTRIBUTION_COLUMNS).withColumnsRenamed(ATTRIBUTION_RENAMES)
    return kept.withColumn("event_date", text_to_date(F.col("time")))


def read_open_json(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """JSON lines as one variant column ``row``: whatever fields each line has, and no pass to infer a schema.

    A line that is no JSON is an error when it is read.
    """
    return spark.read.option("singleVariantColumn", "row").option("mode", "FAILFAST").json(path)


def _open_field(column: Column, path: str, kind: str) -> Column:
    """A field of a variant; null where it is missing or does not fit. As text, what is no scalar is JSON."""
    return F.try_variant_get(column, path, kind)


def _quoted(*names: str) -> str:
    if any('"' in name for name in names):
        raise ValueError(f"a name holds a quotation mark: {names}")
    return "$" + "".join(f'["{name}"]' for name in names)


def _others(fields: Column, known: list[str]) -> Column:
    """What is not in a column of its own, by name: text as it is, all else as JSON."""
    rest = F.map_filter(fields, lambda name, value: ~name.isin(*known)) if known else fields
    return F.transform_values(rest, lambda name, value: _open_field(value, "$", "string"))


def flatten_open(
    df: DataFrame,
    columns: dict[str, str],
    fields: dict[str, str],
    properties: str = "properties",
    other_properties: str = "other_properties",
    other_fields: str = "other_fields",
) -> DataFrame:
    """Event or user export from :func:`read_open_json`: properties and top-level fields as columns.

    ``columns`` and ``fields`` give name and type of those that get a column; a
    value that does not fit its type is null. Everything else is kept in two maps by name, so a property
    that appears tomorrow is neither lost nor an error today. Rows without properties have no other ones.
    """
    row = F.col("row")
    inner = _open_field(row, _quoted(properties), "map<string,variant>")
    outer = _open_field(row, "$", "map<string,variant>")
    return df.select(
        *[_open_field(row, _quoted(properties, name), kind).alias(name) for name, kind in columns.items()],
        *[_open_field(row, _quoted(name), kind).alias(name) for name, kind in fields.items()],
        _others(inner, list(columns)).alias(other_properties),
        _others(outer, [*fields, properties]).alias(other_fields),
    )


def flatten_export(df: DataFrame, properties: str = "properties") -> DataFrame:
    """Event or user export: the properties beside the top-level fields."""
    rest = [c for c in df.columns if c != properties]
    return df.select(f"{properties}.*", *rest)


def is_attributed(source: Column, corp: Column) -> Column:
    """Whether a user has a media source, or a corporate name that is not blank."""
    return source.isNotNull() | F.coalesce(~corp.isin("", " "), F.lit(False))


def attributed_users(df: DataFrame, properties: str = "properties") -> DataFrame:
    """Exported users with a media source, or with a corporate name that is not blank."""
    kept = is_attributed(F.col(f"{properties}.media_source"), F.col(f"{properties}.corp_name"))
    return flatten_export(df.where(kept), properties)

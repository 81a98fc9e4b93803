"""Row-wise cleaning and relabelling of event rows (PRJ-1 … PRJ-14)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import BRAND, CHALLENGE, CORP, PERIODS, SENTINELS, EventNames
from ..functions import days_before, is_true, local_event_date, text_to_double, text_to_id, text_to_long
from .joins import hot_join


def null_sentinels(df: DataFrame, sentinels: list[str] = SENTINELS) -> DataFrame:
    """Texts that stand for "no value", and NaN, become NULL in every column."""

    def clean(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind == "string":
            return F.when(~c.isin(*sentinels), c).alias(name)
        if kind in ("double", "float"):
            return F.when(~F.isnan(c), c).alias(name)
        return c

    return df.select(*[clean(name, kind) for name, kind in df.dtypes])


def select_existing(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[f"`{c}`" for c in columns if c in df.columns])


def ensure_column(df: DataFrame, name: str, kind: str = "string") -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))


def merge_columns(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """For each ``(src, tgt)`` a non-null ``src`` overwrites ``tgt``; ``src`` goes."""
    for src, tgt in pairs:
        if src in df.columns:
            old = F.col(tgt) if tgt in df.columns else F.lit(None)
            df = df.withColumn(tgt, F.coalesce(F.col(src), old)).drop(src)
    return df


def join_with_slash(df: DataFrame, left: str, right: str) -> DataFrame:
    """``left`` becomes ``left/right`` (NULL when both are missing)."""
    blank = F.lit("")
    text = F.concat(F.coalesce(F.col(left), blank), F.lit("/"), F.coalesce(F.col(right), blank))
    return df.withColumn(left, F.nullif(text, F.lit("/"))).drop(right)


def prefix_flagged(df: DataFrame, flag: str, value: str, prefix: str = "brand_") -> DataFrame:
    """Prefix the event where the flag column holds ``value``; drop the flag."""
    event = F.when(F.col(flag) == value, F.concat(F.lit(prefix), "event")).otherwise(F.col("event"))
    return df.withColumn("event", event).drop(flag)


def mark_zero_amount(df: DataFrame, event: str, amount: str, label: str | None = None) -> DataFrame:
    """``event`` becomes ``zero_…`` when its amount is missing or 0; the amount goes."""
    empty = F.col(amount).isNull() | (text_to_double(F.col(amount).cast("string")) == 0)
    hit = (F.col("event") == event) & empty
    name = F.when(hit, F.lit(label or f"zero_{event}")).otherwise(F.col("event"))
    return df.withColumn("event", name).drop(amount)


def prefix_by_membership(
    df: DataFrame, id_types: DataFrame, id_col: str = "challenge_id", type_col: str = "service_type"
) -> DataFrame:
    """Prefix ``brand_`` then ``corp_`` where the id has that service type.

    One id may have both types. The table is reduced to one row per id, so the
    join adds no rows; its size decides at run time whether it is broadcast.
    """
    kind = F.col(type_col).try_cast("double")
    flags = (
        id_types.where(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).cast("string").alias(id_col))
        .agg(F.bool_or(kind == BRAND).alias("_brand"), F.bool_or(kind == CORP).alias("_corp"))
    )
    brand = F.when(F.col("_brand"), F.lit("brand_")).otherwise(F.lit(""))
    corp = F.when(F.col("_corp"), F.lit("corp_")).otherwise(F.lit(""))
    labelled = hot_join(df, flags, id_col).withColumn("event", F.concat(corp, brand, "event"))
    return labelled.select(*df.columns)


def corrected_event(
    event: Column, service_type: Column, names: EventNames = EventNames()
) -> Column:
    """The event a checkout should have been, by the service type on record."""
    return (
        F.when(service_type == CORP, F.lit(names.corp))
        .when((event == names.challenge) & (service_type == BRAND), F.lit(names.brand))
        .when((event == names.brand) & (service_type == CHALLENGE), F.lit(names.challenge))
        .otherwise(event)
    )


def keep_known(df: DataFrame, key: str, excluded: list[str]) -> DataFrame:
    """Rows with a key whose event is not excluded; a NULL event stays."""
    return df.where(F.col(key).isNotNull() & F.coalesce(~F.col("event").isin(*excluded), F.lit(True)))


def first_order(df: DataFrame, column: str = "order_count") -> Column:
    """Text must be exactly ``1.0``; a number must be 1."""
    text = dict(df.dtypes)[column] == "string"
    return F.coalesce(F.col(column) == (F.lit("1.0") if text else F.lit(1)), F.lit(False))


def cast_ids_and_flags(
    df: DataFrame, ints: list[str], flags: list[str], sentinels: list[str] = SENTINELS
) -> DataFrame:
    """Text to integer (``…_id`` columns to the text of one, however long) and to boolean."""
    cols = {}
    for name in ints:
        if name in df.columns:
            text = F.col(name).cast("string")
            cols[name] = text_to_id(text) if "_id" in name else text_to_long(text)
    for name in flags:
        if name in df.columns:
            cols[name] = is_true(F.col(name), isinstance(df.schema[name].dataType, T.NumericType))
    return df.withColumns(cols)


def with_event_date(df: DataFrame, time: str = "time") -> DataFrame:
    return df.withColumn("event_date", local_event_date(F.col(time).try_cast("bigint")))


def within_days(df: DataFrame, as_of: str | dt.date, days: int, date: str = "event_date") -> DataFrame:
    """Rows of the ``days`` days ending with ``as_of``."""
    return df.where(F.col(date).between(days_before(as_of, days - 1), days_before(as_of, 0)))


def with_periods(df: DataFrame, as_of: str | dt.date, date: str = "event_date") -> DataFrame:
    """One row per report period a row belongs to; a single pass over the input."""
    window = within_days(df, as_of, max(PERIODS.values()), date)
    labels = F.array(
        *[
            F.when(F.col(date) >= days_before(as_of, days - 1), F.lit(label))
            for label, days in PERIODS.items()
        ]
    )
    return window.withColumn("period", F.explode(labels)).where(F.col("period").isNotNull())

"""Lifetime value per user (LTV-1 … LTV-3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LTV_COUNTS, LTV_VALUES, EventNames, LtvRules
from ..functions import add_limbs, as_limbs, days_before, is_uuid_like, limb_sums, limbs, named_limbs, whole
from .identity import device_owners, devices_to_users

STATE_SCHEMA = (
    "distinct_id string, "
    + ", ".join(f"{c} bigint" for c in LTV_COUNTS)
    + ", "
    + ", ".join(f"{c} double" for c in LTV_VALUES)
    + ", date date"
)


def empty_state(spark: SparkSession) -> DataFrame:
    """The state before the first day."""
    return spark.createDataFrame([], STATE_SCHEMA)


def _number(name: str) -> Column:
    c = F.col(name).cast("double")
    return F.coalesce(F.nanvl(c, F.lit(0.0)), F.lit(0.0))


def challenge_rows(
    day: DataFrame, names: EventNames = EventNames(), rules: LtvRules = LtvRules()
) -> DataFrame:
    """What each challenge checkout of the day adds."""
    brand, plain = F.col("event") == names.brand, F.col("event") == names.challenge
    return day.where(brand | plain).select(
        "distinct_id",
        F.when(brand, F.lit(rules.brand_unit_value)).otherwise(F.lit(0.0)).alias("brand_challenge_value"),
        _number("revenue_from_brand").alias("_brand_challenge_value"),
        _number("revenue_from_challenge").alias("challenge_value"),
        F.when(plain, F.lit(rules.challenge_unit_value)).otherwise(F.lit(0.0)).alias("_challenge_value"),
        brand.cast("bigint").alias("brand_challenge_count"),
        plain.cast("bigint").alias("challenge_count"),
    )


def store_rows(day: DataFrame, names: EventNames = EventNames()) -> DataFrame:
    """What each store checkout of the day adds."""
    rows = day.where(F.col("event") == names.store)
    return rows.select("distinct_id", _number("revenue").alias("store_value"))


def contributions(
    day: DataFrame, names: EventNames = EventNames(), rules: LtvRules = LtvRules()
) -> DataFrame:
    """Both kinds of row in one scan, zero where a column does not apply."""
    brand, plain, store = (F.col("event") == e for e in (names.brand, names.challenge, names.store))

    def at(kind: Column, value) -> Column:
        return F.when(kind, value).otherwise(F.lit(0.0))

    return day.where(F.col("event").isin(names.brand, names.challenge, names.store)).select(
        "distinct_id",
        brand.cast("bigint").alias("brand_challenge_count"),
        plain.cast("bigint").alias("challenge_count"),
        at(brand, F.lit(rules.brand_unit_value)).alias("brand_challenge_value"),
        at(~store, _number("revenue_from_brand")).alias("_brand_challenge_value"),
        at(~store, _number("revenue_from_challenge")).alias("challenge_value"),
        at(plain, F.lit(rules.challenge_unit_value)).alias("_challenge_value"),
        at(store, _number("revenue")).alias("store_value"),
    )


def _exact_per_user(rows: DataFrame) -> DataFrame:
    """One row per user; missing numbers count as 0, values are the limbs of their sums."""
    return rows.groupBy("distinct_id").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in LTV_COUNTS],
        *[part for c in LTV_VALUES for part in as_limbs(c, limb_sums(limbs(F.col(c))))],
    )


def sum_per_user(rows: DataFrame) -> DataFrame:
    """One row per user; missing numbers count as 0, values are summed exactly."""
    sums = _exact_per_user(rows)
    return sums.select("distinct_id", *LTV_COUNTS, *[whole(named_limbs(c)).alias(c) for c in LTV_VALUES])


def accumulate(
    state: DataFrame,
    day: DataFrame,
    user_info: DataFrame,
    date: str | dt.date,
    names: EventNames = EventNames(),
    rules: LtvRules = LtvRules(),
) -> DataFrame:
    """The state after ``date``: the state before it plus the day's checkouts.

    The day is summed per id before it meets the state and the device table,
    so both joins and the last sum see each id once per side.
    """
    today = sum_per_user(contributions(day, names, rules))
    before = state.select("distinct_id", *LTV_COUNTS, *LTV_VALUES)
    merged = devices_to_users(before.unionByName(today), user_info)
    return sum_per_user(merged).withColumn("date", F.lit(days_before(date, 0)))


#: The column a kept state is bucketed by.
STATE_KEY = "_key"
CHANGE = "change "


def _key(c: Column) -> Column:
    """An id as a key that is never missing; no id's key is that of the missing id."""
    return F.coalesce(F.concat(F.lit("="), c), F.lit(""))


def keyed_state(state: DataFrame) -> DataFrame:
    """The state with the key it is bucketed by."""
    return state.withColumn(STATE_KEY, _key(F.col("distinct_id")))


def advance(
    state: DataFrame,
    day: DataFrame,
    user_info: DataFrame,
    date: str | dt.date,
    names: EventNames = EventNames(),
    rules: LtvRules = LtvRules(),
) -> DataFrame:
    """As :func:`accumulate`, for a state that is bucketed by its key: the state itself stays where it is.

    What changes is worked out first: the day's checkouts, and the rows of devices that now have an
    owner. Only these are shuffled, to where the users' rows lie. The new state is bucketed as the old one.
    """
    values = [*LTV_COUNTS, *LTV_VALUES]
    owners = device_owners(user_info).where(is_uuid_like(F.col("device_id")))
    owners = owners.select(_key(F.col("device_id")).alias("_device"), "owner_id")
    owned = state[STATE_KEY] == F.col("_device")
    moved = state.join(owners.where(F.col("owner_id").isNotNull()), owned).select(F.col("owner_id").alias("distinct_id"), *values)
    today = devices_to_users(sum_per_user(contributions(day, names, rules)), user_info)
    changes = _exact_per_user(moved.unionByName(today.select("distinct_id", *values)))
    changes = changes.withColumnsRenamed({c: f"{CHANGE}{c}" for c in changes.columns if c != "distinct_id"})
    changes = changes.withColumn("_to", _key(F.col("distinct_id"))).withColumnRenamed("distinct_id", "_id")
    gone = owners.where(F.col("owner_id").isNotNull()).select(F.col("_device").alias("_gone"))
    kept = state.join(gone, state[STATE_KEY] == F.col("_gone"), "left_anti")
    both = kept.join(changes, kept[STATE_KEY] == F.col("_to"), "full_outer")
    none = F.lit(0)
    return both.select(
        F.coalesce("distinct_id", "_id").alias("distinct_id"),
        *[(F.coalesce(F.col(c), none) + F.coalesce(F.col(f"{CHANGE}{c}"), none)).cast("bigint").alias(c) for c in LTV_COUNTS],
        *[whole(add_limbs(limbs(F.col(c)), named_limbs(f"{CHANGE}{c}"))).alias(c) for c in LTV_VALUES],
        F.lit(days_before(date, 0)).alias("date"),
        F.coalesce(STATE_KEY, "_to").alias(STATE_KEY),
    )

"""The daily enriched event table (JOIN-7, JOIN-8, JOIN-15, SET-2, SET-3, PRJ-9/11/13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import TEST_VALUES, USER_COLUMNS, EventNames
from .clean import corrected_event, ensure_column, first_order, null_sentinels, with_event_date
from .dedup import spread_distinct
from .joins import hot_join

CHALLENGE_COLUMNS = ["service_type", "is_brand", "is_corp", "revenue_from_brand", "revenue_from_challenge"]


def all_users(*snapshots: DataFrame) -> DataFrame:
    """Distinct attribution rows of several user snapshots."""
    frames = [s.select(*USER_COLUMNS) for s in snapshots]
    table = frames[0]
    for frame in frames[1:]:
        table = table.union(frame)
    return table.distinct()


def attribute(events: DataFrame, users: DataFrame) -> DataFrame:
    """Events with their user's attribution; a user on record twice fans out."""
    return null_sentinels(hot_join(events, users, "distinct_id"), TEST_VALUES)


def other_events(events: DataFrame, handled: list[str]) -> DataFrame:
    """Events of no handled kind; a NULL event is one of them."""
    return events.where(F.coalesce(~F.col("event").isin(*handled), F.lit(True)))


def _mart_key(kind: str, c: Column) -> Column:
    return F.concat(F.lit(f"{kind}:"), c.cast("string"))


def _mart_rows(kind: str, mart: DataFrame, key: str, *columns: Column | str) -> DataFrame:
    return mart.select(_mart_key(kind, F.col(key)).alias("_key"), *columns)


def enrich(
    events: DataFrame,
    users: DataFrame,
    challenges: DataFrame,
    stores: DataFrame,
    names: EventNames = EventNames(),
) -> DataFrame:
    """Attribution, mart columns, corrected events, first flag and local date.

    Instead of splitting events by kind and stacking them again, both marts are
    one table under kind and key, so events are shuffled for them once. Events of
    other kinds have no key, and are spread over tasks. Marts may hold several
    rows per key, and then fan out. Rows are made distinct behind a shuffle of
    their own: a hash table of wide rows beside the join's two sorts was most of a task's memory.
    """
    rows = attribute(ensure_column(ensure_column(events, "order_no"), "order_count"), users)
    challenge_kind = F.coalesce(F.col("event").isin(names.challenge, names.brand), F.lit(False))
    store_kind = F.coalesce(F.col("event") == names.store, F.lit(False))
    c = _mart_rows("challenge", challenges, "challenge_id", *CHALLENGE_COLUMNS, "revenue")
    s = _mart_rows("store", stores, "order_no", "revenue")
    mart = spread_distinct(c.unionByName(s, allowMissingColumns=True))
    # Sorted for the join, store rows have one empty column, not five.
    packed = F.when(F.col("_key").startswith("challenge:"), F.struct(*CHALLENGE_COLUMNS)).alias("_challenge")
    mart = mart.select("_key", packed, "revenue")
    key = F.when(challenge_kind, _mart_key("challenge", rows["challenge_id"])).when(
        store_kind, _mart_key("store", rows["order_no"])
    )
    joined = hot_join(rows.withColumn("_key", key), mart, "_key").select(
        *rows.columns, *[F.col("_challenge")[name].alias(name) for name in CHALLENGE_COLUMNS], "revenue"
    )
    flag = F.col("first").cast("string").try_cast("boolean")
    enriched = joined.withColumns(
        {
            "first": F.when(store_kind, first_order(rows))
            .when(challenge_kind, F.coalesce(flag, F.lit(False)))
            .otherwise(flag),
            "event": F.when(
                challenge_kind, corrected_event(F.col("event"), F.col("service_type"), names)
            ).otherwise(F.col("event")),
        }
    )
    return spread_distinct(with_event_date(enriched))

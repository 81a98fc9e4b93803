"""The daily jobs: read snapshots, apply operators, write snapshots.

Each job is idempotent: it reads days it does not write and replaces what it
writes, so a day can be run again. The caller gives ``as_of``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import (
    EVENT_COLUMNS,
    GROUP_KEYS,
    SENTINELS,
    EventNames,
    FunnelEvents,
    LtvRules,
    PERIODS,
    ServiceRules,
)
from ..functions import days_before, id_values
from ..operators import adchannels, clean, dedup, enrich, funnel, identity, ltv, marts, metrics, rollup
from ..sources import scans, sinks


#: Files of the running state. A job of as many tasks should fit the cluster for years, as a state keeps its number.
STATE_BUCKETS = 512


@dataclass(frozen=True)
class Lake:
    """Where each table lies.

    Tables are kept by ``date``; those whose rows have a date of their
    own (cost sheets, pincrux exports) by ``file_date``.
    """

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        """All days."""
        return scans.read_all(spark, self.path(name))

    def day(self, spark: SparkSession, name: str, day: str | dt.date) -> DataFrame:
        """One day, which must be there."""
        return scans.read_period(spark, self.path(name), day, day)

    def latest(self, spark: SparkSession, name: str, as_of: str | dt.date) -> DataFrame:
        return scans.latest_snapshot(spark, self.path(name), as_of).drop("date")


@dataclass(frozen=True)
class EventCleaning:
    """Which columns the event log is repaired by."""

    id_column: str = "distinct_id"
    device_column: str = "device_id"
    order: tuple[str, ...] = ("time",)
    alternate_ids: tuple[str, ...] = ()
    merges: tuple[tuple[str, str], ...] = ()
    slash_pair: tuple[str, str] | None = None
    brand_flag: tuple[str, str] | None = None
    zero_amounts: tuple[tuple[str, str], ...] = ()
    id_list: str = "challenge_id"
    ints: tuple[str, ...] = ()
    flags: tuple[str, ...] = ("first",)
    excluded: tuple[str, ...] = ()
    keep: tuple[str, ...] = (*EVENT_COLUMNS, "device_id", "insert_id")
    sentinels: tuple[str, ...] = field(default_factory=lambda: tuple(SENTINELS))


def clean_events(raw: DataFrame, id_types: DataFrame, rules: EventCleaning = EventCleaning()) -> DataFrame:
    """Ids first, then relabels, then casts, then one row per event and insert id."""
    used = {*rules.keep, *rules.alternate_ids, *[c for pair in rules.merges for c in pair]}
    used |= {*(rules.slash_pair or ()), *[amount for _, amount in rules.zero_amounts]}
    used |= {rules.brand_flag[0]} if rules.brand_flag else set()
    df = clean.null_sentinels(clean.select_existing(raw, [c for c in raw.columns if c in used]), list(rules.sentinels))
    df = identity.use_alternate_id(df, rules.id_column, list(rules.alternate_ids))
    df = identity.map_ids(df, rules.device_column, rules.id_column, list(rules.order))
    df = clean.merge_columns(df, list(rules.merges))
    if rules.slash_pair:
        df = clean.join_with_slash(df, *rules.slash_pair)
    if rules.brand_flag:
        df = clean.prefix_flagged(df, *rules.brand_flag)
    for event, amount in rules.zero_amounts:
        df = clean.mark_zero_amount(df, event, amount)
    others = [c for c in df.columns if c != rules.id_list]
    df = df.select(*others, F.explode_outer(id_values(F.col(rules.id_list))).alias(rules.id_list))
    df = clean.prefix_by_membership(df, id_types, rules.id_list)
    df = clean.cast_ids_and_flags(df, list(rules.ints), list(rules.flags))
    df = clean.keep_known(df, rules.id_column, list(rules.excluded))
    return dedup.dedup_events(df)


def cleanse_events(
    spark: SparkSession, lake: Lake, as_of: str | dt.date, rules: EventCleaning = EventCleaning()
) -> None:
    """Raw events of the day to ``events``."""
    day = days_before(as_of, 0)
    raw = lake.day(spark, "raw_events", day).drop("date")
    types = lake.latest(spark, "challenge_mart", as_of).select("challenge_id", "service_type")
    sinks.save_day(clean_events(raw, types, rules), lake.path("events"), day)


def cleanse_ads(
    spark: SparkSession, lake: Lake, as_of: str | dt.date, channels: list[str], sheet_order: list[str]
) -> None:
    """Channel exports of 31 days to ``channel_report``, one rollup per period."""
    start, end = days_before(as_of, max(PERIODS.values())), days_before(as_of, 0)
    found = {c: _export(spark, lake, c, start, end) for c in channels}
    exports = {c: df for c, df in found.items() if df is not None}
    sheet = None
    if "pincrux" in channels:
        path = lake.path("raw_sheet_costs")
        sheet = scans.latest_snapshot(spark, path, as_of, date="file_date").drop("file_date")
    ads = adchannels.unify(exports, sheet, sheet_order)
    sinks.save_day(rollup.ad_rollup_periods(ads, as_of), lake.path("channel_report"), end, ("period",))


def _export(spark: SparkSession, lake: Lake, channel: str, start: dt.date, end: dt.date) -> DataFrame | None:
    """A channel's exports; None when it has no file in the period."""
    path = lake.path(f"raw_{channel}")
    try:
        if channel == "pincrux":
            return scans.read_period(spark, path, start, end, date="file_date").drop("file_date")
        df = scans.read_period(spark, path, start, end)
    except LookupError:
        return None
    return df.withColumn("date", F.col("date").cast("string")).withColumnRenamed("date", "Date")


def build_marts(
    spark: SparkSession, lake: Lake, as_of: str | dt.date, rules: ServiceRules = ServiceRules()
) -> None:
    """Latest relational snapshots to ``challenge_mart`` and ``store_mart``."""

    def latest(name: str) -> DataFrame:
        return lake.latest(spark, f"raw_{name}", as_of)

    base = marts.challenge_base(
        latest("challenge"),
        latest("goal"),
        latest("goal_category"),
        latest("user_challenge"),
        latest("challenge_result"),
        latest("challenge_info"),
    )
    products = marts.commerce_products(latest("commerce_product"), latest("challenge_commerce"), latest("product"))
    day = days_before(as_of, 0)
    sinks.save_day(marts.challenge_mart(base, products, rules), lake.path("challenge_mart"), day)
    stores = marts.store_mart(latest("store_order"), latest("store_item"), latest("store_option"))
    sinks.save_day(stores, lake.path("store_mart"), day)


def kept_days(
    spark: SparkSession,
    lake: Lake,
    source: str,
    target: str,
    as_of: str | dt.date,
    make: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """What ``make`` gives of each day of ``source`` in the longest period, kept by day in ``target``.

    ``make`` keeps the column ``date``. A day is made when it is missing, or when its source was replaced since: on
    an ordinary day that is the new day alone, and no other day of ``source`` is opened.
    Days in plain folders have no version; they are made once, and the newest day each time.
    """
    first, last = days_before(as_of, max(PERIODS.values()) - 1), days_before(as_of, 0)
    there = scans.days_of(spark, lake.path(source), first, last)
    if not there:
        raise LookupError(f"no {source} from {first} to {last}")
    made = scans.days_of(spark, lake.path(target), first, last)
    stale = {}
    for day, version in there.items():
        origin, kept = version.name if version else "plain", made.get(day)
        if kept is None or kept.origin != origin or (version is None and day == str(last)):
            stale[day] = origin
    if stale:
        new = scans.read_days(spark, lake.path(source), {day: there[day] for day in stale})
        sinks.save_days(make(new), lake.path(target), stale)
    return scans.read_period(spark, lake.path(target), first, last).where(F.col("date").cast("string").isin(*there))


VALUE_COLUMNS = ["revenue", "revenue_from_brand", "revenue_from_challenge"]
FLAG_COLUMNS = ["first", "is_brand", "is_corp"]


def enrich_day(spark: SparkSession, lake: Lake, as_of: str | dt.date, names: EventNames = EventNames()) -> None:
    """Cleansed events of two days, cut to the local day, to ``event_report``."""
    day = days_before(as_of, 0)
    events = scans.read_period(spark, lake.path("events"), days_before(as_of, 1), day)
    # Without their insert ids, rows of one event are equal.
    events = clean.select_existing(events, EVENT_COLUMNS).dropDuplicates()
    users = enrich.all_users(*[lake.latest(spark, f"raw_users_{k}", as_of) for k in ("challenge", "store")])
    challenges = lake.latest(spark, "challenge_mart", as_of)
    stores = lake.latest(spark, "store_mart", as_of).select("order_no", "revenue")
    rows = enrich.enrich(events, users, challenges, stores, names).where(F.col("event_date") == day)
    sinks.save_day(sinks.typed(rows, VALUE_COLUMNS, FLAG_COLUMNS), lake.path("event_report"), day)


def report_campaigns(
    spark: SparkSession, lake: Lake, as_of: str | dt.date, names: EventNames = EventNames()
) -> None:
    """A month of enriched events and the day's ad report to ``campaign_report``.

    Each day's events are summed per user once, into ``activity``; the report
    reads those sums, and the events of the new day alone.
    """
    day = days_before(as_of, 0)

    def summed(rows: DataFrame) -> DataFrame:
        return metrics.day_activity(rows, ["date", *GROUP_KEYS], names)

    days = kept_days(spark, lake, "event_report", "activity", as_of, summed)
    ads = lake.day(spark, "channel_report", day)
    report = metrics.campaign_report_of_days(days, as_of, ad_report=ads, names=names)
    sinks.save_report(report, lake.path("campaign_report"), day)


def report_funnel(
    spark: SparkSession, lake: Lake, as_of: str | dt.date, names: FunnelEvents = FunnelEvents()
) -> None:
    """The day's attribution files to ``attribution``, their steps to ``funnel_steps``, and a month of those to ``funnel``."""
    day = days_before(as_of, 0)
    files = scans.read_attribution(spark, lake.path("raw_attribution"), as_of)
    sinks.save_day(scans.shape_attribution(files), lake.path("attribution"), day)
    days = kept_days(spark, lake, "attribution", "funnel_steps", as_of, lambda rows: funnel.day_steps(rows, names, ("date",)))
    sinks.save_day(funnel.funnel_of_days(days, as_of), lake.path("funnel"), day, ("period",))


def accumulate_ltv(
    spark: SparkSession,
    lake: Lake,
    as_of: str | dt.date,
    first_day: bool = False,
    names: EventNames = EventNames(),
    rules: LtvRules = LtvRules(),
    buckets: int = STATE_BUCKETS,
) -> None:
    """Yesterday's ``ltv`` state and today's enriched events to today's state.

    Only the first day may start from nothing: a missing state is an error. The state is kept in
    ``buckets`` by user, a number that a table keeps; a day's work moves what changes, not the state.
    """
    day = days_before(as_of, 0)
    state = ltv.empty_state(spark) if first_day else scans.read_state(spark, lake.path("ltv"), days_before(as_of, 1))
    if ltv.STATE_KEY not in state.columns:
        state = ltv.keyed_state(state)
    events = lake.day(spark, "event_report", day)
    info = lake.latest(spark, "user_info", as_of)
    new = ltv.advance(state, events, info, as_of, names, rules)
    sinks.save_bucketed_day(new, lake.path("ltv"), day, ltv.STATE_KEY, buckets)

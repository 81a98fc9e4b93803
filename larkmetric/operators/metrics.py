"""Campaign metrics (AGG-2 … AGG-20) and report assembly (JOIN-10, JOIN-11)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import AD_REPORT_METRICS, GROUP_KEYS, ORGANIC, PERIODS, EventNames
from ..functions import days_before, exact_sum, limb_sums, limbs, unquote
from ..functions.numbers import MONEY, money_sum
from .clean import within_days


#: Active days are bits of one bigint.
DAY_BITS = 63


@dataclass(frozen=True)
class CountMetric:
    """Users and events of one kind; the column names are the report's."""

    event: str
    users: str
    events: str
    first: str | None = None  # None, "flag" (column first) or "order" (order_count = 1)

    def hit(self) -> Column:
        same = F.col("event") == self.event
        if self.first == "flag":
            same = same & F.col("first")
        elif self.first == "order":
            same = same & (F.col("order_count").try_cast("double") == 1)
        return F.coalesce(same, F.lit(False))


def count_metrics(names: EventNames = EventNames()) -> dict[str, CountMetric]:
    def pair(stem: str) -> tuple[str, str]:
        return f"unique_{stem}", f"count_{stem}"

    def checkout(stem: str) -> tuple[str, str]:
        return f"{stem}_user_count", f"{stem}_count"

    return {
        "installs": CountMetric(names.install, *pair("installs")),
        "signups": CountMetric(names.signup, *pair("signups")),
        "invites": CountMetric(names.invite, *pair("invites")),
        "store_checkouts": CountMetric(names.store_checkout, *pair("store_checkouts")),
        "first_store_checkouts": CountMetric(
            names.store_checkout, *pair("first_store_checkouts"), first="order"
        ),
        "challenge_checkouts": CountMetric(names.challenge, *checkout("challenge_complete_checkout")),
        "brand_checkouts": CountMetric(names.brand, *checkout("challenge_complete_checkout_brand")),
        "first_challenge_checkouts": CountMetric(
            names.challenge, *checkout("first_challenge_complete_checkout"), first="flag"
        ),
        "first_brand_checkouts": CountMetric(
            names.brand, *checkout("first_challenge_complete_checkout_brand"), first="flag"
        ),
    }


def store_count_metrics(names: EventNames = EventNames()) -> dict[str, CountMetric]:
    """Store purchases by completion; defined, but no part of the report."""
    stem = "store_complete_checkout"
    return {
        "store_complete": CountMetric(names.store, f"{stem}_user_count", f"{stem}_count"),
        "first_store_complete": CountMetric(
            names.store, f"first_{stem}_user_count", f"first_{stem}_count", first="flag"
        ),
    }


def revenue_metrics(names: EventNames = EventNames()) -> dict[str, str]:
    """Revenue column -> event."""
    return {
        "challenge_revenue": names.challenge,
        "challenge_brand_revenue": names.brand,
        "store_revenue": names.store,
    }


def with_organic_keys(df: DataFrame, keys: list[str] = GROUP_KEYS) -> DataFrame:
    """Missing keys become ``organic`` before grouping, so each group is one row.

    ``keyed`` keeps whether all of them were there.
    """
    keyed = F.lit(True)
    for key in keys:
        keyed = keyed & F.col(key).isNotNull()
    return df.withColumns(
        {**{k: F.coalesce(k, F.lit(ORGANIC)) for k in keys}, "keyed": keyed}
    )


# --- one metric at a time ------------------------------------------------------


def event_counts(events: DataFrame, metric: CountMetric, keys: list[str] = GROUP_KEYS) -> DataFrame:
    """Unique users and rows with a time, per group that has the event at all.

    Rows are summed per user first, which spreads a group with most of the rows
    over its users.
    """
    per_user = (
        with_organic_keys(events.where(metric.hit()), keys)
        .groupBy(*keys, "distinct_id")
        .agg(F.count("time").alias("n"))
    )
    return per_user.groupBy(*keys).agg(
        F.count("distinct_id").alias(metric.users), F.sum("n").alias(metric.events)
    )


def active_users(events: DataFrame, keys: list[str] = GROUP_KEYS) -> DataFrame:
    """Unique users per group."""
    grouped = with_organic_keys(events, keys).groupBy(*keys)
    return grouped.agg(F.count_distinct("distinct_id").alias("mau"))


def daily_users(events: DataFrame, keys: list[str] = GROUP_KEYS) -> DataFrame:
    """Mean over the days with activity of each day's unique users.

    Rows with a missing key are left out.
    """
    kept = with_organic_keys(events, keys).where(F.col("keyed") & F.col("event_date").isNotNull())
    per_day = kept.groupBy(*keys, "event_date").agg(F.count_distinct("distinct_id").alias("n"))
    return per_day.groupBy(*keys).agg((F.sum("n") / F.count("n")).alias("dau"))


def revenue_of(
    events: DataFrame, kinds: list[str], name: str, keys: list[str] = GROUP_KEYS, keyed_only: bool = False
) -> DataFrame:
    """Revenue of some events; a group with no revenue value sums to 0."""
    rows = with_organic_keys(events.where(F.col("event").isin(*kinds)), keys)
    if keyed_only:
        rows = rows.where("keyed")
    return rows.groupBy(*keys).agg(exact_sum(F.col("revenue")).alias(name))


# --- all metrics, levels and periods in one pass -------------------------------


def _sums(names: EventNames) -> list[Column]:
    """What a user's events add up to; such sums of parts add up to the sums of all.

    An amount that a decimal of common size does not hold whole leaves the rest in a double beside it.
    """
    counts = [F.count_if(m.hit()).alias(k) for k, m in count_metrics(names).items()]
    money_rows = []
    for name, event in revenue_metrics(names).items():
        first, *others = limb_sums(limbs(F.when(F.col("event") == event, F.col("revenue"))))
        others = [F.coalesce(part.cast("double"), F.lit(0.0)) for part in others]
        money_rows += [
            first.alias(name),
            F.nullif(others[2] + others[1] + others[0], F.lit(0.0)).alias(f"{name}_other"),
            F.count_if(F.col("event") == event).alias(f"{name}_rows"),
        ]
    return [*counts, *money_rows]


def _banded(days: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Rows of the longest period with their day band, and the bit of their day.

    Bands (the day itself, the rest of the week, the rest of the month) do not overlap.
    """
    back = F.datediff(F.lit(days_before(as_of, 0)), F.col("event_date"))
    edges = sorted(PERIODS.values())
    if edges[-1] > DAY_BITS:
        raise ValueError(f"a period has more than {DAY_BITS} days")
    band = F.when(back < edges[0], F.lit(edges[0]))
    for edge in edges[1:]:
        band = band.when(back < edge, F.lit(edge))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), back)
    return within_days(days, as_of, edges[-1]).withColumns({"band": band, "_bit": bit})


def user_activity(
    events: DataFrame, as_of: str | dt.date, keys: list[str], names: EventNames = EventNames()
) -> DataFrame:
    """Counts and sums per user, keys and day band of the longest period.

    Each event counts once here; ``days`` has one bit per active day.
    """
    rows = _banded(events, as_of).groupBy(*keys, "distinct_id", "band")
    return rows.agg(*_sums(names), F.bit_or("_bit").alias("days"))


def day_activity(events: DataFrame, keys: list[str] = GROUP_KEYS, names: EventNames = EventNames()) -> DataFrame:
    """Counts and sums per user, keys and day: what is kept of a day for the reports of the next month."""
    dated = events.where(F.col("event_date").isNotNull())
    return dated.groupBy(*keys, "distinct_id", "event_date").agg(*_sums(names))


def merged_activity(
    days: DataFrame, as_of: str | dt.date, keys: list[str] = GROUP_KEYS, names: EventNames = EventNames()
) -> DataFrame:
    """As :func:`user_activity`, from the rows of :func:`day_activity` of the days of the longest period.

    A day's bit is its distance from ``as_of``, so it moves up as days pass.
    """
    revenue = revenue_metrics(names)
    sums = [F.sum(c).alias(c) for c in (*count_metrics(names), *[f"{r}_rows" for r in revenue])]
    amounts = [a for r in revenue for a in (money_sum(F.col(r)).alias(r), F.sum(f"{r}_other").alias(f"{r}_other"))]
    rows = _banded(days, as_of).groupBy(*keys, "distinct_id", "band")
    return rows.agg(*sums, *amounts, F.bit_or("_bit").alias("days"))


def campaign_report(
    events: DataFrame,
    as_of: str | dt.date,
    users: DataFrame | None = None,
    ad_report: DataFrame | None = None,
    names: EventNames = EventNames(),
) -> DataFrame:
    """Metrics per period and level, with ad spend where an ad report is given; keys are URL-decoded.

    ``events`` carry media_source and campaign, or ``users`` holds them: then
    events are summed per user before the join, so a user with very many
    events brings at most one row per day band to it.
    """
    keys = GROUP_KEYS if users is None else []
    return _report(user_activity(events, as_of, keys, names), as_of, users, ad_report, names)


def campaign_report_of_days(
    days: DataFrame,
    as_of: str | dt.date,
    users: DataFrame | None = None,
    ad_report: DataFrame | None = None,
    names: EventNames = EventNames(),
) -> DataFrame:
    """The same report from the kept rows of :func:`day_activity`, without keys where ``users`` holds them."""
    keys = GROUP_KEYS if users is None else []
    return _report(merged_activity(days, as_of, keys, names), as_of, users, ad_report, names)


def _report(
    activity: DataFrame, as_of: str | dt.date, users: DataFrame | None, ad_report: DataFrame | None, names: EventNames
) -> DataFrame:
    if users is not None:
        activity = activity.join(users.select("distinct_id", *GROUP_KEYS), "distinct_id", "left")
    report = _assemble(activity, names).withColumn("date", F.lit(days_before(as_of, 0)))
    if ad_report is not None:
        report = with_ad_report(report, ad_report, as_of)
    return report.withColumns({k: unquote(F.col(k)) for k in GROUP_KEYS})


def _assemble(activity: DataFrame, names: EventNames) -> DataFrame:
    """All periods and levels from the users' activity.

    Rows meet by user, once, as few as there are day bands; there, within their task, each is spread into one
    row per period. These are summed per user and campaign, then per user and source, and both are grouped from there.
    """
    source, campaign = (F.col(k) for k in GROUP_KEYS)
    organic = F.lit(ORGANIC)
    counts, revenue = count_metrics(names), revenue_metrics(names)
    any_rows = sum((F.col(f"{r}_rows") for r in revenue), F.lit(0))
    parts = [F.coalesce(F.col(r).try_cast(MONEY), F.lit(0).cast(MONEY)) for r in revenue]
    any_revenue = parts[0]
    for part in parts[1:]:
        any_revenue = any_revenue + part
    any_other = F.nullif(sum((F.coalesce(F.col(f"{r}_other"), F.lit(0.0)) for r in revenue), F.lit(0.0)), F.lit(0.0))
    keyed = {"campaign": source.isNotNull() & campaign.isNotNull(), "media_source": source.isNotNull()}

    def combined(name: str) -> str:
        """How the rows of one user add up."""
        if name.startswith("days "):
            return "or"
        return "money" if name.removesuffix(" media_source").removesuffix(" campaign") in (*revenue, "revenue") else "sum"

    def fold(column: Column, name: str) -> Column:
        how = {"or": F.bit_or, "money": money_sum, "sum": F.sum}[combined(name)]
        return how(column)

    beside = [f"{r}{end}" for r in revenue for end in ("_rows", "_other")]
    values: dict[str, Column] = {c: F.col(c) for c in (*counts, *revenue, *beside)}
    for level, has in keyed.items():
        values[f"revenue {level}"] = F.when(has, any_revenue)
        values[f"revenue_other {level}"] = F.when(has, any_other)
        values[f"revenue_rows {level}"] = F.when(has, any_rows)
        values[f"days {level}"] = F.when(has, F.col("days"))
    periods = F.array(*[F.struct(F.lit(p).alias("period"), F.lit(days).alias("_reach")) for p, days in PERIODS.items()])
    users = activity.repartition("distinct_id").select(
        "distinct_id",
        F.coalesce(source, organic).alias("g_source"),
        F.coalesce(campaign, organic).alias("g_campaign"),
        "band",
        *[v.alias(n) for n, v in values.items()],
        F.inline(periods),
    )
    # A row counts in the periods its band lies in; in the others its user is still one of the month.
    spread = users.select(
        "period", "distinct_id", "g_source", "g_campaign", *[F.when(F.col("band") <= F.col("_reach"), F.col(n)).alias(n) for n in values]
    )

    def per_user(rows: DataFrame, *group: str) -> DataFrame:
        return rows.groupBy("distinct_id", "period", *group).agg(*[fold(F.col(n), n).alias(n) for n in values])

    per_campaign = per_user(spread, "g_source", "g_campaign")
    per_source = per_user(per_campaign, "g_source")

    def groups(rows: DataFrame, level: str, group: list[str]) -> DataFrame:
        known = F.col("distinct_id").isNotNull()
        days = F.col(f"days {level}")
        day_users = F.coalesce(F.sum(F.when(known, F.bit_count(days))), F.lit(0))
        out = [F.count("distinct_id").alias("mau"), (day_users / F.bit_count(F.bit_or(days))).alias("dau")]

        def revenue_sum(name: str, value: str, other: str, n: str) -> Column:
            total = F.coalesce(money_sum(F.col(value)), F.lit(0)).cast("double") + F.coalesce(F.sum(other), F.lit(0.0))
            return F.when(F.sum(n) > 0, total).alias(name)

        for key, metric in counts.items():
            seen = F.sum(key) > 0
            out.append(F.when(seen, F.count_if((F.col(key) > 0) & known)).alias(metric.users))
            out.append(F.when(seen, F.sum(key)).alias(metric.events))
        out.append(revenue_sum("revenue", *(f"revenue{x} {level}" for x in ("", "_other", "_rows"))))
        out += [revenue_sum(r, r, f"{r}_other", f"{r}_rows") for r in revenue]
        name = F.col("g_campaign") if "g_campaign" in group else F.lit(None).cast("string")
        found = rows.groupBy("period", *group).agg(*out)
        keys = ["period", F.lit(level).alias("level"), F.col("g_source").alias("media_source"), name.alias("campaign")]
        return found.select(*keys, *[c for c in found.columns if c not in ("period", *group)])

    return groups(per_campaign, "campaign", ["g_source", "g_campaign"]).unionByName(
        groups(per_source, "media_source", ["g_source"])
    )


def ad_report_slots(ad_report: DataFrame) -> DataFrame:
    """The rollup's channel and campaign rows under the report's keys."""
    channel = F.col("key") == "channel"
    return ad_report.where(F.col("key").isin("channel", "campaign")).select(
        "period",
        F.when(channel, F.lit("media_source")).otherwise(F.lit("campaign")).alias("level"),
        F.when(channel, F.col("value")).otherwise(F.col("channel")).alias("media_source"),
        F.when(~channel, F.col("value")).alias("campaign"),
        *AD_REPORT_METRICS,
    )


def with_ad_report(report: DataFrame, ad_report: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Full outer join on period, level and keys.

    Both sides have one row per key. Keys are compared null-safe, as the
    media_source level has no campaign.
    """
    ads = ad_report_slots(ad_report)
    keys = ["period", "level", *GROUP_KEYS]
    on = [report[k].eqNullSafe(ads[k]) for k in keys]
    return report.join(ads, on, "full_outer").select(
        *[F.coalesce(report[k], ads[k]).alias(k) for k in keys],
        *[report[c] for c in report.columns if c not in keys and c != "date"],
        *[ads[c] for c in AD_REPORT_METRICS],
        F.lit(days_before(as_of, 0)).alias("date"),
    )

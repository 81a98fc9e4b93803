"""Install funnel (FUN-1, FUN-2, SET-4, JOIN-14, NULL-1)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import PERIODS, FunnelEvents
from ..functions import days_before, percent
from .clean import within_days

VISIT, INSTALL, SIGNUP, VIEW, PURCHASE, STORE = (1 << i for i in range(6))
STEP_BITS = 6
SUFFIX = {"device": "", "user": "_uid"}


def step_members(events: DataFrame, id_col: str, have: str, among: str) -> DataFrame:
    """Ids with event ``have`` that also have event ``among``."""

    def ids(event: str) -> DataFrame:
        return events.where((F.col("event") == event) & F.col(id_col).isNotNull()).select(id_col)

    return ids(have).intersect(ids(among))


def _steps(names: FunnelEvents) -> Column:
    event = F.col("event")
    return F.lit(VISIT).bitwiseOR(
        F.when(event == names.install, F.lit(INSTALL))
        .when(event == names.signup, F.lit(SIGNUP))
        .when(event == names.view, F.lit(VIEW))
        .when(event == names.purchase, F.lit(PURCHASE))
        .when(event == names.store_purchase, F.lit(STORE))
        .otherwise(F.lit(0))
    )


def _per_kind(events: DataFrame, names: FunnelEvents, by: tuple[str, ...] = ()) -> DataFrame:
    """``event_date``, ``kind``, ``id``, ``steps``: a row of each kind of id for each event."""
    ids = F.array(
        F.struct(F.lit("device").alias("kind"), F.col("appsflyer_id").alias("id")),
        F.struct(F.lit("user").alias("kind"), F.col("user_id").alias("id")),
    )
    return events.select(*by, "event_date", _steps(names).alias("steps"), F.inline(ids))


def day_steps(events: DataFrame, names: FunnelEvents = FunnelEvents(), by: tuple[str, ...] = ()) -> DataFrame:
    """The steps of each id on each day: what is kept of a day for the funnels of the next month."""
    dated = _per_kind(events.where(F.col("event_date").isNotNull()), names, by)
    return dated.groupBy(*by, "event_date", "kind", "id").agg(F.bit_or("steps").alias("steps"))


def funnel(
    events: DataFrame,
    as_of: str | dt.date,
    names: FunnelEvents = FunnelEvents(),
    null_as_value: bool = False,
) -> DataFrame:
    """Step sizes and conversion per period, by device id and by user id.

    Each id's steps are bits of one number, OR-ed per id in one shuffle for
    both kinds of id and all periods. A conversion counts ids that have both
    steps, in any order. A period is given only if the data reaches back far
    enough: the month if the first day is there exactly, the others if some day is
    old enough. ``null_as_value`` counts missing ids as one id named ``None``.
    """
    window = within_days(events, as_of, max(PERIODS.values()))
    return funnel_of_days(_per_kind(window, names), as_of, null_as_value)


def funnel_of_days(days: DataFrame, as_of: str | dt.date, null_as_value: bool = False) -> DataFrame:
    """The same funnel from the kept rows of :func:`day_steps`."""
    if len(PERIODS) * STEP_BITS > 31:
        raise ValueError("the steps of so many periods do not fit one number")
    word = F.lit(0).cast("int")
    for i, period in enumerate(PERIODS.values()):
        inside = F.col("event_date") >= days_before(as_of, period - 1)
        word = word.bitwiseOR(F.when(inside, F.shiftleft("steps", i * STEP_BITS)).otherwise(F.lit(0)))
    ident = F.coalesce("id", F.lit("None")) if null_as_value else F.col("id")
    per_id = (
        within_days(days, as_of, max(PERIODS.values()))
        .select("event_date", word.alias("word"), "kind", ident.alias("id"))
        .groupBy("kind", "id")
        .agg(F.bit_or("word").alias("word"), F.min("event_date").alias("first_day"))
    )
    slots = F.array(
        *[
            F.struct(
                F.lit(period).alias("period"),
                F.lit(days_before(as_of, days - 1)).alias("start"),
                F.shiftright("word", i * STEP_BITS).bitwiseAND(F.lit((1 << STEP_BITS) - 1)).alias("steps"),
            )
            for i, (period, days) in enumerate(PERIODS.items())
        ]
    )

    def ids_with(kind: str, *bits: int) -> Column:
        need = F.lit(sum(bits))
        return F.count_if(
            (F.col("kind") == kind)
            & F.col("id").isNotNull()
            & (F.col("steps").bitwiseAND(need) == need)
        )

    totals = {
        "total_visit": (VISIT,),
        "total_install": (INSTALL,),
        "total_install_signup": (INSTALL, SIGNUP),
        "total_signup_view": (SIGNUP, VIEW),
        "total_view_purchase": (VIEW, PURCHASE),
        "total_view_store_purchase": (VIEW, STORE),
    }
    lengths = {"install_{}_len": INSTALL, "signup_{}_len": SIGNUP, "view_{}_len": VIEW}
    aggs = [
        ids_with(kind, *bits).alias(name + suffix)
        for name, bits in totals.items()
        for kind, suffix in SUFFIX.items()
    ] + [
        ids_with(kind, bit).alias(name.format("ids" if kind == "device" else "uids"))
        for name, bit in lengths.items()
        for kind in SUFFIX
    ]
    sizes = (
        per_id.select("kind", "id", "first_day", F.inline(slots))
        .groupBy("period", "start")
        .agg(F.min("first_day").alias("first_day"), *aggs)
    )
    ratios = {
        "install_signup": "install_{}_len",
        "signup_view": "signup_{}_len",
        "view_purchase": "view_{}_len",
        "view_store_purchase": "view_{}_len",
    }
    sizes = sizes.withColumns(
        {
            name + suffix: percent(
                F.col(f"total_{name}{suffix}"), F.col(whole.format("ids" if kind == "device" else "uids"))
            )
            for name, whole in ratios.items()
            for kind, suffix in SUFFIX.items()
        }
    )
    month = max(PERIODS, key=PERIODS.get)
    far_enough = F.when(F.col("period") == month, F.col("first_day") == F.col("start")).otherwise(
        F.col("first_day") <= F.col("start")
    )
    return sizes.where(far_enough).drop("first_day", "start").withColumn("date", F.lit(days_before(as_of, 0)))

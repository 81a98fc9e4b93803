"""Campaign metrics against a plain Python count, and report assembly."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from larkmetric.config import EventNames, PERIODS
from larkmetric.functions import days_before
from larkmetric.operators import enrich, metrics, rollup

NAMES = EventNames()
AS_OF = "2024-01-30"
SCHEMA = (
    "event string, distinct_id string, media_source string, campaign string, event_date date, time bigint, "
    "first boolean, order_count string, revenue double"
)


def make_events(seed, n=1500, hot=0.34):
    """Random events; a third of them of one user under one source."""
    rng = random.Random(seed)
    kinds = [NAMES.install, NAMES.signup, NAMES.invite, NAMES.challenge, NAMES.brand, NAMES.store, "other", None]
    out = []
    for i in range(n):
        is_hot = rng.random() < hot
        out.append(
            (
                rng.choice(kinds),
                "u0" if is_hot else rng.choice([f"u{rng.randrange(60)}", None]),
                "src" if is_hot else rng.choice(["src", "src2", None, "organic"]),
                rng.choice(["c1", "c2", None]),
                dt.date(2024, 1, 30) - dt.timedelta(rng.randrange(35)) if rng.random() < 0.8 else dt.date(2024, 1, 30),
                i,
                rng.choice([True, False, None]),
                rng.choice(["1.0", "1", "2", "None", None]),
                rng.choice([None, rng.randrange(1, 10**6) / 100]),
            )
        )
    return out


def brute(events, period, level):
    """The report by definition, one group at a time."""
    start, end = days_before(AS_OF, PERIODS[period] - 1), days_before(AS_OF, 0)
    month = [e for e in events if days_before(AS_OF, 29) <= e[4] <= end]

    def key(e):
        source = e[2] or "organic"
        return (source, e[3] or "organic") if level == "campaign" else (source, None)

    def keyed(e):
        return e[2] is not None and (level != "campaign" or e[3] is not None)

    out = {}
    for group in {key(e) for e in month}:
        mine = [e for e in month if key(e) == group]
        inside = [e for e in mine if start <= e[4]]
        row = {"mau": len({e[1] for e in mine} - {None})}
        days = {e[4] for e in inside if keyed(e)}
        users = [len({e[1] for e in inside if keyed(e) and e[4] == d} - {None}) for d in days]
        row["dau"] = sum(users) / len(users) if users else None
        for name, metric in metrics.count_metrics().items():
            hits = [e for e in inside if e[0] == metric.event]
            if metric.first == "flag":
                hits = [e for e in hits if e[6]]
            elif metric.first == "order":
                hits = [e for e in hits if e[7] in ("1.0", "1")]
            row[metric.users] = len({e[1] for e in hits} - {None}) if hits else None
            row[metric.events] = len(hits) if hits else None
        for name, event in metrics.revenue_metrics().items():
            hits = [e for e in inside if e[0] == event]
            row[name] = round(sum(e[8] or 0 for e in hits), 2) if hits else None
        paid = [e for e in inside if keyed(e) and e[0] in metrics.revenue_metrics().values()]
        row["revenue"] = round(sum(e[8] or 0 for e in paid), 2) if paid else None
        out[group] = row
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_report_against_brute_force(spark, seed):
    events = make_events(seed)
    report = metrics.campaign_report(spark.createDataFrame(events, SCHEMA), AS_OF).collect()
    for period in PERIODS:
        for level in ("campaign", "media_source"):
            mine = [r.asDict() for r in report if r.period == period and r.level == level]
            got = {(r["media_source"], r["campaign"]): r for r in mine}
            want = brute(events, period, level)
            assert set(got) == set(want)
            for group, row in want.items():
                for name, value in row.items():
                    assert got[group][name] == (value if value is None else pytest.approx(value)), (period, group, name)


def test_users_joined_late_give_the_same_report(spark, rows):
    events = [e for e in make_events(5)]
    df = spark.createDataFrame(events, SCHEMA).drop("media_source", "campaign")
    users = spark.createDataFrame(
        [(f"u{i}", f"s{i % 3}" if i % 4 else None, f"c{i % 2}") for i in range(55)] + [("u0", "s9", "c9")],
        "distinct_id string, media_source string, campaign string",
    )
    early = metrics.campaign_report(df.join(users, "distinct_id", "left"), AS_OF)
    late = metrics.campaign_report(df, AS_OF, users=users)
    assert rows(late) == rows(early.select(late.columns))


def test_single_metrics_match_the_report(spark, rows):
    df = spark.createDataFrame(make_events(8), SCHEMA)
    month = df.where(F.col("event_date").between("2024-01-01", AS_OF))
    report = metrics.campaign_report(df, AS_OF).where("period = 'monthly' and level = 'campaign'")
    keys = ["media_source", "campaign"]
    for metric in metrics.count_metrics().values():
        one = metrics.event_counts(month, metric)
        picked = report.where(F.col(metric.events).isNotNull()).select(one.columns)
        assert rows(one) == rows(picked)
    assert rows(metrics.active_users(month)) == rows(report.select(*keys, "mau"))
    assert rows(metrics.daily_users(month)) == rows(report.where("dau is not null").select(*keys, "dau"))


def test_real_and_filled_organic_are_one_group(spark, rows):
    df = spark.createDataFrame([("organic", "u1"), (None, "u1"), (None, "u2")], "media_source string, distinct_id string")
    assert rows(metrics.active_users(df, ["media_source"])) == [("organic", 2)]


def test_daily_users_average_over_active_days(spark, rows):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 20)
    data = [("s", "u1", d1), ("s", "u2", d1), ("s", "u1", d2), (None, "u3", d2), ("s", None, d2)]
    df = spark.createDataFrame(data, "media_source string, distinct_id string, event_date date")
    assert rows(metrics.daily_users(df, ["media_source"])) == [("s", 1.5)]


def test_revenue_of_missing_values_is_zero(spark, rows):
    df = spark.createDataFrame([("e", "s", None)], "event string, media_source string, revenue double")
    assert rows(metrics.revenue_of(df, ["e"], "r", ["media_source"])) == [("s", 0.0)]
    assert rows(metrics.revenue_of(df, ["x"], "r", ["media_source"])) == []


def test_ad_report_joins_both_ways(spark):
    events = spark.createDataFrame(
        [("e", "u1", "fb", "sale%20now", dt.date(2024, 1, 30), 1, None, None, None)], SCHEMA
    )
    ads = spark.createDataFrame(
        [("fb", "sale%20now", 3.0, 1.0, 1.0), ("px", "100%+", 5.0, 1.0, 1.0)],
        "channel string, campaign string, spend double, impressions double, clicks double",
    ).selectExpr("*", "cast(null as string) adset", "cast(null as string) ad", "date'2024-01-30' date")
    out = metrics.campaign_report(events, AS_OF, ad_report=rollup.ad_rollup_periods(ads, AS_OF))
    got = {(r.level, r.media_source, r.campaign): (r.mau, r.spend) for r in out.where("period = 'daily'").collect()}
    assert got == {
        ("media_source", "fb", None): (1, 3.0),
        ("media_source", "px", None): (None, 5.0),
        ("campaign", "fb", "sale now"): (1, 3.0),
        ("campaign", "px", "100%+"): (None, 5.0),
    }
    assert {str(r.date) for r in out.collect()} == {AS_OF}


def test_enrich(spark):
    events = spark.createDataFrame(
        [
            (NAMES.challenge, "u1", "1", "True", None, None, 1706572800 + 9 * 3600),
            (NAMES.brand, "u1", "2", None, None, None, 1706572800),
            (NAMES.challenge, "u2", "3", "False", None, None, 1706572800),
            (NAMES.store, "u2", None, None, "7", "1.0", 1706572800),
            (NAMES.store, "u2", None, "True", "8", "1", 1706572800),
            ("view", "u3", "1", None, "7", None, 1706572800),
            (None, None, None, None, None, None, 1706572800),
        ],
        "event string, distinct_id string, challenge_id string, first string, order_no string, order_count string, time bigint",
    )
    users = spark.createDataFrame(
        [("u1", None, "fb", "test"), ("u2", None, "fb", "c"), ("u2", None, "gg", "c")],
        "distinct_id string, corp_name string, media_source string, campaign string",
    )
    mart = spark.createDataFrame(
        [("1", 1, True, False, 10.0, 1.0, 11.0), ("2", 2, False, False, 0.0, 2.0, 2.0), ("3", 3, False, True, 0.0, 3.0, 3.0)],
        "challenge_id string, service_type int, is_brand boolean, is_corp boolean, revenue_from_brand double, "
        "revenue_from_challenge double, revenue double",
    )
    stores = spark.createDataFrame([("7", 70.0)], "order_no string, revenue double")
    out = enrich.enrich(events, enrich.all_users(users, users), mart, stores).collect()
    got = sorted(
        ((r.event, r.distinct_id, r.media_source, r.campaign, r.first, r.revenue) for r in out), key=str
    )
    assert got == sorted(
        [
            (NAMES.brand, "u1", "fb", None, True, 11.0),
            (NAMES.challenge, "u1", "fb", None, False, 2.0),
            (NAMES.corp, "u2", "fb", "c", False, 3.0),
            (NAMES.corp, "u2", "gg", "c", False, 3.0),
            (NAMES.store, "u2", "fb", "c", True, 70.0),
            (NAMES.store, "u2", "gg", "c", True, 70.0),
            (NAMES.store, "u2", "fb", "c", False, None),
            (NAMES.store, "u2", "gg", "c", False, None),
            ("view", "u3", None, None, None, None),
            (None, None, None, None, None, None),
        ],
        key=str,
    )
    assert {str(r.event_date) for r in out if r.event == NAMES.brand} == {"2024-01-30"}

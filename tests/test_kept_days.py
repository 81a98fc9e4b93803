"""Reports from what is kept of each day against reports over all events."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from larkmetric.config import PERIODS, EventNames, FunnelEvents
from larkmetric.operators import funnel, metrics, rollup
from larkmetric.plans import jobs
from larkmetric.sources import scans, sinks

NAMES, STEPS = EventNames(), FunnelEvents()
LAST = dt.date(2024, 2, 3)
EVENT = "event string, distinct_id string, media_source string, campaign string, time long, first boolean, order_count string, revenue double"
ADS = "channel string, campaign string, adset string, ad string, spend double, clicks double, impressions double, date date"


def events_of(day):
    rng = random.Random(str(day))
    kinds = [NAMES.install, NAMES.signup, NAMES.challenge, NAMES.brand, NAMES.store, NAMES.store_checkout, "view"]
    source = lambda user: (rng.choice(["fb", None]), rng.choice(["c1", "c%202", None]))
    return [
        (rng.choice(kinds), rng.choice([f"u{k}" for k in range(9)] + [None]), *source(0), rng.choice([5, None]), rng.choice([True, False, None]), rng.choice(["1", "2", None]), rng.choice([0.1, 2.5, None, float("nan")]))
        for _ in range(30)
    ]


@pytest.fixture
def lake(spark, tmp_path):
    lake = jobs.Lake(str(tmp_path))
    days = [LAST - dt.timedelta(back) for back in range(3, 35) if back != 7]  # one without events
    data = [(*r, day, day) for day in days for r in events_of(day)]
    sinks.save_snapshot(spark.createDataFrame(data, f"{EVENT}, event_date date, date date"), lake.path("event_report"))
    for back in range(3):
        day = LAST - dt.timedelta(back)
        ads = spark.createDataFrame([("fb", "c1", "s", "a", 1.5, 2.0, 3.0, day)], ADS)
        sinks.save_day(rollup.ad_rollup_periods(ads, day), lake.path("channel_report"), day, ("period",))
        rows = spark.createDataFrame(events_of(day), EVENT).withColumn("event_date", F.lit(day))
        sinks.save_day(rows, lake.path("event_report"), day)
    return lake


def test_reports_of_three_days(spark, rows, lake, monkeypatch):
    made = []
    real = metrics.day_activity
    monkeypatch.setattr(metrics, "day_activity", lambda df, *a: made.append({re.search("/date=([^/]*)/", f)[1] for f in df.inputFiles()}) or real(df, *a))
    read = []
    whole = metrics.campaign_report_of_days
    monkeypatch.setattr(metrics, "campaign_report_of_days", lambda days, *a, **kw: read.append(days.inputFiles()) or whole(days, *a, **kw))
    for n, back in enumerate((2, 1, 0)):
        day = LAST - dt.timedelta(back)
        del made[:]
        jobs.report_campaigns(spark, lake, day)
        first = day - dt.timedelta(max(PERIODS.values()) - 1)
        events = scans.read_period(spark, lake.path("event_report"), first, day).drop("date")
        want = metrics.campaign_report(events, day, ad_report=lake.day(spark, "channel_report", day))
        got = scans.read_period(spark, lake.path("campaign_report"), day, day)
        assert rows(got, *want.columns) == rows(want) and got.count() > 20
        # The first day makes all there are; later ones open the events of the new day alone.
        assert len(made) == 1 and (len(made[0]) == 29 if n == 0 else made[0] == {str(day)})
        assert read[-1] and all("/activity/" in f for f in read[-1])
    # A day that is replaced is made again, and no other.
    fixed = LAST - dt.timedelta(4)
    sinks.save_day(spark.createDataFrame(events_of(LAST), EVENT).withColumn("event_date", F.lit(fixed)), lake.path("event_report"), fixed)
    del made[:]
    jobs.report_campaigns(spark, lake, LAST)
    assert made == [{str(fixed)}]


def test_bits_of_days_move(spark, rows):
    """Active days of sums kept once, looked at on later days."""
    start = dt.date(2024, 1, 1)
    data = [("view", "u1", "fb", "c", 1, None, None, None, start), ("view", "u1", "fb", "c", 1, None, None, None, start + dt.timedelta(3))]
    kept = metrics.day_activity(spark.createDataFrame(data, f"{EVENT}, event_date date"))
    for later in (3, 6, 29, 30, 32, 33):
        found = metrics.merged_activity(kept, start + dt.timedelta(later)).agg(F.bit_or("days")).first()[0] or 0
        want = sum(1 << (later - back) for back in (0, 3) if 0 <= later - back < 30)
        assert found == want


def test_funnels_of_three_days(spark, rows, tmp_path):
    lake = jobs.Lake(str(tmp_path))
    steps = [STEPS.install, STEPS.signup, STEPS.view, STEPS.purchase, STEPS.store_purchase, "open"]
    schema = "event string, time string, appsflyer_id string, user_id string"
    data = []
    for back in range(34):
        rng = random.Random(back)
        day = LAST - dt.timedelta(back)
        data += [(rng.choice(steps), f"{day} 10:00:00", rng.choice(["d1", "d2", "d3", None]), rng.choice(["u1", "u2", None]), day, day) for _ in range(12)]
    sinks.save_snapshot(spark.createDataFrame(data, f"{schema}, event_date date, date date"), lake.path("attribution"))
    for back in (2, 1, 0):
        day = LAST - dt.timedelta(back)
        days = jobs.kept_days(spark, lake, "attribution", "funnel_steps", day, lambda df: funnel.day_steps(df, by=("date",)))
        month = scans.read_period(spark, lake.path("attribution"), day - dt.timedelta(29), day)
        for null_as_value in (False, True):
            want = funnel.funnel(month, day, null_as_value=null_as_value)
            assert rows(funnel.funnel_of_days(days, day, null_as_value), *want.columns) == rows(want) != []

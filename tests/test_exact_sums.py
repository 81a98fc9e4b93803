"""Sums of doubles: nothing is lost, and no order of rows changes a bit."""

import datetime as dt
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from larkmetric.config import EventNames
from larkmetric.functions import add_limbs, exact_sum, limb_sums, limbs, whole
from larkmetric.operators import ltv, metrics, rollup

NAMES = EventNames()


def bits(x):
    return struct.pack("<d", x)


def summed(spark, values, parts=3, kind="double"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}").repartition(parts)
    return df.agg(exact_sum(F.col("x")).alias("s")).first().s


@pytest.mark.parametrize(
    "values, want",
    [
        ([2e24, 1.0], 2e24 + 1),
        ([4e-13] * 5, 2e-12),
        ([0.1] * 10, 1.0),
        ([1e16, 1.0, -1e16], 1.0),
        ([2e24, 0.25, -2e24], 0.25),
        ([1e300, 5.0, -1e300], 5.0),
        ([5e-324, 1e-300], 1e-300),
        ([1.7976931348623157e308], 1.7976931348623157e308),
        ([float("nan"), float("inf"), -float("inf"), None, 2.5], 2.5),
        ([], 0.0),
        ([None], 0.0),
        ([1e18] * 40, 4e19),
        ([9e35] * 40, 3.6e37),
        ([-1.2345678901234567, 1.2345678901234567, 3e-17], 3e-17),
    ],
)
def test_nothing_is_lost(spark, values, want):
    assert summed(spark, values) == pytest.approx(want, rel=1e-15)


def test_text_and_whole_numbers(spark):
    assert summed(spark, ["1.5", "x", None, "2e24", ""], kind="string") == 2e24
    assert summed(spark, [1, 2, 3], kind="long") == 6.0


def test_any_order_gives_the_same_bits(spark):
    rng = random.Random(4)
    values = [rng.choice([1, -1]) * rng.random() * 10.0 ** rng.randint(-19, 35) for _ in range(3000)]
    seen = set()
    for n in range(4):
        rng.shuffle(values)
        seen.add(bits(summed(spark, values, parts=n + 1)))
    assert len(seen) == 1
    got = struct.unpack("<d", seen.pop())[0]
    assert got == pytest.approx(float(sum(map(Fraction, values))), rel=1e-15)


def test_limbs_add_up(spark):
    """Sums of parts are the sums of all."""
    rng = random.Random(5)
    values = [(rng.choice([1, -1]) * rng.random() * 10.0 ** rng.randint(-19, 35), n % 2 == 0) for n in range(500)]
    df = spark.createDataFrame(values, "x double, left boolean")
    every = df.agg(exact_sum(F.col("x"))).first()[0]
    halves = [limb_sums(limbs(F.when(F.col("left") == side, F.col("x")))) for side in (True, False)]
    assert bits(df.agg(whole(add_limbs(*halves))).first()[0]) == bits(every)


def test_rollup_keeps_large_and_small(spark):
    data = [("fb", "c", None, None, 2e24), ("fb", "c", None, None, 5.0), ("tw", "d", None, None, 4e-13)] + [("tw", "d", None, None, 4e-13)] * 4
    df = rollup.ad_rollup(spark.createDataFrame(data, "channel string, campaign string, adset string, ad string, spend double"))
    got = {(r.key, r.value): r.spend for r in df.collect()}
    assert got["channel", "fb"] == 2e24 and got["channel", "tw"] == pytest.approx(2e-12)


def test_reports_and_state_keep_them_too(spark):
    schema = "event string, distinct_id string, media_source string, campaign string, time long, first boolean, order_count string, revenue double, revenue_from_brand double, revenue_from_challenge double, event_date date"
    day = dt.date(2024, 1, 30)
    data = [(NAMES.store, f"u{k}", "fb", "c", 1, None, None, x, None, None, day) for k, x in enumerate([2e24, 1e300, 3.0, 4e-13])]
    events = spark.createDataFrame(data, schema)
    for n, want in ((1, 2e24), (4, 1e300)):
        some = events.limit(n)
        total = metrics.revenue_of(some, [NAMES.store], "r").first().r
        report = {(r.period, r.level): r for r in metrics.campaign_report(some, day).collect()}
        kept = {(r.period, r.level): r for r in metrics.campaign_report_of_days(metrics.day_activity(some), day).collect()}
        assert total == report["daily", "campaign"].store_revenue == kept["monthly", "media_source"].revenue == pytest.approx(want)
    small = metrics.campaign_report(events.where("revenue < 1e-3"), day).where("period = 'daily' AND level = 'campaign'").first()
    assert small.store_revenue == small.revenue == 4e-13
    state = {r.distinct_id: r.store_value for r in ltv.sum_per_user(ltv.contributions(events)).collect()}
    assert state == {"u0": 2e24, "u1": 1e300, "u2": 3.0, "u3": 4e-13}

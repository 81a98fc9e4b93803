"""Ad channels and the rollup on literal rows."""

import datetime as dt

import pytest

from larkmetric.operators import adchannels, rollup

AD_SCHEMA = "channel string, campaign string, adset string, ad string, spend double"


def ad_rows(spark):
    return spark.createDataFrame(
        [
            ("fb", "c1", "a1", "x", 1.0),
            ("fb", "c1", None, None, 2.0),
            ("fb", None, None, None, 4.0),
            ("px", None, None, None, None),
            (None, "c9", "a9", "y", 8.0),
        ],
        AD_SCHEMA,
    )


def test_rollup_levels(spark, rows):
    got = rows(rollup.ad_rollup(ad_rows(spark)), "key", "value", "channel", "campaign", "adset", "spend")
    assert got == [
        ("ad", "x", "fb", "c1", "a1", 1.0),
        ("adset", "a1", "fb", "c1", None, 1.0),
        ("campaign", "c1", "fb", None, None, 3.0),
        ("channel", "fb", None, None, None, 7.0),
        ("channel", "px", None, None, None, 0.0),
    ]


def test_levels_agree_when_keys_are_set(spark):
    data = [(f"ch{i % 3}", f"c{i % 5}", f"s{i % 7}", f"a{i}", float(i)) for i in range(100)]
    out = rollup.ad_rollup(spark.createDataFrame(data, AD_SCHEMA)).groupBy("key").sum("spend").collect()
    assert {r[1] for r in out} == {4950.0} and len(out) == 4


def test_period_rollup_is_the_rollup_of_each_period(spark, rows):
    days = [dt.date(2024, 1, 30), dt.date(2024, 1, 25), dt.date(2024, 1, 2), dt.date(2023, 12, 31), dt.date(2024, 1, 31)]
    data = [("fb", f"c{i % 2}", None, None, float(2**i), d) for i, d in enumerate(days)]
    df = spark.createDataFrame(data, AD_SCHEMA + ", date date")
    out = rollup.ad_rollup_periods(df, "2024-01-30")
    for period, start in (("daily", days[0]), ("weekly", dt.date(2024, 1, 24)), ("monthly", dt.date(2024, 1, 1))):
        one = rollup.ad_rollup(df.where(df.date.between(start, days[0])).drop("date"))
        assert rows(out.where(out.period == period).select(*one.columns)) == rows(one)


def test_google_compares_cost_as_text(spark):
    df = spark.createDataFrame([("0.0",), ("0",), ("-1",), ("5",), (None,)], "cost string")
    assert [r.spend for r in adchannels.google(df).collect()] == [0.0, 5.0]


def test_naver_drops_what_it_names_and_free_rows(spark, rows):
    df = spark.createDataFrame(
        [("2024-01-01", "c", "₩10", "s", "id", "x"), ("2024-01-01", "c", "0", "s", "id", "x")],
        "Date string, campaign_name string, adgroup_salesAmt string, adgroup_status string, campaign_id string, other string",
    )
    out = adchannels.naver(df)
    assert out.columns == ["date", "campaign", "spend", "other", "channel"]
    assert rows(out) == [("2024-01-01", "c", 10.0, "x", "naver")]


def test_pincrux_has_both_date_columns(spark, rows):
    df = spark.createDataFrame(
        [("f", "2024-01-01", "1", "2", "5", "p", "c"), ("f", "2024-01-01", "x", "3", "5", "p", "c"), ("f", "2024-01-02", "4", "5", "5", "p", "c")],
        "Date string, d2 string, clicks string, complete string, conversion_rate string, channel string, campaign string",
    ).toDF("Date", "date", "clicks", "complete", "conversion_rate", "channel", "campaign")
    sheet = spark.createDataFrame(
        [("2024-01-01", "Pincrux", "None", 1), ("2024-01-01", "Pincrux", "₩7", 2), ("2024-01-01", "Pincrux", "₩9", 3), ("2024-01-02", "Other", "₩1", 4)],
        "date string, channel string, Cost string, row int",
    )
    got = rows(adchannels.pincrux(df, sheet, ["row"]), "date", "clicks", "completes", "spend", "channel")
    assert got == [("2024-01-01", 1.0, 5.0, 7.0, "pincrux"), ("2024-01-02", 4.0, 5.0, None, "pincrux")]


def test_unify_stacks_different_columns(spark):
    fb = spark.createDataFrame([("2024-01-01", "1")], "Date string, reach string")
    ad = spark.createDataFrame([("bad day", "2")], "Date string, `완료` string")
    out = adchannels.unify({"facebook": fb, "adison": ad})
    got = {r.channel: (r.date, r.reach, r.completes) for r in out.collect()}
    assert got == {"facebook": (dt.date(2024, 1, 1), 1.0, None), "adison": (None, None, 2.0)}


def test_micro_costs_truncate(spark):
    df = spark.createDataFrame([(1999999.0, 1, 2e6, 5e5)], "average_cost double, interactions int, average_cpm double, average_cpc double")
    assert tuple(adchannels.micro_costs(df).select("cost", "cpm", "cpc").first()) == (1, 2.0, 0.5)


def test_unpivot(spark, rows):
    df = spark.createDataFrame([("2022-06-30", "1", "2", "3"), ("2022-07-01", "4", "5", "6")], "date string, a string, b string, c string")
    wide = df.toDF("date", "광고비-X", "노출-X", "메모")
    got = adchannels.unpivot_sheet(wide, since="2022-07-01")
    assert got.columns == ["date", "channel", "Cost", "노출"]
    assert rows(got) == [("2022-07-01", "X", None, "5"), ("2022-07-01", "X", "4", None)]
    other = adchannels.unpivot_sheet(df.toDF("date", "X-Cost", "X-Clicks", "plain"), metric_first=False)
    assert {r.channel for r in other.collect()} == {"X", "total_plain"} and other.count() == 6


def test_search_ads_keep_campaigns_without_stats(spark):
    c = spark.createDataFrame([("c1", "one", "z"), ("c2", "two", "z")], "nccCampaignId string, name string, ignored string")
    cs = spark.createDataFrame([("c1", "5")], "id string, clkCnt string")
    g = spark.createDataFrame([("g1", "c1"), ("g2", "c2"), ("g3", "c2")], "nccAdgroupId string, nccCampaignId string")
    gs = spark.createDataFrame([("g1", "1"), ("g2", "2")], "id string, clkCnt string")
    out = adchannels.join_search_ads(c, cs, g, gs)
    got = {r.adgroup_nccAdgroupId: (r.campaign_name, r.campaign_clkCnt, r.adgroup_clkCnt) for r in out.collect()}
    assert got == {"g1": ("one", "5", "1"), "g2": ("two", None, "2")}
    assert "campaign_ignored" not in out.columns


def test_ratios_from_sums(spark):
    df = spark.createDataFrame([("fb", "c", "s", "a", 10.0, 100.0, 4.0), ("fb", "c", "s", "b", 30.0, 0.0, 0.0)], AD_SCHEMA + ", impressions double, clicks double")
    row = rollup.ad_rollup(df, ratios=True).where("key = 'channel'").first()
    assert (row.ctr_of_sums, row.cpm_of_sums, row.cpc_of_sums) == pytest.approx((4.0, 400.0, 10.0))


def test_an_export_without_columns_adds_nothing(spark):
    schema = "Date string, campaign_name string, adset_name string, ad_name string, spend string"
    facebook = spark.createDataFrame([("2024-01-30", "c", "s", "a", "5")], schema)
    empty = spark.range(0).select()
    table = adchannels.unify({"google": empty, "facebook": facebook})
    assert [(r.channel, r.spend) for r in table.collect()] == [("facebook", 5.0)]


def test_sums_of_very_large_and_very_small_numbers(spark):
    data = [("c", None, None, None, 1e19, 4e-7)] + [("c", None, None, None, 0.0, 4e-7)] * 2 + [("c", None, None, None, 1e30, None)]
    df = spark.createDataFrame(data, "channel string, campaign string, adset string, ad string, spend double, rate double")
    row = rollup.ad_rollup(df).where("key = 'channel'").first()
    assert (row.spend, row.rate) == (1e30 + 1e19, pytest.approx(1.2e-6))

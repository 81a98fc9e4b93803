"""The daily jobs end to end on a small lake."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from larkmetric.config import EventNames
from larkmetric.operators import ltv
from larkmetric.plans import jobs
from larkmetric.sources import sinks

DAYS = [dt.date(2024, 1, 29), dt.date(2024, 1, 30)]
NAMES = EventNames()
NOON = {d: int(dt.datetime(d.year, d.month, d.day, 12, tzinfo=dt.timezone.utc).timestamp()) + 9 * 3600 for d in DAYS}


def put(spark, lake, name, data, schema, day=DAYS[0], partition="date"):
    df = spark.createDataFrame(data, schema).withColumn(partition, F.lit(day))
    sinks.save_snapshot(df, lake.path(name), (partition,))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = jobs.Lake(str(tmp_path_factory.mktemp("lake")))
    put(spark, lake, "raw_challenge", [("1", "g1", '[{"name": "instagram"}]'), ("2", "g2", "[]")], "challenge_id string, goal_id string, custom_fields string")
    put(spark, lake, "raw_goal", [("g1", "k1"), ("g2", "k2")], "goal_id string, goal_category_id string")
    put(spark, lake, "raw_goal_category", [("k1", "brand", "brand_visit"), ("k2", "x", "y")], "goal_category_id string, level2 string, level3 string")
    put(spark, lake, "raw_user_challenge", [("1", "u1"), ("1", "u2"), ("2", "u1")], "challenge_id string, distinct_id string")
    put(spark, lake, "raw_challenge_result", [("1", 300, 600.0), ("2", 10, 50.0)], "challenge_id string, register_count long, margin double")
    put(spark, lake, "raw_challenge_info", [("1", 200, "0")], "challenge_id string, register_count long, fee string")
    put(spark, lake, "raw_challenge_commerce", [], "challenge_commerce_id string, challenge_id string")
    put(spark, lake, "raw_challenge_commerce", [("m1", "2")], "challenge_commerce_id string, challenge_id string")
    put(spark, lake, "raw_commerce_product", [("m1", "p1")], "challenge_commerce_id string, product_id string")
    put(spark, lake, "raw_product", [("p1", "box", "9", "1.5")], "product_id string, name string, price string, product_fee string")
    put(spark, lake, "raw_store_order", [(7, "o7")], "pill_order_id int, order_no string")
    put(spark, lake, "raw_store_item", [(7, 70)], "pill_order_id int, pill_option_id int")
    put(spark, lake, "raw_store_option", [(70, 1000, 0.25, 3.0)], "pill_option_id int, discounted_price int, fee_ratio double, reward_amount double")
    users = "distinct_id string, corp_name string, media_source string, campaign string"
    put(spark, lake, "raw_users_challenge", [("u1", None, "facebook", "c%201")], users)
    put(spark, lake, "raw_users_store", [("u1", None, "facebook", "c%201"), ("u2", None, None, None)], users)
    put(spark, lake, "user_info", [("d-9", "u2")], "device_id string, distinct_id string")
    events = "event string, distinct_id string, challenge_id string, first string, order_no string, order_count string, time long, device_id string, insert_id string"
    for day in DAYS:
        t = NOON[day]
        put(
            spark, lake, "raw_events",
            [
                (NAMES.install, "u1", None, "None", "None", "None", t, "d-1", "i1"),
                (NAMES.challenge, "d-1", "[1, 2]", "True", "None", "None", t + 1, "d-1", "i2"),
                (NAMES.challenge, "d-1", "[1, 2]", "True", "None", "None", t + 1, "d-1", "i3"),
                (NAMES.store, "d-9", "", "None", "o7", "1.0", t + 2, "d-9", "i4"),
                ("view", "None", None, "None", "None", "None", t + 3, "d-5", "i5"),
            ],
            events, day,
        )
        fb = "campaign_name string, adset_name string, ad_name string, spend string, impressions string, clicks string"
        put(spark, lake, "raw_facebook", [("c%201", "s", "a", "₩1,000", "10", "2")], fb, day)
        px = "date string, clicks string, complete string, conversion_rate string, channel string, campaign string"
        put(spark, lake, "raw_pincrux", [(str(day), "3", "1", "x", "p", "c")] * 2, px, day, "file_date")
    sheet = [(str(DAYS[1]), "Pincrux", "None", 1), (str(DAYS[1]), "Pincrux", "₩70", 2)]
    put(spark, lake, "raw_sheet_costs", sheet, "date string, channel string, Cost string, row int", DAYS[0], "file_date")
    return lake


def run_day(spark, lake, day, first):
    jobs.build_marts(spark, lake, day)
    jobs.cleanse_events(spark, lake, day)
    jobs.cleanse_ads(spark, lake, day, ["facebook", "pincrux"], ["row"])
    jobs.enrich_day(spark, lake, day)
    jobs.report_campaigns(spark, lake, day)
    jobs.accumulate_ltv(spark, lake, day, first_day=first, buckets=4)


def test_two_days(spark, rows, lake):
    run_day(spark, lake, DAYS[0], first=True)
    run_day(spark, lake, DAYS[1], first=False)
    before = rows(lake.table(spark, "ltv"))
    run_day(spark, lake, DAYS[1], first=False)
    assert rows(lake.table(spark, "ltv")) == before, "a day run again leaves the same state"

    cleansed = lake.table(spark, "events").where(F.col("date") == DAYS[1]).collect()
    ids = {}
    for r in sorted(cleansed, key=lambda r: r.insert_id):
        ids.setdefault((r.event, r.distinct_id, r.challenge_id), []).append(r.insert_id)
    assert ids == {
        (NAMES.install, "u1", None): ["i1"],
        (f"brand_{NAMES.challenge}", "u1", "1"): ["i2", "i3"],
        (NAMES.challenge, "u1", "2"): ["i2", "i3"],
        (NAMES.store, "d-9", None): ["i4"],
    }

    report = lake.table(spark, "campaign_report").where(
        (F.col("date") == DAYS[1]) & (F.col("period") == "monthly") & (F.col("level") == "campaign")
    )
    got = {(r.media_source, r.campaign): r for r in report.collect()}
    assert set(got) == {("facebook", "c 1"), ("organic", "organic")}  # pincrux has no campaigns
    r = got["facebook", "c 1"]
    assert (r.mau, r.dau, r.unique_installs, r.count_installs, r.spend) == (1, 1.0, 1, 2, 2000.0)
    assert (r.challenge_complete_checkout_brand_count, r.challenge_complete_checkout_count) == (2, 2)
    brand = 15000 + 4000 + 600 / 300
    assert r.challenge_brand_revenue == pytest.approx(2 * brand)
    assert r.challenge_revenue == pytest.approx(2 * (50 / 10 + 1.5))
    assert got["organic", "organic"].store_revenue == pytest.approx(2 * 253.0)

    ads = lake.table(spark, "channel_report").where(
        (F.col("date") == DAYS[1]) & (F.col("period") == "weekly") & (F.col("key") == "channel")
    )
    assert {r.value: (r.spend, r.clicks) for r in ads.collect()} == {"facebook": (2000.0, 4.0), "pincrux": (70.0, 12.0)}

    state = {r.distinct_id: r for r in lake.table(spark, "ltv").where(F.col("date") == DAYS[1]).collect()}
    assert set(state) == {"u1", "u2"}, "the device went to its user"
    assert (state["u1"].brand_challenge_count, state["u1"].challenge_count) == (2, 2)
    assert state["u1"]._brand_challenge_value == pytest.approx(2 * 19000)
    assert state["u2"].store_value == pytest.approx(506.0)


def test_a_gap_in_the_state_is_an_error(spark, lake):
    with pytest.raises(LookupError):
        jobs.accumulate_ltv(spark, lake, "2024-03-01")


def test_funnel_job(spark, lake, tmp_path):
    path = lake.path("raw_attribution")
    data = [("install", "2024-01-01 10:00:00", "d1", "u1"), ("signup", "2024-01-30 10:00:00", "d1", "u1")]
    df = spark.createDataFrame(data, ["Event Name", "Event Time", "AppsFlyer ID", "Customer User ID"])
    df.coalesce(1).write.option("header", True).csv(f"{path}/app_2024-01-30_2024-01-30_inapp.csv.gz", compression="gzip")
    jobs.report_funnel(spark, lake, "2024-01-30")
    got = {r.period: r for r in lake.table(spark, "funnel").collect()}
    assert set(got) == {"monthly", "weekly", "daily"}
    assert (got["monthly"].total_install_signup, got["daily"].total_install) == (1, 0)


def test_state_columns(spark):
    assert ltv.empty_state(spark).columns[0] == "distinct_id"


def test_a_channel_without_files_is_left_out(spark, lake):
    jobs.cleanse_ads(spark, lake, DAYS[1], ["facebook", "google"], ["row"])
    ads = lake.table(spark, "channel_report").where((F.col("date") == DAYS[1]) & (F.col("key") == "channel"))
    assert {r.value for r in ads.collect()} == {"facebook"}

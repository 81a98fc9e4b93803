"""Cleaning, relabelling, identity and de-duplication on literal rows."""


import pytest
from pyspark.sql import functions as F

from larkmetric.config import TEST_VALUES
from larkmetric.operators import clean, dedup, enrich, firstrow, identity


def test_sentinels(spark, rows):
    df = spark.createDataFrame([("None", float("nan"), 1), ("", 1.0, 2), ("테스트", 2.0, 3)], "a string, b double, c int")
    assert rows(clean.null_sentinels(df)) == [(None, None, 1), (None, 1.0, 2), ("테스트", 2.0, 3)]
    assert rows(clean.null_sentinels(df, TEST_VALUES), "a") == [(None,)] * 3


def test_merge_and_slash(spark, rows):
    df = spark.createDataFrame([("n", "o", None), (None, "o", "x"), (None, None, None)], "src string, tgt string, b string")
    merged = clean.merge_columns(df, [("src", "tgt"), ("absent", "tgt")])
    assert merged.columns == ["tgt", "b"]
    assert rows(clean.join_with_slash(merged, "tgt", "b"), "tgt") == [(None,), ("n/",), ("o/x",)]


def test_merge_into_a_new_column(spark, rows):
    df = spark.createDataFrame([("n",)], "src string")
    assert rows(clean.merge_columns(df, [("src", "tgt")])) == [("n",)]


def test_zero_amount(spark, rows):
    df = spark.createDataFrame(
        [("e", None), ("e", "0"), ("e", "0.0"), ("e", "x"), ("e", "3"), ("other", "0")], "event string, amount string"
    )
    got = [r[0] for r in clean.mark_zero_amount(df, "e", "amount").collect()]
    assert got == ["zero_e", "zero_e", "zero_e", "e", "e", "other"]


def test_membership_prefixes_stack(spark, rows):
    df = spark.createDataFrame([("e", "1"), ("e", "2"), ("e", "3"), ("e", None)], "event string, challenge_id string")
    types = spark.createDataFrame(
        [("1", "1.0"), ("1", "3.0"), ("2", "3"), ("2", "3"), (None, "1")], "challenge_id string, service_type string"
    )
    got = rows(clean.prefix_by_membership(df, types), "challenge_id", "event")
    assert got == [(None, "e"), ("1", "corp_brand_e"), ("2", "corp_e"), ("3", "e")]


def test_event_correction(spark):
    c, b = "challenge_complete_checkout", "brand_challenge_complete_checkout"
    df = spark.createDataFrame([(c, 1), (b, 2), (c, 2), (b, 1), (c, 3), (b, 3), (c, None)], "e string, t int")
    got = [r[0] for r in df.select(clean.corrected_event(F.col("e"), F.col("t"))).collect()]
    assert got == [b, c, c, b, f"corp_{c}", f"corp_{c}", c]


def test_keep_known_keeps_null_events(spark, rows):
    df = spark.createDataFrame([("k", None), ("k", "bad"), (None, "ok")], "k string, event string")
    assert rows(clean.keep_known(df, "k", ["bad"])) == [("k", None)]
    assert rows(enrich.other_events(df, ["bad"]), "event") == [(None,), ("ok",)]


def test_first_order(spark):
    text = spark.createDataFrame([("1.0",), ("1",), (None,)], "order_count string")
    number = spark.createDataFrame([(1.0,), (2.0,)], "order_count double")
    assert [r[0] for r in text.select(clean.first_order(text)).collect()] == [True, False, False]
    assert [r[0] for r in number.select(clean.first_order(number)).collect()] == [True, False]


def test_periods_nest(spark, rows):
    df = spark.createDataFrame([("2024-01-30",), ("2024-01-24",), ("2024-01-23",), ("2024-01-01",), ("2023-12-31",)], "d string")
    df = df.select(F.to_date("d").alias("event_date"))
    got = {str(d): set() for d, in df.collect()}
    for d, period in clean.with_periods(df, "2024-01-30").collect():
        got[str(d)].add(period)
    assert got == {
        "2024-01-30": {"monthly", "weekly", "daily"},
        "2024-01-24": {"monthly", "weekly"},
        "2024-01-23": {"monthly"},
        "2024-01-01": {"monthly"},
        "2023-12-31": set(),
    }


def test_identity_map(spark, rows):
    df = spark.createDataFrame(
        [("d1", "a-1", 1), ("d1", "u1", 2), ("d1", "u2", 3), ("d2", "b-1", 4), (None, "u9", 5), ("d1", None, 6)],
        "device_id string, distinct_id string, seq int",
    )
    got = rows(identity.map_ids(df, "device_id", "distinct_id", ["seq"]), "seq", "distinct_id")
    assert got == [(1, "u2"), (2, "u2"), (3, "u2"), (4, "b-1"), (5, "u9"), (6, "u2")]


def test_devices_to_users(spark, rows):
    df = spark.createDataFrame([("d-1",), ("d-2",), ("u7",), (None,), ("d-1",)], "distinct_id string")
    info = spark.createDataFrame([("d-1", "u2"), ("d-1", "u1"), ("u7", "u8")], "device_id string, distinct_id string")
    got = rows(identity.devices_to_users(df, info))
    assert got == [(None,), ("d-2",), ("u1",), ("u1",), ("u7",)]


def test_dedup_keeps_each_id_once(spark):
    data = [("a", None, "2"), ("a", None, "1"), ("a", None, "2"), ("b", "x", None), ("b", "x", None), ("b", "y", "3")]
    out = dedup.dedup_events(spark.createDataFrame(data, "e string, u string, id string"))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(set(data), key=str)


def test_dedup_loses_nothing_of_a_hot_group(spark):
    hot = spark.range(700_000).selectExpr("'hot' AS e", "'h' AS u", "concat('i', id) AS id")
    out = dedup.dedup_events(hot.union(hot.limit(1000)))
    assert out.count() == out.select("id").distinct().count() == 700_000


def test_dedup_is_idempotent(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), (None, 2)], "e string, n int")
    once = dedup.dedup_rows(df)
    assert rows(once) == rows(dedup.dedup_rows(once)) == [(None, 2), ("a", 1)]


def test_first_and_last_row(spark, rows):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, None)], "k string, o int, v string")
    assert rows(firstrow.first_per_key(df, ["k"], ["o"], ["v"])) == [("a", "y"), ("b", None)]
    assert rows(firstrow.first_per_key(df, ["k"], ["o"], ["v"], last=True)) == [("a", "x"), ("b", None)]
    assert rows(firstrow.lookup(df, "k", "a", ["o"])) == [("a", 1, "y")]


@pytest.mark.parametrize(
    "stop,kwargs,want",
    [("b", {}, [1]), ("b", {"inclusive": True}, [1, 2]), ("z", {}, []), ("z", {"when_missing": "all"}, [1, 2, 3])],
)
def test_until_terminator(spark, stop, kwargs, want):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "i int, v string")
    got = firstrow.until_terminator(df, F.col("v") == stop, "i", **kwargs).collect()
    assert sorted(r.i for r in got) == want


def test_casts(spark, rows):
    df = spark.createDataFrame([("5.7", "5.7", "True"), ("x", None, None)], "goal_id string, n string, f string")
    got = clean.cast_ids_and_flags(df, ["goal_id", "n", "absent"], ["f"])
    assert got.dtypes == [("goal_id", "string"), ("n", "bigint"), ("f", "boolean")]
    assert rows(got) == [(None, None, False), ("5", 5, True)]


def test_long_ids_and_number_flags_survive(spark):
    df = spark.createDataFrame([("12345678901234567890", 1, "true"), ("7", 0, "x"), ("-0", 2, None)], "goal_id string, n int, t string")
    got = [tuple(r) for r in clean.cast_ids_and_flags(df, ["goal_id"], ["n", "t"]).collect()]
    assert got == [("12345678901234567890", True, True), ("7", False, False), ("0", False, False)]


def test_dirty_text_does_not_fail(spark):
    df = spark.createDataFrame([("1", "many"), ("2", "3")], "challenge_id string, service_type string")
    events = spark.createDataFrame([("e", "1"), ("e", "2")], "event string, challenge_id string")
    assert sorted(r.event for r in clean.prefix_by_membership(events, df).collect()) == ["corp_e", "e"]

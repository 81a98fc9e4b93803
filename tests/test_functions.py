"""Scalar functions on literal rows."""

import datetime as dt
from urllib.parse import unquote as python_unquote

import pytest
from pyspark.sql import functions as F

from larkmetric import functions as fn


def values(spark, expr, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_clean_number_shapes(spark):
    texts = ["1.", ".5", ".", "..", "1..", "..1", "1.2.", "₩1 0\n.5", "\n", "x.y", "１", "9" * 400, "-1e-5", "NaN", "Infinity"]
    assert values(spark, fn.clean_number, texts) == [
        1, 0.5, None, None, None, None, None, 10.5, None, None, None, float("inf"), 15, None, None,
    ]


def test_clean_number(spark):
    texts = ["₩1,200", "-5", "1e-5", "1.2.3", "", "None", None, "5.", ".5", "."]
    assert values(spark, fn.clean_number, texts) == [1200, 5, 15, None, None, None, None, 5, 0.5, None]


def test_clean_sheet_number(spark):
    texts = ["#DIV/0!", "#REF!", "", None, "₩2,000.5"]
    assert values(spark, fn.clean_sheet_number, texts) == [0, 0, 0, 0, 2000.5]


def test_numbers_keep_their_sign(spark):
    df = spark.createDataFrame([(-5.0, "-5")], "n double, t string")
    row = df.select(fn.to_number(df.n, "double").alias("n"), fn.to_number(df.t, "string").alias("t")).first()
    assert tuple(row) == (-5.0, 5.0)


def test_text_to_long(spark):
    texts = ["5", "5.9", "-5.9", "1e2", "1d", "true", "false", '"5"', "[1]", "9007199254740993", " 7 ", "NaN", "1e300", None]
    want = [5, 5, -5, 100, None, 1, 0, None, None, 9007199254740993, 7, None, None, None]
    assert values(spark, fn.text_to_long, texts) == want


def test_text_to_double(spark):
    texts = ["1.5", "1d", "1f", ".5", "5.", "1_000", "-1e3", "abc", "", None, " 2 ", "inf", "-Infinity"]
    inf = float("inf")
    want = [1.5, None, None, 0.5, 5.0, 1000.0, -1000.0, None, None, None, 2.0, inf, -inf]
    assert values(spark, fn.text_to_double, texts) == want
    assert values(spark, fn.is_float, ["1", "1d", "nan"]) == [True, False, True]


def test_is_true(spark):
    assert values(spark, fn.is_true, ["true", "True", "TRUE", "1", "None", None]) == [True, True] + [False] * 4
    assert values(spark, fn.is_true, [True, False, None], "boolean") == [True, False, False]
    assert values(spark, lambda c: fn.is_true(c, numeric=True), [1, 0, 2, None], "int") == [True, False, False, False]


@pytest.mark.parametrize(
    "text", ["a+b", "100%", "50%zz %41", "%EA%B4%91", "%", "%%41", "a%2Bb", "plain", "%e4%bd%A0+%2", ""]
)
def test_unquote_as_python_does(spark, text):
    assert values(spark, fn.unquote, [text]) == [python_unquote(text)]


def test_id_kinds(spark):
    ids = ["a-b", "u1", "", None]
    assert values(spark, fn.is_uuid_like, ids) == [True, False, False, False]
    assert values(spark, fn.is_custom_id, ids) == [False, True, True, False]


def test_os_class(spark):
    texts = ["Android 9", "SAMSUNG", "iPadOS", "Mobile Browser", "a Browser", "linux", None]
    assert values(spark, fn.os_class, texts) == ["aos", "aos", "ios", None, "web", None, None]


def test_os_class_takes_the_first_decisive_value(spark):
    df = spark.createDataFrame([(None, "x", "iphone"), ("android", "ios", None)], "a string, b string, c string")
    got = [r[0] for r in df.select(fn.os_class(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == ["ios", "aos"]


def test_id_values(spark):
    texts = ["[1, 2]", "5", "[]", "bad", None, '["a", null]', "-3", '{"a": 1}']
    want = [["1", "2"], ["5"], [], None, None, ["a", None], ["-3"], None]
    assert values(spark, fn.id_values, texts) == want
    df = spark.createDataFrame([(t,) for t in texts[:5]], "v string")
    assert df.select(F.explode_outer(fn.id_values(F.col("v")))).count() == 6


def test_json_helpers(spark):
    names = ['[{"name": "instagram"}]', '[{"name": "memo"}]', "[]", "bad", None]
    assert values(spark, lambda c: fn.any_named(c, "instagram"), names) == [True, False, False, False, False]
    kept = values(spark, lambda c: fn.keep_keys(fn.json_value_map(c), ["a"]), ['{"a": 1, "b": 2}', "{}"])
    assert kept == [{"a": "1"}, {}]
    assert values(spark, lambda c: fn.json_decode(c).isNotNull(), ['{"a":1}', "[", "3"]) == [True, False, True]
    assert values(spark, fn.id_list_text, [["1"], ["1", "2"], [], None], "array<string>") == ["1", "1,2", "", ""]


def test_dates(spark):
    assert values(spark, fn.text_to_date, ["2024-01-30 23:59:59", "bad", None]) == [dt.date(2024, 1, 30), None, None]
    nine = 9 * 3600
    got = values(spark, fn.local_event_date, [nine, nine - 1, 1706572800 + nine, -1], "bigint")
    assert got == [dt.date(1970, 1, 1), dt.date(1969, 12, 31), dt.date(2024, 1, 30), dt.date(1969, 12, 31)]
    assert fn.days_before("2024-03-01", 1) == dt.date(2024, 2, 29)


def test_event_date_ignores_the_session_zone(spark, conf):
    conf(spark__sql__session__timeZone="America/New_York")
    assert values(spark, fn.local_event_date, [9 * 3600], "bigint") == [dt.date(1970, 1, 1)]


def test_percent(spark):
    df = spark.createDataFrame([(1, 4), (3, 0)], "a int, b int")
    assert [r[0] for r in df.select(fn.percent(F.col("a"), F.col("b"))).collect()] == [25.0, 0.0]

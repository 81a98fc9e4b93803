"""Revenue rules and marts on literal rows."""

import pytest
from pyspark.sql import functions as F

from larkmetric.config import ServiceRules
from larkmetric.operators import marts
from larkmetric.operators.joins import full_outer, spread_nulls

RULES = ServiceRules()
EDGES = {
    RULES.flat_level3: {9: 0, 10: 3e6, 100: 3e6, 101: 4e6, 300: 4e6, 301: 5e6, 500: 5e6, 501: 5e6},
    RULES.mid_level3: {299: 0, 300: 15e3, 499: 15e3, 500: 13e3, 999: 13e3, 1000: 10e3, 1999: 10e3, 2000: 8e3},
    RULES.high_level3: {499: 0, 500: 10e3, 999: 10e3, 1000: 8e3, 2999: 8e3, 3000: 6e3, 3999: 6e3, 4000: 4.8e3},
}
PROOF = {
    RULES.flat_level3: {10: 1e6, 101: 1.5e6, 301: 2e6, 501: 2e6, 9: 0},
    RULES.mid_level3: {300: 4e3, 500: 4e3, 1000: 4e3, 2000: 3.2e3, 299: 0},
    RULES.high_level3: {500: 3e3, 1000: 3e3, 3000: 3e3, 4000: 2.4e3, 499: 0},
}
SCHEMA = (
    "level2 string, level3 string, register_count bigint, info_register_count bigint, "
    "need_instagram boolean, margin double, product_fee string"
)


@pytest.mark.parametrize("category", EDGES)
def test_tier_edges(spark, category):
    data = [("x", category, n, None, False, None, None) for n in EDGES[category]]
    out = marts.with_challenge_revenue(spark.createDataFrame(data, SCHEMA)).collect()
    assert {r.register_count: r.revenue_from_brand for r in out} == EDGES[category]


@pytest.mark.parametrize("category", PROOF)
def test_photo_proof_is_extra(spark, category):
    data = [("x", category, None, n, True, None, None) for n in PROOF[category]]
    out = marts.with_challenge_revenue(spark.createDataFrame(data, SCHEMA)).collect()
    plain = EDGES[category]
    assert {r.info_register_count: r.revenue_from_brand - plain[r.info_register_count] for r in out} == PROOF[category]


def test_service_types_in_order(spark):
    data = [
        ("brand", RULES.corp_level3), ("corp", RULES.flat_level3), ("brand", "other"), ("x", RULES.mid_level3),
        ("x", "y"), (None, None), (None, RULES.high_level3),
    ]
    df = spark.createDataFrame(data, "a string, b string")
    got = [r[0] for r in df.select(marts.service_type(F.col("a"), F.col("b"))).collect()]
    assert got == [3, 3, 1, 1, 2, 2, 1]


def test_user_revenue(spark):
    data = [("x", "y", 4, 2, None, 10.0, "1.5"), ("x", "y", 0, None, None, 10.0, None), ("x", "y", 4, None, None, None, "2")]
    out = marts.with_challenge_revenue(spark.createDataFrame(data, SCHEMA)).collect()
    assert [r.revenue_from_challenge for r in out] == [4.0, 0.0, 2.0]
    assert [r.revenue for r in out] == [4.0, 0.0, 2.0]
    assert not any(r.is_brand or r.is_corp for r in out)


def test_store_mart(spark, rows):
    orders = spark.createDataFrame([(1, "A"), (2, "B")], "pill_order_id int, order_no string")
    items = spark.createDataFrame([(1, 7), (1, 7), (3, 7)], "pill_order_id int, pill_option_id int")
    options = spark.createDataFrame([(7, 900.9, 0.5, 3.0)], "pill_option_id int, discounted_price double, fee_ratio double, reward_amount double")
    assert rows(marts.store_mart(orders, items, options)) == [("A", 900.9, 0.5, 3.0, 453.0)]


def test_full_outer_as_spark_joins(spark, rows):
    """A hot key, missing keys on both sides, and a key on one side only."""
    dim = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, d int")
    facts = spark.createDataFrame([("a", i) for i in range(50)] + [("z", 60), (None, 61), (None, 62)], "k string, f int")
    want = dim.join(facts, "k", "full_outer").select("k", "d", "f")
    assert rows(full_outer(dim, facts, "k").select("k", "d", "f")) == rows(want)


def test_spread_nulls_matches_nothing(spark):
    left = spark.createDataFrame([(None, i) for i in range(200)] + [("k", 1)], "k string, i int")
    right = spark.createDataFrame([("k", 1), (None, 2)], "r string, v int")
    keys = left.select(spread_nulls(F.col("k"), "i").alias("k"), "i")
    assert keys.select("k").distinct().count() > 100
    assert keys.join(right, keys.k == F.concat(F.lit("="), right.r), "left").where("v is not null").count() == 1


def test_users_do_not_multiply_challenges(spark, rows):
    users = spark.createDataFrame([("c1", f"u{i}") for i in range(100)] + [("c2", "u1")], "challenge_id string, distinct_id string")
    result = spark.createDataFrame([("c1", 5, 1.0)], "challenge_id string, register_count int, margin double")
    assert rows(marts.challenge_results(users, result)) == [("c1", 5, 1.0), ("c2", None, None)]

"""What the plans must and must not hold."""

import pytest
from compare import SF_DIR
from pyspark.sql import functions as F

from larkmetric.config import USER_COLUMNS
from larkmetric.operators import clean, dedup, enrich, identity, marts, metrics
from larkmetric.operators.joins import full_outer
from larkmetric.plans.queries import QUERIES


def plan_of(df, run=False):
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_products(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Window "):
        assert bad not in plan, bad


@pytest.mark.parametrize("name", ["campaign_report_all", "campaign_report_enriched", "ad_rollup_periods", "funnel_all_periods"])
def test_reports_do_not_expand(spark, name):
    assert "Expand" not in plan_of(QUERIES[name](spark, SF_DIR))


def test_report_shuffles(spark, conf):
    """Users' day bands, attribution, one meeting by user for both levels, and their groups."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    df = QUERIES["campaign_report_all"](spark, SF_DIR)
    assert plan_of(df).index("partial_bit_or(_bit") < plan_of(df).index("FileScan parquet")
    plan = plan_of(df, run=True).split("Initial Plan")[0]
    assert plan.count("ReusedExchange") >= 1 and plan.count("FileScan parquet") == 2


def test_report_moves_one_row_a_user_and_group(spark):
    """The rows that meet by user are those of the day bands, not six times as many."""
    events = spark.range(3000).select(
        F.concat(F.lit("u"), F.col("id") % 1000).alias("distinct_id"),
        F.lit("signup").alias("event"),
        F.lit("2024-01-30").cast("date").alias("event_date"),
        F.lit(True).alias("first"),
        F.lit("1").alias("order_count"),
        F.lit(1.0).alias("revenue"),
        F.lit("s").alias("media_source"),
        F.concat(F.lit("c"), F.col("id") % 2).alias("campaign"),
    )
    df = metrics.campaign_report(events, "2024-01-30")
    got = {(r.period, r.level, r.campaign): (r.mau, r.unique_signups, r.count_signups) for r in df.collect()}
    assert len(got) == 9 and got["daily", "media_source", None] == (1000, 1000, 3000)
    assert "inline" not in plan_of(df).split("Exchange hashpartitioning(distinct_id")[-1]


def test_funnel_shuffles_ids_once(spark):
    plan = plan_of(QUERIES["funnel_all_periods"](spark, SF_DIR))
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("FileScan") == 1


def test_scans_read_only_what_is_used(spark):
    plan = plan_of(QUERIES["campaign_report_all"](spark, SF_DIR))
    assert "props" not in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan_of(QUERIES["parquet_scan"](spark, SF_DIR))


SMALL_SPLITS = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "16KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "8KB",
}


def hot_events(spark, n=60000):
    """A third of the rows under one id."""
    ids = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), F.col("id") % 5000))
    return spark.range(n, numPartitions=6).select("id", ids.alias("k"), F.lit("e").alias("event"))


def test_attribution_splits_a_hot_user(spark, conf):
    conf(**SMALL_SPLITS)
    events = hot_events(spark).withColumnRenamed("k", "distinct_id")
    users = events.select("distinct_id").distinct().selectExpr(
        "distinct_id", "'a' corp_name", "'s' media_source", "'c' campaign"
    )
    df = enrich.attribute(events, users)
    assert "skew=true" in plan_of(df, run=True)
    assert df.where("media_source = 's'").count() == 60000


def test_identity_splits_a_hot_device(spark, conf):
    """The device map is grouped by device, yet the hot device's rows are split."""
    conf(**SMALL_SPLITS)
    events = hot_events(spark).withColumnRenamed("k", "device").withColumn("user", F.concat(F.lit("x"), "device"))
    df = identity.map_ids(events, "device", "user", ["id"])
    assert "skew=true" in plan_of(df, run=True)
    assert df.where("user = concat('x', device)").count() == 60000


def test_membership_splits_a_hot_id_and_spreads_missing_ones(spark, conf):
    conf(**SMALL_SPLITS)
    events = hot_events(spark).withColumnRenamed("k", "challenge_id")
    types = events.selectExpr("challenge_id", "'1' service_type")
    df = clean.prefix_by_membership(events, types)
    assert "skew=true" in plan_of(df, run=True)
    assert df.where("event = 'brand_e'").count() == 60000
    no_ids = events.withColumn("challenge_id", F.lit(None).cast("string"))
    assert clean.prefix_by_membership(no_ids, types).where("event = 'e'").count() == 60000


def test_outer_join_splits_a_hot_key(spark, conf):
    conf(**SMALL_SPLITS)
    facts = hot_events(spark)
    dim = facts.select("k").distinct().union(spark.createDataFrame([("none",)], "k string")).withColumn("d", F.lit(1))
    df = full_outer(dim, facts, "k")
    assert "skew=true" in plan_of(df, run=True)
    assert df.count() == 60001


def test_hot_user_reaches_the_join_summed(spark, conf):
    """One user has a third of the events, yet few rows after the first aggregate."""
    events = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), "id")).alias("distinct_id"),
        F.lit("signup").alias("event"),
        F.date_sub(F.lit("2024-01-30"), (F.col("id") % 30).cast("int")).alias("event_date"),
        F.lit(True).alias("first"),
        F.lit("1").alias("order_count"),
        F.lit(None).cast("double").alias("revenue"),
    )
    activity = metrics.user_activity(events, "2024-01-30", [])
    assert activity.where("distinct_id = 'hot'").count() == 3
    assert activity.agg(F.sum("signups")).first()[0] == 30000


def test_dedup_shuffles_and_reads_once(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), F.col("id").cast("string").alias("v"))
    plan = plan_of(dedup.dedup_events(df))
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Range ") == 1


def test_marts_are_made_distinct_in_all_tasks(spark, conf):
    """Not in few tasks of many narrow rows each, whose hash tables would grow with the input."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    ids = spark.range(2000).withColumn("name", F.col("id").cast("string"))
    orders = ids.select(F.col("id").alias("pill_order_id"), F.col("name").alias("order_no"))
    items = ids.select(F.col("id").alias("pill_order_id"), (F.col("id") % 9).alias("pill_option_id"))
    options = spark.range(9).selectExpr("id AS pill_option_id", "id AS discounted_price", "0.5D AS fee_ratio", "1D AS reward_amount")
    stores = marts.store_mart(orders, items.union(items), options)
    assert stores.count() == 2000
    assert plan_of(stores, run=True).split("Initial Plan")[0].count("REPARTITION_BY_NUM") == 1
    events = ids.select(F.lit("store_complete_checkout").alias("event"), F.col("name").alias("distinct_id"),
                        F.lit(None).cast("string").alias("challenge_id"), F.col("name").alias("order_no"),
                        F.lit(False).alias("first"), F.lit("1.0").alias("order_count"), F.col("id").alias("time"))
    users = ids.limit(1).select(F.col("name").alias("distinct_id"), *[F.lit("x").alias(c) for c in USER_COLUMNS if c != "distinct_id"])
    challenges = ids.select(F.col("name").alias("challenge_id"), *[F.lit(None).cast("string").alias(c) for c in enrich.CHALLENGE_COLUMNS],
                            F.lit(1.0).alias("revenue"))
    df = enrich.enrich(events, users, challenges, stores.select("order_no", "revenue"))
    assert df.where("revenue IS NOT NULL").count() == 2000
    assert plan_of(df, run=True).split("Initial Plan")[0].count("REPARTITION_BY_NUM") == 3


def test_enriched_report_deals_its_marts_out(spark, conf):
    """Store rows, and the rows of both marts under kind and key; the report's two levels repeat them in the plan."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_of(QUERIES["enriched_report"](spark, SF_DIR))
    assert plan.count("REPARTITION_BY_NUM") == 6, plan.count("REPARTITION_BY_NUM")


def test_enriched_rows_are_made_distinct_behind_the_join(spark, conf):
    """No hash table of wide rows beside the sorts of a task that joins, and many tasks even where a session has few."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_of(QUERIES["enriched_events"](spark, SF_DIR))
    above = plan.split("SortMergeJoin")[0].split("Exchange ")
    assert len(above) == 2 and "HashAggregate" in above[0] and "HashAggregate" not in above[1]
    assert f", {dedup.LEAST_WAYS}), REPARTITION_BY_NUM" in above[1]
    parts = plan.split("Exchange ")
    dealt = [over for over, under in zip(parts, parts[1:]) if "REPARTITION_BY_NUM" in under.split("\n")[0]]
    assert [over.count("HashAggregate") for over in dealt] == [2, 2, 2]  # both in that task, without another shuffle
    assert dedup.spread_distinct(spark.range(9)).rdd.getNumPartitions() == dedup.LEAST_WAYS > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_enriched_rows_that_come_twice_or_meet_several_mart_rows(spark, rows):
    """Store rows have no challenge columns, a mart row that comes twice counts once, and NULL keys match nothing."""
    events = spark.sql("""SELECT * FROM VALUES ('store_complete_checkout', 'u', '1', '7'), ('store_complete_checkout', 'u', '1', '7'),
        ('challenge_complete_checkout', 'u', '7', '1'), ('challenge_complete_checkout', 'u', NULL, '1'), ('invite', 'u', '7', '7')
        AS t(event, distinct_id, challenge_id, order_no)""").selectExpr("*", "true AS first", "'1' AS order_count", "0L AS time")
    users = spark.range(1).select(*[F.lit("u").alias(c) for c in USER_COLUMNS])
    challenges = spark.sql("""SELECT * FROM VALUES ('7', true, 5D), ('7', true, 5D), (NULL, true, 6D) AS t(challenge_id, is_brand, revenue)""")
    challenges = challenges.select("*", *[F.lit("1").alias(c) for c in enrich.CHALLENGE_COLUMNS if c != "is_brand"])
    stores = spark.sql("SELECT * FROM VALUES ('7', 1D), ('7', 1D), ('7', 2D), (NULL, 3D) AS t(order_no, revenue)")
    got = rows(enrich.enrich(events, users, challenges, stores), "challenge_id", "order_no", "is_brand", "revenue")
    assert got == sorted([("1", "7", None, 1.0), ("1", "7", None, 2.0), ("7", "1", True, 5.0), (None, "1", None, None), ("7", "7", None, None)],
                         key=lambda t: tuple((v is not None, str(v)) for v in t))


def test_distinct_rows_of_all_tasks(spark, rows):
    """Zeros of either sign and NaN are one value each, NULL is one, and names may come twice."""
    values = spark.sql("SELECT * FROM VALUES (0D, 'a'), (-0D, 'a'), (double('NaN'), 'a'), (-double('NaN'), 'a'), (NULL, NULL), (NULL, NULL) AS t(x, y)")
    df = values.repartition(5)
    assert len(rows(dedup.spread_distinct(df))) == 3
    assert dedup.spread_distinct(df.toDF("x", "x")).columns == ["x", "x"]


def test_channels_share_their_rows(spark, conf):
    """The rows of all exports are worked out once; what is left to join is the spend of one channel."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    for _ in range(2):  # landed rows are replaced, not added to
        df = QUERIES["channel_unify"](spark, SF_DIR)
        plan = plan_of(df)
        assert plan.count("Join ") == 1 and "lineitem" not in plan
        found = {r.channel: r["count"] for r in df.groupBy("channel").count().collect()}
    for channel in ("facebook", "google", "naver", "adison", "pincrux"):
        assert found[channel] == QUERIES[f"channel_{channel}"](spark, SF_DIR).count()


def test_devices_are_mapped_in_one_pass(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    rows = spark.range(100).selectExpr("concat(if(id % 2 = 0, 'd-', 'u'), id) AS distinct_id", "id AS n")
    info = spark.createDataFrame([("d-4", "u1")], "device_id string, distinct_id string")
    df = identity.devices_to_users(rows, info)
    assert plan_of(df).count("Range ") == 1
    got = {r.n: r.distinct_id for r in df.collect()}
    assert (len(got), got[4], got[6], got[7]) == (100, "u1", "d-6", "u7")


def test_queries_leave_the_session_as_it_was(spark, conf):
    key = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    conf(**{key.replace(".", "__"): "false"})
    QUERIES["campaign_report_all"](spark, SF_DIR)
    assert spark.conf.get(key) == "false"
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("given_")]

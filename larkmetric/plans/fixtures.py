"""Inputs of every operator, derived from the given tables.

Plain SQL that Spark and DuckDB both run, so a query and its check start from
the same rows. Session time zone plays no part.
"""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

AS_OF = "2024-01-30"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
TABLES += ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

SQL = {
    # --- users: two snapshots, which disagree for one segment ---------------
    "fx_user": """
        SELECT concat('u', CAST(c_custkey AS STRING)) AS distinct_id,
               CASE WHEN c_nationkey % 3 = 0 THEN NULL
                    WHEN c_nationkey % 3 = 1 THEN ' '
                    ELSE c_mktsegment END AS corp_name,
               CASE WHEN c_nationkey % 5 = 0 THEN NULL
                    ELSE concat('src', CAST(c_nationkey % 5 AS STRING)) END AS media_source,
               CASE WHEN c_mktsegment = 'BUILDING' THEN NULL
                    ELSE concat('camp%20', c_mktsegment) END AS campaign
        FROM customer""",
    "fx_user_store": """
        SELECT distinct_id, corp_name,
               CASE WHEN campaign = 'camp%20MACHINERY' THEN 'src9' ELSE media_source END AS media_source,
               CASE WHEN campaign = 'camp%20FURNITURE' THEN 'test' ELSE campaign END AS campaign
        FROM fx_user""",
    # --- app events -----------------------------------------------------------
    "fx_event": """
        SELECT event_id, ts,
               CASE event_type
                 WHEN 'click'  THEN '$ae_first_open'
                 WHEN 'signup' THEN 'signup'
                 WHEN 'view'   THEN 'invite'
                 WHEN 'error'  THEN 'content_view'
                 ELSE CASE event_id % 3 WHEN 0 THEN 'challenge_complete_checkout'
                                        WHEN 1 THEN 'brand_challenge_complete_checkout'
                                        ELSE 'store_complete_checkout' END
               END AS event,
               concat('u', CAST(user_id AS STRING)) AS distinct_id,
               concat('dev-', CAST(user_id AS STRING)) AS device_id,
               CASE WHEN event_id % 7 = 0 THEN concat('dev-', CAST(user_id AS STRING))
                    ELSE concat('u', CAST(user_id AS STRING)) END AS raw_id,
               event_id % 4 = 0 AS first,
               CASE event_id % 5 WHEN 0 THEN '1.0' WHEN 1 THEN '1' WHEN 2 THEN '2.0' WHEN 3 THEN 'bad' ELSE 'None' END
                   AS order_count,
               CAST(event_id AS STRING) AS challenge_id,
               CAST(event_id AS STRING) AS order_no,
               CAST(ts - INTERVAL '9' HOUR AS DATE) AS event_date,
               CAST(value AS DECIMAL(18,2)) AS revenue
        FROM events""",
    "fx_attributed": """
        SELECT e.*, e.ts AS time, u.media_source, u.campaign
        FROM fx_event e LEFT JOIN fx_user u ON e.distinct_id = u.distinct_id""",
    "fx_raw": """
        SELECT event, raw_id AS distinct_id, device_id, event_date, order_count,
               CASE WHEN event_id % 5 = 0 THEN distinct_id ELSE 'None' END AS alt_id,
               concat('i', CAST(event_id AS STRING)) AS insert_id,
               event_id AS seq,
               CASE WHEN event_id % 9 = 0 THEN 'brand' END AS kind_flag,
               CASE event_id % 6 WHEN 0 THEN '0' WHEN 1 THEN '0.0' WHEN 2 THEN 'many'
                    WHEN 3 THEN NULL ELSE CAST(revenue AS STRING) END AS amount,
               CASE WHEN event_id % 3 = 0 THEN concat('new', event_id) END AS title_new,
               CASE WHEN event_id % 2 = 0 THEN concat('old', event_id) END AS title,
               CASE event_id % 5 WHEN 0 THEN concat('[', event_id, ', ', length(distinct_id), ']')
                    WHEN 1 THEN CAST(event_id AS STRING) WHEN 2 THEN '[]' WHEN 3 THEN 'bad' END AS challenge_ids,
               CASE event_id % 6 WHEN 0 THEN '' WHEN 1 THEN 'None'
                    WHEN 2 THEN '00000000-0000-0000-0000-000000000000'
                    WHEN 3 THEN 'test' ELSE raw_id END AS dirty
        FROM fx_event""",
    "fx_id_type": """
        SELECT CAST(o_orderkey AS STRING) AS challenge_id,
               CASE WHEN o_orderstatus = 'P' THEN '1' WHEN o_orderstatus = 'F' THEN '3' ELSE '2' END AS service_type
        FROM orders""",
    "fx_af": """
        SELECT CASE event WHEN '$ae_first_open' THEN 'install'
                          WHEN 'content_view' THEN 'af_content_view'
                          WHEN 'challenge_complete_checkout' THEN 'apply_complete_payment_server'
                          WHEN 'brand_challenge_complete_checkout' THEN 'apply_complete_payment_server'
                          ELSE event END AS event,
               raw_id AS appsflyer_id,
               CASE WHEN event_id % 11 = 0 THEN NULL ELSE distinct_id END AS user_id,
               CAST(date_trunc('second', ts) AS STRING) AS time,
               CAST(ts AS DATE) AS event_date,
               CASE event_id % 5 WHEN 0 THEN 'inapp' WHEN 1 THEN 'install' WHEN 2 THEN 'org_inapp'
                    WHEN 3 THEN 'org_install' ELSE 'reinstall' END AS kind
        FROM fx_event""",
    # --- ads --------------------------------------------------------------------
    "fx_line": """
        SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity, l_extendedprice,
               c_mktsegment, p_brand, p_type
        FROM lineitem
        JOIN orders   ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey  = c_custkey
        JOIN part     ON l_partkey  = p_partkey""",
    "fx_ad": """
        SELECT concat('src', CAST(l_suppkey % 5 AS STRING)) AS channel,
               CASE WHEN l_suppkey % 5 = 4 THEN NULL
                    ELSE concat('camp%20', c_mktsegment) END AS campaign,
               CASE WHEN l_suppkey % 5 >= 3 THEN NULL ELSE p_brand END AS adset,
               CASE WHEN l_suppkey % 5 >= 2 THEN NULL ELSE p_type END AS ad,
               DATE '2023-12-28' + CAST(l_orderkey % 40 AS INT) AS date,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS spend,
               concat('₩', CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING)) AS spend_text,
               CAST(l_quantity AS DECIMAL(18,2)) AS impressions,
               CAST(l_linenumber AS DECIMAL(18,2)) AS clicks
        FROM fx_line""",
    "fx_ad_text": """
        SELECT CAST(date AS STRING) AS day, channel, campaign, adset, ad, spend_text,
               CAST(spend AS STRING) AS spend_plain,
               CAST(impressions AS STRING) AS impressions_text,
               CASE WHEN clicks = 1 THEN '-5' WHEN clicks = 2 THEN '1e-5' WHEN clicks = 3 THEN '1.2.3'
                    WHEN clicks = 4 THEN '' WHEN clicks = 5 THEN 'None' WHEN clicks = 6 THEN '#DIV/0!'
                    ELSE '1,200' END AS clicks_text,
               CASE WHEN clicks = 1 THEN '0' WHEN clicks = 2 THEN '0.0' WHEN clicks = 3 THEN '-1'
                    ELSE CAST(spend AS STRING) END AS cost_text
        FROM fx_ad""",
    "fx_sheet": """
        SELECT CAST(DATE '2023-12-28' + CAST(o_orderkey % 40 AS INT) AS STRING) AS date,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'Pincrux' ELSE 'Other' END AS channel,
               CASE WHEN o_orderstatus = 'P' THEN 'None'
                    ELSE concat('₩', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)) END AS cost_text,
               o_orderkey AS row_no
        FROM orders""",
    "fx_wide": """
        SELECT CAST(CAST(o_orderdate AS DATE) AS STRING) AS date,
               CAST(CAST(max(o_totalprice) AS DECIMAL(18,2)) AS STRING) AS cost_a,
               CAST(CAST(min(o_totalprice) AS DECIMAL(18,2)) AS STRING) AS cost_b,
               CAST(count(*) AS STRING) AS clicks_b,
               max(o_orderpriority) AS note
        FROM orders GROUP BY CAST(CAST(o_orderdate AS DATE) AS STRING)""",
    "fx_search_campaign": """
        SELECT concat('c', CAST(s_suppkey AS STRING)) AS ncc_campaign_id, s_name AS name,
               CAST(s_nationkey AS STRING) AS status
        FROM supplier""",
    "fx_search_campaign_stat": """
        SELECT concat('c', CAST(l_suppkey AS STRING)) AS id, CAST(count(*) AS STRING) AS clk,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS STRING) AS sales
        FROM lineitem GROUP BY l_suppkey HAVING sum(l_linenumber) > 4 * count(*)""",
    "fx_search_group": """
        SELECT DISTINCT concat('g', CAST(l_suppkey AS STRING), '.', CAST(l_partkey AS STRING)) AS ncc_adgroup_id,
               concat('c', CAST(l_suppkey AS STRING)) AS ncc_campaign_id,
               concat('group ', CAST(l_partkey AS STRING)) AS name
        FROM lineitem""",
    "fx_search_group_stat": """
        SELECT concat('g', CAST(l_suppkey AS STRING), '.', CAST(l_partkey AS STRING)) AS id,
               CAST(count(*) AS STRING) AS clk,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS STRING) AS sales
        FROM lineitem GROUP BY l_suppkey, l_partkey HAVING sum(l_quantity) > 25 * count(*)""",
    # --- relational snapshots -----------------------------------------------------
    "fx_challenge": """
        SELECT CAST(o_orderkey AS STRING) AS challenge_id, CAST(o_custkey AS STRING) AS goal_id,
               CASE o_orderkey % 3 WHEN 0 THEN '[{"name": "instagram"}]'
                    WHEN 1 THEN '[{"name": "photo"}, {"name": "memo"}]' ELSE '[]' END AS custom_fields
        FROM orders""",
    "fx_goal": """
        SELECT CAST(c_custkey AS STRING) AS goal_id, CAST(c_nationkey AS STRING) AS goal_category_id
        FROM customer""",
    "fx_category": """
        SELECT CAST(n_nationkey AS STRING) AS goal_category_id,
               concat('area', CAST(n_regionkey AS STRING)) AS level2, n_name AS level3
        FROM nation""",
    "fx_user_challenge": """
        SELECT CAST(l_orderkey AS STRING) AS challenge_id, concat('u', CAST(l_suppkey AS STRING)) AS distinct_id
        FROM lineitem""",
    "fx_result": """
        SELECT CAST(l_orderkey AS STRING) AS challenge_id, count(*) AS register_count,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS margin
        FROM lineitem GROUP BY l_orderkey""",
    "fx_info": """
        SELECT CAST(o_orderkey AS STRING) AS challenge_id,
               CAST(floor(o_totalprice / 100) AS BIGINT) AS register_count,
               CAST(o_custkey AS STRING) AS fee
        FROM orders""",
    "fx_commerce": """
        SELECT DISTINCT concat('m', CAST(l_orderkey AS STRING), '.', CAST(l_linenumber AS STRING))
                   AS challenge_commerce_id,
               CAST(l_orderkey AS STRING) AS challenge_id
        FROM lineitem WHERE l_returnflag = 'R'""",
    "fx_bridge": """
        SELECT concat('m', CAST(l_orderkey AS STRING), '.', CAST(l_linenumber AS STRING)) AS challenge_commerce_id,
               CAST(l_partkey AS STRING) AS product_id
        FROM lineitem""",
    "fx_product": """
        SELECT CAST(p_partkey AS STRING) AS product_id, p_name AS name,
               CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS STRING) AS price,
               CASE WHEN p_size > 25 THEN NULL ELSE CAST(p_size AS STRING) END AS product_fee
        FROM part""",
    "fx_store_order": """
        SELECT o_orderkey AS pill_order_id, CAST(o_orderkey AS STRING) AS order_no FROM orders""",
    "fx_store_item": """
        SELECT l_orderkey AS pill_order_id, l_partkey AS pill_option_id FROM lineitem""",
    "fx_store_option": """
        SELECT p_partkey AS pill_option_id, CAST(floor(p_retailprice) AS BIGINT) AS discounted_price,
               CAST(p_size AS DOUBLE) / 64 AS fee_ratio, CAST(p_size AS DOUBLE) / 4 AS reward_amount
        FROM part""",
    # --- lifetime value -------------------------------------------------------------
    "fx_day": """
        SELECT raw_id AS distinct_id, event, event_date,
               CASE WHEN event = 'brand_challenge_complete_checkout' THEN CAST(revenue AS DOUBLE) END
                   AS revenue_from_brand,
               CASE WHEN event = 'challenge_complete_checkout' THEN CAST(revenue AS DOUBLE) * 2 END
                   AS revenue_from_challenge,
               CAST(revenue AS DOUBLE) AS revenue
        FROM fx_event""",
    "fx_user_info": """
        SELECT DISTINCT raw_id AS device_id, distinct_id FROM fx_event WHERE raw_id LIKE '%-%'""",
}


def _names(text: str) -> list[str]:
    """Fixtures the text needs, each after those it is made from."""
    found: list[str] = []

    def visit(body: str) -> None:
        for name in dict.fromkeys(re.findall(r"\bfx_\w+", body)):
            if name not in found:
                visit(SQL[name])
                found.append(name)

    visit(text)
    return found


def with_fixtures(body: str, *extra: str) -> str:
    """SQL with the fixtures it uses as common table expressions."""
    ctes = [*extra, *[f"{name} AS ({SQL[name]})" for name in _names(body)]]
    if not ctes:
        return body
    more = re.match(r"\s*WITH\s+", body)
    tail = f", {body[more.end():]}" if more else f" {body}"
    return f"WITH {', '.join(ctes)}{tail}"


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the files once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    used = " ".join([SQL[n] for n in _names(name)])
    scans, views = [], []
    for given in TABLES:
        if re.search(rf"\b{given}\b", used):
            view = f"given_{given}_{zlib.crc32(sf_dir.encode()):08x}"
            table(spark, sf_dir, given).createOrReplaceTempView(view)
            scans.append(f"{given} AS (SELECT * FROM {view})")
            views.append(view)
    rows = spark.sql(with_fixtures(f"SELECT * FROM {name}", *scans))
    for view in views:  # the frame is resolved and needs them no more
        spark.catalog.dropTempView(view)
    return rows

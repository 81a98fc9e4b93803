"""The SQL each query is checked against, run by DuckDB on the same tables.

Written from the meaning of each operator, not from its plan: plain joins,
``count(DISTINCT …)`` and one branch per period or level.
"""

from __future__ import annotations

from .fixtures import AS_OF, with_fixtures

CHECKS: dict[str, str] = {}

D0, D6, D29 = f"DATE '{AS_OF}'", "DATE '2024-01-24'", "DATE '2024-01-01'"
PERIODS = f"(VALUES ('monthly', {D29}), ('weekly', {D6}), ('daily', {D0})) p(period, start)"
KEYS = "coalesce(media_source, 'organic') AS media_source, coalesce(campaign, 'organic') AS campaign"
CHALLENGE = "challenge_complete_checkout"
BRAND = "brand_challenge_complete_checkout"
STORE = "store_complete_checkout"
PAID = f"('{CHALLENGE}', '{BRAND}', '{STORE}')"


def check(name: str, body: str) -> None:
    CHECKS[name] = with_fixtures(body)


# --- campaign metrics ----------------------------------------------------------------

ORDER_ONE = "TRY_CAST(order_count AS DOUBLE) = 1"
COUNTS = {
    "installs": ("event = '$ae_first_open'", "unique_installs", "count_installs"),
    "signups": ("event = 'signup'", "unique_signups", "count_signups"),
    "invites": ("event = 'invite'", "unique_invites", "count_invites"),
    "store_checkouts": (f"event = '{STORE}'", "unique_store_checkouts", "count_store_checkouts"),
    "first_store_checkouts": (
        f"event = '{STORE}' AND {ORDER_ONE}",
        "unique_first_store_checkouts",
        "count_first_store_checkouts",
    ),
    "challenge_checkouts": (
        f"event = '{CHALLENGE}'",
        "challenge_complete_checkout_user_count",
        "challenge_complete_checkout_count",
    ),
    "brand_checkouts": (
        f"event = '{BRAND}'",
        "challenge_complete_checkout_brand_user_count",
        "challenge_complete_checkout_brand_count",
    ),
    "first_challenge_checkouts": (
        f"event = '{CHALLENGE}' AND first",
        "first_challenge_complete_checkout_user_count",
        "first_challenge_complete_checkout_count",
    ),
    "first_brand_checkouts": (
        f"event = '{BRAND}' AND first",
        "first_challenge_complete_checkout_brand_user_count",
        "first_challenge_complete_checkout_brand_count",
    ),
}
STORE_COUNTS = {
    "store_complete": (
        f"event = '{STORE}'",
        "store_complete_checkout_user_count",
        "store_complete_checkout_count",
    ),
    "first_store_complete": (
        f"event = '{STORE}' AND first",
        "first_store_complete_checkout_user_count",
        "first_store_complete_checkout_count",
    ),
}
REVENUES = {
    "challenge_revenue": CHALLENGE,
    "challenge_brand_revenue": BRAND,
    "store_revenue": STORE,
}

for _key, (_cond, _users, _events) in {**COUNTS, **STORE_COUNTS}.items():
    check(
        f"{_key}_by_campaign",
        f"""SELECT {KEYS}, count(DISTINCT distinct_id) AS {_users}, count(time) AS {_events}
            FROM fx_attributed WHERE {_cond} GROUP BY 1, 2""",
    )
for _name, _event in REVENUES.items():
    check(
        f"{_name}_by_campaign",
        f"""SELECT {KEYS}, CAST(coalesce(sum(revenue), 0) AS DOUBLE) AS {_name}
            FROM fx_attributed WHERE event = '{_event}' GROUP BY 1, 2""",
    )
check(
    "revenue_by_campaign",
    f"""SELECT media_source, campaign, CAST(coalesce(sum(revenue), 0) AS DOUBLE) AS revenue
        FROM fx_attributed WHERE event IN {PAID} AND media_source IS NOT NULL AND campaign IS NOT NULL
        GROUP BY 1, 2""",
)
check(
    "mau_by_source",
    """SELECT coalesce(media_source, 'organic') AS media_source, count(DISTINCT distinct_id) AS mau
       FROM fx_attributed GROUP BY 1""",
)
check(
    "dau_by_source",
    """SELECT media_source, avg(n) AS dau FROM (
         SELECT media_source, event_date, count(DISTINCT distinct_id) AS n FROM fx_attributed
         WHERE media_source IS NOT NULL GROUP BY 1, 2) d GROUP BY 1""",
)
check("mau_by_campaign", f"SELECT {KEYS}, count(DISTINCT distinct_id) AS mau FROM fx_attributed GROUP BY 1, 2")
check(
    "dau_by_campaign",
    """SELECT media_source, campaign, avg(n) AS dau FROM (
         SELECT media_source, campaign, event_date, count(DISTINCT distinct_id) AS n FROM fx_attributed
         WHERE media_source IS NOT NULL AND campaign IS NOT NULL GROUP BY 1, 2, 3) d GROUP BY 1, 2""",
)


def report_ctes(rows: str) -> str:
    """``report``: every metric by period, level and keys, over the frame ``rows``."""
    measures, out = [], []
    for cond, users, events in COUNTS.values():
        measures.append(f"count(DISTINCT CASE WHEN {cond} THEN distinct_id END) AS u_{users}")
        measures.append(f"count(CASE WHEN {cond} THEN 1 END) AS {events}")
        out.append(f"CASE WHEN {events} > 0 THEN u_{users} END AS {users}")
        out.append(f"nullif({events}, 0) AS {events}")
    kinds = {"revenue": (f"event IN {PAID} AND keyed", "r_all")}
    kinds |= {n: (f"event = '{e}'", f"r_{n}") for n, e in REVENUES.items()}
    for name, (cond, alias) in kinds.items():
        measures.append(f"sum(CASE WHEN {cond} THEN revenue END) AS {alias}")
        measures.append(f"count(CASE WHEN {cond} THEN 1 END) AS {alias}_n")
        out.append(f"CASE WHEN {alias}_n > 0 THEN CAST(coalesce({alias}, 0) AS DOUBLE) END AS {name}")
    return f"""
      lv AS (SELECT 'campaign' AS level, coalesce(media_source, 'organic') AS ms, coalesce(campaign, 'organic') AS c,
                    media_source IS NOT NULL AND campaign IS NOT NULL AS keyed, r.* FROM {rows} r
             WHERE event_date BETWEEN {D29} AND {D0}
             UNION ALL
             SELECT 'media_source', coalesce(media_source, 'organic'), NULL, media_source IS NOT NULL, r.* FROM {rows} r
             WHERE event_date BETWEEN {D29} AND {D0}),
      m AS (SELECT period, level, ms, c, count(DISTINCT distinct_id) AS mau FROM lv CROSS JOIN {PERIODS}
            GROUP BY 1, 2, 3, 4),
      x AS (SELECT period, level, ms, c, {', '.join(measures)} FROM lv JOIN {PERIODS} ON event_date >= start
            GROUP BY 1, 2, 3, 4),
      d AS (SELECT period, level, ms, c, avg(n) AS dau FROM (
              SELECT period, level, ms, c, event_date, count(DISTINCT distinct_id) AS n
              FROM lv JOIN {PERIODS} ON event_date >= start WHERE keyed GROUP BY 1, 2, 3, 4, 5) q
            GROUP BY 1, 2, 3, 4),
      report AS (
        SELECT m.period, m.level, m.ms AS media_source, m.c AS campaign, mau, dau, {', '.join(out)}, {D0} AS date
        FROM m
        LEFT JOIN x ON m.period = x.period AND m.level = x.level AND m.ms = x.ms AND m.c IS NOT DISTINCT FROM x.c
        LEFT JOIN d ON m.period = d.period AND m.level = d.level AND m.ms = d.ms AND m.c IS NOT DISTINCT FROM d.c)"""


REPORT = f"WITH {report_ctes('fx_attributed')}"
DECODED = "* REPLACE (url_decode(media_source) AS media_source, url_decode(campaign) AS campaign)"
check("campaign_report_all", f"{REPORT} SELECT {DECODED} FROM report")
check("campaign_report_of_days", f"{REPORT} SELECT {DECODED} FROM report")
check("campaign_report_enriched", f"{REPORT} SELECT {DECODED} FROM report")
check(
    "campaign_report_monthly",
    f"""{REPORT} SELECT * EXCLUDE (period, level, campaign) REPLACE (url_decode(media_source) AS media_source) FROM report
        WHERE period = 'monthly' AND level = 'media_source'""",
)

METRICS = ["spend", "impressions", "clicks"]
SUMS = ", ".join(f"CAST(sum({m}) AS DOUBLE) AS {m}" for m in METRICS)
LEVELS = {
    "channel": ("NULL", "NULL", "NULL", "channel IS NOT NULL"),
    "campaign": ("channel", "NULL", "NULL", "channel IS NOT NULL AND campaign IS NOT NULL"),
    "adset": ("channel", "campaign", "NULL", "channel IS NOT NULL AND campaign IS NOT NULL AND adset IS NOT NULL"),
    "ad": (
        "channel",
        "campaign",
        "adset",
        "channel IS NOT NULL AND campaign IS NOT NULL AND adset IS NOT NULL AND ad IS NOT NULL",
    ),
}


def rollup_sql(source: str, extra: str = "") -> str:
    parts = []
    for level, (channel, campaign, adset, keep) in LEVELS.items():
        group = ", ".join(g for g in [extra.strip(", "), "key", "value", "g1", "g2", "g3"] if g)
        parts.append(
            f"""SELECT {group}, {SUMS} FROM (
                  SELECT {extra} '{level}' AS key, {level} AS value, CAST({channel} AS VARCHAR) AS g1,
                         CAST({campaign} AS VARCHAR) AS g2, CAST({adset} AS VARCHAR) AS g3,
                         spend, impressions, clicks FROM {source} WHERE {keep}) q
                GROUP BY {group}"""
        )
    names = f"{extra} key, value, g1 AS channel, g2 AS campaign, g3 AS adset, spend, impressions, clicks"
    return f"SELECT {names} FROM ({' UNION ALL '.join(parts)}) u"


check("ad_rollup", rollup_sql("fx_ad"))
WINDOWED = f"(SELECT period, a.* FROM fx_ad a JOIN {PERIODS} ON a.date >= start AND a.date <= {D0}) w"
check("ad_rollup_periods", rollup_sql(WINDOWED, "period, "))
check(
    "ad_rollup_ratios",
    f"""SELECT key, value, channel, campaign, adset,
               CASE WHEN impressions > 0 THEN clicks / impressions * 100 END AS ctr_of_sums,
               CASE WHEN impressions > 0 THEN spend / impressions * 1000 END AS cpm_of_sums,
               CASE WHEN clicks > 0 THEN spend / clicks END AS cpc_of_sums
        FROM ({rollup_sql('fx_ad')}) r""",
)
check(
    "report_with_spend",
    f"""{REPORT}, ads AS ({rollup_sql(WINDOWED, "period, ")}),
        slots AS (
          SELECT period, 'media_source' AS level, value AS media_source, NULL AS campaign, spend, impressions, clicks
          FROM ads WHERE key = 'channel'
          UNION ALL
          SELECT period, 'campaign', channel, value, spend, impressions, clicks FROM ads WHERE key = 'campaign')
        SELECT coalesce(r.period, s.period) AS period, coalesce(r.level, s.level) AS level,
               url_decode(coalesce(r.media_source, s.media_source)) AS media_source,
               url_decode(coalesce(r.campaign, s.campaign)) AS campaign,
               r.* EXCLUDE (period, level, media_source, campaign, date), spend, impressions, clicks, {D0} AS date
        FROM report r FULL JOIN slots s
          ON r.period = s.period AND r.level = s.level AND r.media_source = s.media_source
         AND r.campaign IS NOT DISTINCT FROM s.campaign""",
)


# --- ads ---------------------------------------------------------------------------------


def number(column: str) -> str:
    return f"TRY_CAST(regexp_replace({column}, '[^0-9.]', '', 'g') AS DOUBLE)"


SPEND, SHOWN, CLICKED, COST = (number(c) for c in ("spend_text", "impressions_text", "clicks_text", "cost_text"))

FACEBOOK_SQL = f"""SELECT day AS date, campaign, adset, ad, {SPEND} AS spend, {SHOWN} AS impressions,
    {CLICKED} AS clicks, {SHOWN} AS reach, {COST} AS cpm, {CLICKED} AS ctr, {SPEND} AS cpp, 'facebook' AS channel
    FROM fx_ad_text"""
GOOGLE_SQL = f"""SELECT day AS date, {CLICKED} AS status, campaign, adset, ad, {SHOWN} AS impressions,
    {COST} AS spend, {CLICKED} AS clicks, channel AS adset_id, {SPEND} AS cpm, {COST} AS cpc, {CLICKED} AS ctr,
    {SHOWN} AS conversions, 'google' AS channel FROM fx_ad_text WHERE cost_text > '0'"""
NAVER_SQL = f"""SELECT * FROM (SELECT day AS date, campaign, adset, ad AS adset_id, {CLICKED} AS clicks,
    {SHOWN} AS impressions, {COST} AS spend, ad, {CLICKED} AS ctr, {SPEND} AS ror, {SHOWN} AS views, {COST} AS cpc,
    {CLICKED} AS conversions, 'naver' AS channel FROM fx_ad_text) n WHERE spend > 0"""
ADISON_SQL = f"""SELECT day AS date, ad AS platform, campaign, {SHOWN} AS impressions, {CLICKED} AS clicks,
    {CLICKED} AS participations, {SHOWN} AS completes, {SPEND} AS spend,
    {CLICKED} AS unique_participations, {SPEND} AS ctr, {COST} AS cvr, 'adison' AS channel FROM fx_ad_text"""
LOOKUP_SQL = """SELECT date, cost_text FROM (
    SELECT *, row_number() OVER (PARTITION BY date ORDER BY row_no) AS rn FROM fx_sheet
    WHERE channel = 'Pincrux' AND cost_text <> 'None') f WHERE rn = 1"""
PINCRUX_SQL = f"""SELECT d.date, d.clicks, d.completes, {number('l.cost_text')} AS spend, 'pincrux' AS channel
    FROM (SELECT day AS date, CAST(coalesce(sum(CAST({CLICKED} AS DECIMAL(24,6))), 0) AS DOUBLE) AS clicks,
                 CAST(coalesce(sum(CAST({SHOWN} AS DECIMAL(24,6))), 0) AS DOUBLE) AS completes
          FROM fx_ad_text GROUP BY day) d
    LEFT JOIN ({LOOKUP_SQL}) l ON d.date = l.date"""

check("channel_facebook", FACEBOOK_SQL)
check("channel_google", GOOGLE_SQL)
check("channel_naver", NAVER_SQL)
check("channel_adison", ADISON_SQL)
check("channel_pincrux", PINCRUX_SQL)
check("spend_lookup", LOOKUP_SQL)
check(
    "per_date_sum",
    """SELECT date, CAST(sum(clicks) AS DOUBLE) AS clicks, CAST(sum(impressions) AS DOUBLE) AS impressions
       FROM fx_ad GROUP BY date""",
)
OWN_COLUMNS = {
    FACEBOOK_SQL: ["campaign", "adset", "ad", "spend", "impressions", "clicks", "reach", "cpm", "ctr", "cpp"],
    GOOGLE_SQL: [
        "status", "campaign", "adset", "ad", "impressions", "spend", "clicks", "adset_id", "cpm", "cpc", "ctr", "conversions",
    ],
    NAVER_SQL: [
        "campaign", "adset", "adset_id", "ad", "clicks", "impressions", "spend", "ctr", "ror", "views", "cpc", "conversions",
    ],
    ADISON_SQL: [
        "platform", "campaign", "impressions", "clicks", "participations", "completes", "spend", "unique_participations",
        "ctr", "cvr",
    ],
    PINCRUX_SQL: ["clicks", "completes", "spend"],
}
ALL_COLUMNS = list(dict.fromkeys(c for own in OWN_COLUMNS.values() for c in own))
check(
    "channel_unify",
    " UNION ALL ".join(
        f"""SELECT CAST(date AS DATE) AS date, channel, {', '.join(c if c in own else f'NULL AS {c}' for c in ALL_COLUMNS)}
            FROM ({sql}) q"""
        for sql, own in OWN_COLUMNS.items()
    ),
)
check(
    "derived_ad_cost",
    """SELECT date, ad, CAST(trunc(CAST(spend AS DOUBLE) * 1000 * CAST(clicks AS BIGINT) / 1000000) AS BIGINT) AS cost,
              CAST(spend AS DOUBLE) / 1000000 AS cpm, CAST(impressions AS DOUBLE) / 1000000 AS cpc
       FROM fx_ad""",
)
check(
    "unpivot_costs",
    """SELECT date, 'Pincrux' AS channel, cost_a AS cost_value, NULL AS clicks_value FROM fx_wide WHERE date >= '1996-07-01'
       UNION ALL SELECT date, 'Naver', cost_b, NULL FROM fx_wide WHERE date >= '1996-07-01'
       UNION ALL SELECT date, 'Naver', NULL, clicks_b FROM fx_wide WHERE date >= '1996-07-01'""",
)
check(
    "unpivot_channel_first",
    """SELECT date, 'Pincrux' AS channel, cost_a AS cost_value, NULL AS clicks_value, NULL AS note_value
       FROM fx_wide WHERE date <= '2000-01-01'
       UNION ALL SELECT date, 'Naver', cost_b, NULL, NULL FROM fx_wide WHERE date <= '2000-01-01'
       UNION ALL SELECT date, 'Naver', NULL, clicks_b, NULL FROM fx_wide WHERE date <= '2000-01-01'
       UNION ALL SELECT date, 'total_note', NULL, NULL, note FROM fx_wide WHERE date <= '2000-01-01'""",
)
check(
    "naver_stats_join",
    """SELECT c.name AS campaign_name, c.status AS campaign_status, cs.id AS campaign_id, cs.clk AS "campaign_clkCnt",
              cs.sales AS "campaign_salesAmt", g.ncc_adgroup_id AS "adgroup_nccAdgroupId",
              g.ncc_campaign_id AS "adgroup_nccCampaignId", g.name AS adgroup_name, gs.id AS adgroup_id,
              gs.clk AS "adgroup_clkCnt", gs.sales AS "adgroup_salesAmt"
       FROM fx_search_campaign c
       LEFT JOIN fx_search_campaign_stat cs ON c.ncc_campaign_id = cs.id
       JOIN fx_search_group g ON c.ncc_campaign_id = g.ncc_campaign_id
       JOIN fx_search_group_stat gs ON g.ncc_adgroup_id = gs.id""",
)

# --- event cleansing -------------------------------------------------------------------------

NO_VALUE = "('None', '', '00000000-0000-0000-0000-000000000000')"


def cleaned(column: str, values: str = NO_VALUE) -> str:
    return f"CASE WHEN {column} NOT IN {values} THEN {column} END"


IDS = """unnest(CASE WHEN challenge_ids LIKE '[%' AND challenge_ids <> '[]'
                     THEN string_split(replace(substr(challenge_ids, 2, length(challenge_ids) - 2), ' ', ''), ',')
                     WHEN challenge_ids ~ '^[0-9]+$' THEN [challenge_ids] ELSE [NULL] END)"""
ZERO = "amount IS NULL OR TRY_CAST(amount AS DOUBLE) = 0"
OWN_ID = """CASE WHEN distinct_id LIKE '%-%' AND alt_id NOT LIKE '%-%' AND alt_id <> 'None'
                 THEN alt_id ELSE distinct_id END"""
FLAGS = """SELECT challenge_id AS cid, max(CASE WHEN service_type = '1' THEN 1 ELSE 0 END) AS is_b,
                  max(CASE WHEN service_type = '3' THEN 1 ELSE 0 END) AS is_c
           FROM fx_id_type GROUP BY challenge_id"""
MAPPED = f"""own AS (SELECT * REPLACE ({OWN_ID} AS distinct_id) FROM fx_raw),
    known AS (SELECT device_id, arg_max(distinct_id, seq) AS known_id FROM own
              WHERE distinct_id NOT LIKE '%-%' GROUP BY device_id),
    mapped AS (SELECT o.* REPLACE (coalesce(k.known_id, o.distinct_id) AS distinct_id)
               FROM own o LEFT JOIN known k ON o.device_id = k.device_id)"""

check(
    "sentinel_null",
    f"SELECT seq, {cleaned('alt_id')} AS alt_id, {cleaned('dirty')} AS dirty, {cleaned('amount')} AS amount FROM fx_raw",
)
TESTS = "('', 'None', 'test', '테스트')"
check(
    "test_data_null",
    f"SELECT seq, {cleaned('alt_id', TESTS)} AS alt_id, {cleaned('dirty', TESTS)} AS dirty FROM fx_raw",
)
check(
    "column_merge",
    """SELECT seq, nullif(coalesce(title_new, title, '') || '/' || coalesce(kind_flag, ''), '/') AS title FROM fx_raw""",
)
RELABELLED = f"""CASE WHEN e = '{CHALLENGE}' AND ({ZERO}) THEN 'zero_{CHALLENGE}' ELSE e END"""
FLAGGED = "SELECT *, CASE WHEN kind_flag = 'brand' THEN 'brand_' || event ELSE event END AS e FROM"
check("event_relabel", f"SELECT seq, {RELABELLED} AS event FROM ({FLAGGED} fx_raw) q")
check(
    "membership_relabel",
    f"""SELECT seq, CASE WHEN is_c = 1 THEN 'corp_' ELSE '' END || CASE WHEN is_b = 1 THEN 'brand_' ELSE '' END || event
               AS event, challenge_id
        FROM (SELECT seq, event, {IDS} AS challenge_id FROM fx_raw) q LEFT JOIN ({FLAGS}) f ON challenge_id = cid""",
)
CORRECTED = f"""CASE WHEN service_type = 3 THEN 'corp_{CHALLENGE}'
                     WHEN event = '{CHALLENGE}' AND service_type = 1 THEN '{BRAND}'
                     WHEN event = '{BRAND}' AND service_type = 2 THEN '{CHALLENGE}' ELSE event END"""
check(
    "service_type_correction",
    f"""SELECT event_id, {CORRECTED} AS event FROM (
          SELECT event_id, event, CAST(service_type AS INT) AS service_type
          FROM fx_event e LEFT JOIN fx_id_type t ON e.challenge_id = t.challenge_id) q""",
)
check(
    "row_filter",
    f"""SELECT seq, event, dirty FROM fx_raw WHERE dirty NOT IN {NO_VALUE} AND event <> 'invite'""",
)
check(
    "first_flag",
    """SELECT event_id, CAST(NULL AS VARCHAR) AS order_no, order_count = '1.0' AS first_by_text,
              coalesce(TRY_CAST(order_count AS DOUBLE) = 1, false) AS first_by_number FROM fx_event""",
)
check(
    "local_event_date",
    """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS time, CAST(ts - INTERVAL '9' HOUR AS DATE) AS event_date
       FROM events""",
)
check(
    "period_labels",
    f"""SELECT event_id, event_date, period FROM fx_event JOIN {PERIODS} ON event_date >= start AND event_date <= {D0}""",
)
check(
    "id_and_flag_casts",
    """SELECT seq, CAST(CAST(trunc(TRY_CAST(amount AS DOUBLE)) AS BIGINT) AS VARCHAR) AS goal_id,
              CAST(trunc(TRY_CAST(amount AS DOUBLE)) AS BIGINT) AS amount, seq % 3 <> 2 AS first FROM fx_raw""",
)
check("alternate_ids", f"SELECT seq, {OWN_ID} AS distinct_id FROM fx_raw")
check("identity_map", f"WITH {MAPPED} SELECT seq, device_id, distinct_id FROM mapped")
check(
    "event_dedup",
    """SELECT DISTINCT event, distinct_id, event_date, nullif(order_count, 'None') AS order_count, insert_id FROM fx_raw""",
)
check("row_dedup", "SELECT DISTINCT event, distinct_id, event_date FROM fx_raw")
check(
    "cleansed_events",
    f"""WITH {MAPPED},
        lab AS (SELECT *, {RELABELLED} AS e2 FROM ({FLAGGED} mapped) q),
        ex AS (SELECT e2, distinct_id, event_date, nullif(order_count, 'None') AS order_count, insert_id,
                      {IDS} AS challenge_id FROM lab),
        rel AS (SELECT CASE WHEN is_c = 1 THEN 'corp_' ELSE '' END || CASE WHEN is_b = 1 THEN 'brand_' ELSE '' END || e2
                       AS event, distinct_id, event_date, order_count, insert_id, challenge_id
                FROM ex LEFT JOIN ({FLAGS}) f ON challenge_id = cid)
        SELECT DISTINCT event, distinct_id, event_date, order_count, challenge_id, insert_id
        FROM rel WHERE distinct_id IS NOT NULL AND event <> 'content_view'""",
)

# --- marts ------------------------------------------------------------------------------------------

GOALS = """SELECT c.challenge_id, custom_fields LIKE '%"instagram"%' AS need_instagram, level2, level3
    FROM fx_challenge c LEFT JOIN fx_goal g ON c.goal_id = g.goal_id
    LEFT JOIN fx_category k ON g.goal_category_id = k.goal_category_id"""
RESULTS = """SELECT DISTINCT u.challenge_id, r.register_count, r.margin
    FROM fx_user_challenge u LEFT JOIN fx_result r ON u.challenge_id = r.challenge_id"""
BASE = f"""SELECT b.*, i.register_count AS info_register_count, i.fee FROM (
      SELECT DISTINCT coalesce(u.challenge_id, g.challenge_id) AS challenge_id, u.register_count, u.margin,
             g.need_instagram, g.level2, g.level3
      FROM (SELECT u.challenge_id, r.register_count, r.margin FROM fx_user_challenge u
            LEFT JOIN fx_result r ON u.challenge_id = r.challenge_id) u
      FULL JOIN ({GOALS}) g ON u.challenge_id = g.challenge_id) b
    LEFT JOIN fx_info i ON b.challenge_id = i.challenge_id"""
PRODUCTS = """SELECT b.product_id, b.challenge_commerce_id, c.challenge_id, p.name, p.price, p.product_fee
    FROM fx_bridge b LEFT JOIN fx_commerce c ON b.challenge_commerce_id = c.challenge_commerce_id
    LEFT JOIN fx_product p ON b.product_id = p.product_id"""


def revenue_rule(source: str) -> str:
    """The rule as nested selects: count and type, then price, then totals."""
    return f"""
      SELECT * EXCLUDE (n, tier_price, share), service_type = 1 AS is_brand, service_type = 3 AS is_corp,
             CAST(tier_price AS DOUBLE) AS revenue_from_brand, share AS revenue_from_challenge, tier_price + share AS revenue
      FROM (
        SELECT *, CASE WHEN service_type <> 1 THEN 0
            WHEN level3 = 'NATION_1' THEN CASE
              WHEN n > 500 THEN 5000000 + CASE WHEN need_instagram THEN 2000000 ELSE 0 END
              WHEN n > 300 THEN 5000000 + CASE WHEN need_instagram THEN 2000000 ELSE 0 END
              WHEN n > 100 THEN 4000000 + CASE WHEN need_instagram THEN 1500000 ELSE 0 END
              WHEN n >= 10 THEN 3000000 + CASE WHEN need_instagram THEN 1000000 ELSE 0 END ELSE 0 END
            WHEN level3 = 'NATION_2' THEN CASE
              WHEN n >= 2000 THEN 8000 + CASE WHEN need_instagram THEN 3200 ELSE 0 END
              WHEN n >= 1000 THEN 10000 + CASE WHEN need_instagram THEN 4000 ELSE 0 END
              WHEN n >= 500 THEN 13000 + CASE WHEN need_instagram THEN 4000 ELSE 0 END
              WHEN n >= 300 THEN 15000 + CASE WHEN need_instagram THEN 4000 ELSE 0 END ELSE 0 END
            WHEN level3 = 'NATION_6' THEN CASE
              WHEN n >= 4000 THEN 4800 + CASE WHEN need_instagram THEN 2400 ELSE 0 END
              WHEN n >= 3000 THEN 6000 + CASE WHEN need_instagram THEN 3000 ELSE 0 END
              WHEN n >= 1000 THEN 8000 + CASE WHEN need_instagram THEN 3000 ELSE 0 END
              WHEN n >= 500 THEN 10000 + CASE WHEN need_instagram THEN 3000 ELSE 0 END ELSE 0 END
            ELSE 0 END AS tier_price,
          CASE WHEN n > 0 THEN coalesce(margin, 0) / n ELSE 0 END + coalesce(CAST(product_fee AS DOUBLE), 0) AS share
        FROM (
          SELECT *, greatest(coalesce(register_count, 0), coalesce(info_register_count, 0)) AS n,
            CASE WHEN level3 = 'NATION_0' OR level2 = 'area4' THEN 3
                 WHEN level2 = 'area3' OR level3 IN ('NATION_1', 'NATION_2', 'NATION_6') THEN 1
                 ELSE 2 END AS service_type
          FROM ({source}) s) t) v"""


check("challenge_goal_join", GOALS)
check("user_challenge_results", RESULTS)
check("challenge_base", BASE)
check("commerce_products", PRODUCTS)
MART = f"""SELECT DISTINCT coalesce(b.challenge_id, p.challenge_id) AS challenge_id, b.* EXCLUDE (challenge_id),
    p.* EXCLUDE (challenge_id) FROM ({BASE}) b FULL JOIN ({PRODUCTS}) p ON b.challenge_id = p.challenge_id"""
check("challenge_mart", revenue_rule(MART))
NO_PRODUCT = revenue_rule(f"SELECT *, CAST(NULL AS VARCHAR) AS product_fee FROM ({BASE}) b")
check(
    "challenge_revenue",
    f"""SELECT challenge_id, service_type, is_brand, is_corp, revenue_from_brand, revenue_from_challenge, revenue
        FROM ({NO_PRODUCT}) r""",
)
STORES = """SELECT DISTINCT order_no, discounted_price, fee_ratio, reward_amount,
      discounted_price * fee_ratio + reward_amount AS revenue
    FROM fx_store_order o JOIN fx_store_item i ON o.pill_order_id = i.pill_order_id
    JOIN fx_store_option p ON i.pill_option_id = p.pill_option_id"""
check("store_mart", STORES)
check(
    "store_revenue",
    "SELECT pill_option_id, discounted_price * fee_ratio + reward_amount AS revenue FROM fx_store_option",
)

# --- enriched events -----------------------------------------------------------------------------------

USERS = """SELECT distinct_id, corp_name, media_source, campaign FROM fx_user
    UNION SELECT distinct_id, corp_name, media_source, campaign FROM fx_user_store"""
USER_COLS = ", ".join(f"{cleaned(f'u.{c}', TESTS)} AS {c}" for c in ("corp_name", "media_source", "campaign"))
check("user_union", USERS)
check(
    "event_attribution",
    f"SELECT event_id, event, e.distinct_id, {USER_COLS} FROM fx_event e LEFT JOIN ({USERS}) u ON e.distinct_id = u.distinct_id",
)
ENRICHED = f"""
  base AS (SELECT e.event, e.distinct_id, e.challenge_id, e.first, e.order_no, nullif(e.order_count, 'None') AS order_count,
                  CAST(floor(epoch(ts)) AS BIGINT) AS time, e.event_date, {USER_COLS}
           FROM fx_event e LEFT JOIN ({USERS}) u ON e.distinct_id = u.distinct_id),
  ch AS (SELECT DISTINCT challenge_id AS cid, service_type, is_brand, is_corp, revenue_from_brand,
                revenue_from_challenge, revenue FROM ({NO_PRODUCT}) r),
  st AS (SELECT DISTINCT order_no AS ono, revenue FROM ({STORES}) s),
  enriched AS (
    SELECT b.* REPLACE ({CORRECTED} AS event), service_type, is_brand, is_corp, revenue_from_brand,
           revenue_from_challenge, revenue
    FROM base b LEFT JOIN ch ON b.challenge_id = cid WHERE event IN ('{CHALLENGE}', '{BRAND}')
    UNION
    SELECT b.* REPLACE (coalesce(order_count = '1.0', false) AS first), NULL, NULL, NULL, NULL, NULL, revenue
    FROM base b LEFT JOIN st ON b.order_no = ono WHERE event = '{STORE}'
    UNION
    SELECT b.*, NULL, NULL, NULL, NULL, NULL, NULL FROM base b WHERE event NOT IN {PAID})"""
check(
    "enriched_events",
    f"WITH {ENRICHED} SELECT * FROM enriched",
)
check("enriched_report", f"WITH {ENRICHED}, {report_ctes('enriched')} SELECT {DECODED} FROM report")
check("other_events", f"SELECT event_id, event FROM fx_event WHERE event NOT IN {PAID}")

# --- funnel ------------------------------------------------------------------------------------------------

STEPS = {
    "install": "install",
    "signup": "signup",
    "view": "af_content_view",
    "purchase": "apply_complete_payment_server",
    "store_purchase": STORE,
}


def funnel_sql(ids: dict[str, str], columns: str = "*") -> str:
    """Steps as semi-joins of event sets, one block per period."""
    parts = []
    for period, start, gate in (
        ("monthly", D29, f"= {D29}"),
        ("weekly", D6, f"<= {D6}"),
        ("daily", D0, f"<= {D0}"),
    ):
        cols = []
        for ident, (suffix, plural) in {"device": ("", "ids"), "user": ("_uid", "uids")}.items():
            f = f"(SELECT {ids[ident]} AS id, event FROM fx_af WHERE event_date BETWEEN {start} AND {D0})"

            def size(cond: str) -> str:
                return f"(SELECT count(DISTINCT id) FROM {f} q WHERE {cond})"

            def both(a: str, b: str) -> str:
                return size(
                    f"event = '{STEPS[b]}' AND id IN (SELECT id FROM {f} z WHERE event = '{STEPS[a]}' AND id IS NOT NULL)"
                )

            values = {
                f"total_visit{suffix}": size("true"),
                f"total_install{suffix}": size("event = 'install'"),
                f"total_install_signup{suffix}": both("install", "signup"),
                f"total_signup_view{suffix}": both("signup", "view"),
                f"total_view_purchase{suffix}": both("view", "purchase"),
                f"total_view_store_purchase{suffix}": both("view", "store_purchase"),
                f"install_{plural}_len": size("event = 'install'"),
                f"signup_{plural}_len": size("event = 'signup'"),
                f"view_{plural}_len": size("event = 'af_content_view'"),
            }
            cols += [f"{v} AS {k}" for k, v in values.items()]
        parts.append(
            f"""SELECT '{period}' AS period, {', '.join(cols)}
                WHERE (SELECT min(event_date) FROM fx_af WHERE event_date BETWEEN {D29} AND {D0}) {gate}"""
        )
    ratios = []
    for suffix, plural in (("", "ids"), ("_uid", "uids")):
        for name, step in (
            ("install_signup", "install"),
            ("signup_view", "signup"),
            ("view_purchase", "view"),
            ("view_store_purchase", "view"),
        ):
            whole = f"{step}_{plural}_len"
            ratios.append(
                f"CASE WHEN {whole} > 0 THEN CAST(total_{name}{suffix} AS DOUBLE) / {whole} * 100 ELSE 0 END AS {name}{suffix}"
            )
    return f"""SELECT {columns} FROM (
        SELECT f.*, {', '.join(ratios)}, {D0} AS date FROM ({' UNION ALL '.join(parts)}) f) g"""


PLAIN = {"device": "appsflyer_id", "user": "user_id"}
check("funnel_all_periods", funnel_sql(PLAIN))
check("funnel_of_days", funnel_sql(PLAIN))
check("funnel_null_as_value", funnel_sql({k: f"coalesce({v}, 'None')" for k, v in PLAIN.items()}))
check("funnel_device", funnel_sql(PLAIN, "COLUMNS(lambda c: c NOT LIKE '%uid%')"))
check("funnel_user", funnel_sql(PLAIN, "date, period, COLUMNS(lambda c: c LIKE '%uid%')"))
check(
    "step_membership",
    """SELECT DISTINCT appsflyer_id FROM fx_af WHERE event = 'apply_complete_payment_server'
       AND appsflyer_id IN (SELECT appsflyer_id FROM fx_af WHERE event = 'af_content_view')""",
)

# --- lifetime value ---------------------------------------------------------------------------------------

IS_B, IS_C, IS_S = f"event = '{BRAND}'", f"event = '{CHALLENGE}'", f"event = '{STORE}'"
CHALLENGE_ROWS = f"""SELECT distinct_id, CASE WHEN {IS_B} THEN 1.0 ELSE 0.0 END::DOUBLE AS brand_challenge_value,
      coalesce(revenue_from_brand, 0) AS _brand_challenge_value, coalesce(revenue_from_challenge, 0) AS challenge_value,
      CASE WHEN {IS_C} THEN 1.0 ELSE 0.0 END::DOUBLE AS _challenge_value,
      CAST({IS_B} AS BIGINT) AS brand_challenge_count, CAST({IS_C} AS BIGINT) AS challenge_count
    FROM fx_day WHERE {IS_B} OR {IS_C}"""
STORE_ROWS = f"SELECT distinct_id, coalesce(revenue, 0) AS store_value FROM fx_day WHERE {IS_S}"
check("ltv_challenge_rows", CHALLENGE_ROWS)
check("ltv_store_rows", STORE_ROWS)
OWNERS = "SELECT device_id, min(distinct_id) AS owner FROM fx_user_info WHERE device_id LIKE '%-%' GROUP BY device_id"
check(
    "ltv_device_merge",
    f"""SELECT coalesce(owner, distinct_id) AS distinct_id, CASE WHEN {IS_S} THEN coalesce(revenue, 0) ELSE 0 END AS store_value
        FROM fx_day d LEFT JOIN ({OWNERS}) o ON d.distinct_id = o.device_id WHERE event IN {PAID}""",
)
CENTS = "DECIMAL(24,6)"
LTV = f"""
  SELECT coalesce(owner, r.distinct_id) AS distinct_id,
         CAST(coalesce(sum(brand_challenge_count), 0) AS BIGINT) AS brand_challenge_count,
         CAST(coalesce(sum(challenge_count), 0) AS BIGINT) AS challenge_count,
         CAST(coalesce(sum(CAST(brand_challenge_value AS {CENTS})), 0) AS DOUBLE) AS brand_challenge_value,
         CAST(coalesce(sum(CAST(_brand_challenge_value AS {CENTS})), 0) AS DOUBLE) AS _brand_challenge_value,
         CAST(coalesce(sum(CAST(challenge_value AS {CENTS})), 0) AS DOUBLE) AS challenge_value,
         CAST(coalesce(sum(CAST(_challenge_value AS {CENTS})), 0) AS DOUBLE) AS _challenge_value,
         CAST(coalesce(sum(CAST(store_value AS {CENTS})), 0) AS DOUBLE) AS store_value
  FROM (SELECT *, NULL AS store_value FROM ({CHALLENGE_ROWS}) c
        UNION ALL
        SELECT distinct_id, NULL, NULL, NULL, NULL, NULL, NULL, store_value FROM ({STORE_ROWS}) s) r
  LEFT JOIN ({OWNERS}) o ON r.distinct_id = o.device_id GROUP BY 1"""
check("ltv_accumulate", f"SELECT l.*, {D0} AS date FROM ({LTV}) l")
check("ltv_daily_chain", f"SELECT l.*, {D0} AS date FROM ({LTV}) l")
check("ltv_bucketed_state", f"SELECT l.*, {D0} AS date FROM ({LTV}) l")
check("ltv_stream", LTV)

# --- first rows and cut-offs ---------------------------------------------------------------------------------

check(
    "first_row_per_group",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) q
       WHERE rn = 1""",
)
check(
    "first_match_per_key",
    """SELECT o_orderstatus, o_orderpriority, o_custkey FROM (
         SELECT *, row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority ORDER BY o_orderkey) AS rn
         FROM orders) q WHERE rn = 1""",
)
check(
    "sheet_cutoff",
    """SELECT * FROM fx_sheet WHERE row_no <
         (SELECT min(row_no) FROM fx_sheet WHERE channel = 'Pincrux' AND cost_text = 'None')""",
)
check("earliest_date", "SELECT min(event_date) AS event_date FROM fx_af")
check("lookup_first", "SELECT * FROM fx_sheet WHERE date = '2024-01-05' ORDER BY row_no LIMIT 1")

# --- scalar functions -------------------------------------------------------------------------------------------

check(
    "num_clean",
    f"""SELECT spend_text, clicks_text, {SPEND} AS spend, {CLICKED} AS clicks,
               CASE WHEN clicks_text = '#DIV/0!' THEN 0 ELSE coalesce({CLICKED}, 0) END AS sheet_clicks FROM fx_ad_text""",
)
check(
    "text_to_numbers",
    """SELECT seq, CAST(trunc(TRY_CAST(amount AS DOUBLE)) AS BIGINT) AS as_long, TRY_CAST(amount AS DOUBLE) AS as_double,
              TRY_CAST(amount AS DOUBLE) IS NOT NULL AS float_like FROM fx_raw""",
)
check("bool_text", "SELECT event_id, event_id % 3 <> 0 AND first AS flag, first AS same FROM fx_event")
check(
    "url_decode_keys",
    """SELECT distinct_id AS id, url_decode(campaign) AS decoded FROM fx_user
       UNION ALL
       SELECT CAST(page_id AS VARCHAR),
              url_decode(replace(regexp_replace(
                replace(html, '%', chr(1)),
                chr(1) || '([0-9A-Fa-f]{2})', '%\\1', 'g'), chr(1), '%25')) FROM pages""",
)
check(
    "id_kinds",
    """SELECT seq, coalesce(contains(dirty, '-'), false) AS uuid_like,
              coalesce(NOT contains(dirty, '-'), false) AS custom FROM fx_raw""",
)


def os_sql(column: str) -> str:
    def has(*words: str) -> str:
        return "(" + " OR ".join(f"contains(lower({column}), '{w}')" for w in words) + ")"

    return f"""CASE WHEN {has('android', 'samsung')} THEN 'aos'
        WHEN {has('ios', 'ipad', 'mac', 'iphone', 'apple')} THEN 'ios'
        WHEN {has('browser')} AND NOT {has('mobile')} THEN 'web' END"""


check("os_class_of_texts", f"SELECT page_id, coalesce({os_sql('url')}, {os_sql('html')}) AS os FROM pages")
check("os_class_of_documents", f"SELECT doc_id, coalesce({os_sql('source')}, {os_sql('text')}) AS os FROM documents")
check("json_explode_ids", f"SELECT seq, {IDS} AS challenge_id FROM fx_raw")
check(
    "json_instagram",
    """SELECT challenge_id, custom_fields LIKE '%"instagram"%' AS need_instagram FROM fx_challenge""",
)
check(
    "json_decoded",
    """SELECT event_id, event_id % 4 <> 0 AS parsed,
              CASE WHEN event_id % 4 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events""",
)
check(
    "expand_properties",
    "SELECT event_id, CAST(1 AS INT) AS n, json_extract_string(props, '$.k') AS k FROM events",
)
check(
    "id_list",
    """SELECT seq, CASE WHEN challenge_ids LIKE '[%'
                        THEN replace(substr(challenge_ids, 2, length(challenge_ids) - 2), ' ', '')
                        WHEN challenge_ids ~ '^[0-9]+$' THEN challenge_ids ELSE '' END AS ids FROM fx_raw""",
)
check(
    "date_functions",
    f"""SELECT time, event_date AS day, CAST({D0} - event_date AS INT) AS age, {D6} AS week_start FROM fx_af""",
)
check(
    "ratio_guard",
    """SELECT *, CASE WHEN whole > 0 THEN CAST(part AS DOUBLE) / whole * 100 ELSE 0 END AS ratio FROM (
         SELECT l_suppkey, l_linenumber, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS part,
                count(CASE WHEN l_discount = 0 THEN 1 END) AS whole FROM lineitem GROUP BY 1, 2) q""",
)

# --- scans and sinks ------------------------------------------------------------------------------------------------

check("parquet_scan", "SELECT l_orderkey, l_quantity FROM lineitem")
check("json_scan", "SELECT distinct_id, event, revenue FROM fx_day")
check(
    "csv_text_scan",
    """SELECT day, channel, coalesce(campaign, '0') AS campaign, coalesce(adset, '0') AS adset, spend_text FROM fx_ad_text""",
)
check(
    "regex_scan",
    """SELECT DISTINCT c_name, c_nationkey, NULL AS s_name FROM customer
       UNION ALL SELECT DISTINCT NULL, NULL, s_name FROM supplier""",
)
check(
    "period_csv_scan",
    """SELECT campaign, spend_text, day AS file_date FROM fx_ad_text WHERE day BETWEEN '2024-01-03' AND '2024-01-12'""",
)
check(
    "period_file_scan",
    """SELECT event_id, CAST(event_date AS VARCHAR) AS file_date FROM fx_event
       WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""",
)
check("period_scan", f"SELECT event_id, event, event_date AS date FROM fx_event WHERE event_date >= {D6}")
check(
    "latest_snapshot",
    """SELECT event_id, event, event_date AS date FROM fx_event
       WHERE event_date = (SELECT max(event_date) FROM fx_event)""",
)
check(
    "typed_save",
    """SELECT seq, coalesce(TRY_CAST(amount AS DOUBLE), 0) AS amount, false AS flag, event_date AS date FROM fx_raw""",
)
check(
    "period_report_scan",
    f"""{REPORT} SELECT url_decode(media_source) AS media_source, url_decode(campaign) AS campaign, mau, unique_installs, level
        FROM report WHERE period = 'weekly'""",
)
check(
    "attribution_files",
    """SELECT event, time, appsflyer_id, user_id, kind AS appsflyer_type, event_date FROM fx_af WHERE kind <> 'reinstall'""",
)
check("event_flatten", "SELECT distinct_id, revenue, event FROM fx_day")
check(
    "user_export",
    """SELECT corp_name, media_source, campaign, distinct_id FROM fx_user
       WHERE media_source IS NOT NULL OR (corp_name IS NOT NULL AND corp_name NOT IN ('', ' '))""",
)
check(
    "open_export",
    """SELECT distinct_id, media_source, CAST((campaign IS NOT NULL) AS INTEGER) + CAST((corp_name IS NOT NULL) AS INTEGER) AS n_others,
              campaign, corp_name FROM fx_user""",
)

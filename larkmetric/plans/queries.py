"""Every registered query: operators applied to the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ATTRIBUTION_KINDS, ATTRIBUTION_SKIPPED, NAVER, PERIODS, TEST_VALUES, ServiceRules
from ..functions import (
    any_named,
    clean_number,
    clean_sheet_number,
    day_difference,
    days_before,
    id_list_text,
    id_values,
    is_custom_id,
    is_float,
    is_true,
    is_uuid_like,
    json_decode,
    json_value_map,
    keep_keys,
    os_class,
    percent,
    text_to_date,
    text_to_double,
    text_to_long,
    unquote,
)
from ..operators import adchannels, clean, dedup, enrich, firstrow, funnel, identity, ltv, marts, metrics, rollup
from ..session import scratch_dir
from ..sources import scans, sinks
from ..streaming.ltv_stream import read_ltv, run_ltv_stream
from .fixtures import AS_OF, fixture, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RULES = ServiceRules(
    corp_level3="NATION_0",
    corp_level2="area4",
    brand_level2="area3",
    flat_level3="NATION_1",
    mid_level3="NATION_2",
    high_level3="NATION_6",
)


def register(name: str, fn: Query) -> None:
    QUERIES[name] = fn


def query(fn: Query) -> Query:
    register(fn.__name__, fn)
    return fn


# --- campaign metrics ------------------------------------------------------------


def _attributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_attributed")


def _count_query(key: str, metric: metrics.CountMetric) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return metrics.event_counts(_attributed(spark, sf_dir), metric)

    register(f"{key}_by_campaign", run)


for _key, _metric in {**metrics.count_metrics(), **metrics.store_count_metrics()}.items():
    _count_query(_key, _metric)


def _revenue_query(name: str, event: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return metrics.revenue_of(_attributed(spark, sf_dir), [event], name)

    register(f"{name}_by_campaign", run)


for _name, _event in metrics.revenue_metrics().items():
    _revenue_query(_name, _event)


@query
def revenue_by_campaign(spark, sf_dir):
    kinds = list(metrics.revenue_metrics().values())
    return metrics.revenue_of(_attributed(spark, sf_dir), kinds, "revenue", keyed_only=True)


@query
def mau_by_source(spark, sf_dir):
    return metrics.active_users(_attributed(spark, sf_dir), ["media_source"])


@query
def dau_by_source(spark, sf_dir):
    return metrics.daily_users(_attributed(spark, sf_dir), ["media_source"])


@query
def mau_by_campaign(spark, sf_dir):
    return metrics.active_users(_attributed(spark, sf_dir))


@query
def dau_by_campaign(spark, sf_dir):
    return metrics.daily_users(_attributed(spark, sf_dir))


@query
def campaign_report_all(spark, sf_dir):
    """All periods and levels; events are summed per user before attribution."""
    return metrics.campaign_report(
        fixture(spark, sf_dir, "fx_event"), AS_OF, users=fixture(spark, sf_dir, "fx_user")
    )


def _kept(spark: SparkSession, sf_dir: str, name: str, rows: DataFrame) -> DataFrame:
    """Rows kept by day, and read again."""
    path = scratch_dir(spark, name, sf_dir)
    sinks.save_snapshot(rows.withColumn("date", F.col("event_date")), path)
    return scans.read_period(spark, path, days_before(AS_OF, max(PERIODS.values()) - 1), AS_OF).drop("date")


@query
def campaign_report_of_days(spark, sf_dir):
    """The same report from sums per user that were kept day by day."""
    days = _kept(spark, sf_dir, "activity", metrics.day_activity(fixture(spark, sf_dir, "fx_event"), []))
    return metrics.campaign_report_of_days(days, AS_OF, users=fixture(spark, sf_dir, "fx_user"))


@query
def campaign_report_enriched(spark, sf_dir):
    """The same from events that already carry their attribution."""
    return metrics.campaign_report(_attributed(spark, sf_dir), AS_OF)


@query
def campaign_report_monthly(spark, sf_dir):
    report = campaign_report_all(spark, sf_dir)
    return report.where((F.col("period") == "monthly") & (F.col("level") == "media_source")).drop(
        "period", "level", "campaign"
    )


@query
def report_with_spend(spark, sf_dir):
    ads = rollup.ad_rollup_periods(_ads(spark, sf_dir), AS_OF)
    return metrics.campaign_report(
        fixture(spark, sf_dir, "fx_event"), AS_OF, fixture(spark, sf_dir, "fx_user"), ad_report=ads
    )


# --- ads -------------------------------------------------------------------------


def _ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_ad").drop("spend_text")


def _ad_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_ad_text")


@query
def ad_rollup(spark, sf_dir):
    return rollup.ad_rollup(_ads(spark, sf_dir))


@query
def ad_rollup_periods(spark, sf_dir):
    return rollup.ad_rollup_periods(_ads(spark, sf_dir), AS_OF)


@query
def ad_rollup_ratios(spark, sf_dir):
    return rollup.ad_rollup(_ads(spark, sf_dir), ratios=True).select(
        "key", "value", "channel", "campaign", "adset", "ctr_of_sums", "cpm_of_sums", "cpc_of_sums"
    )


def _facebook_export(rows):
    return rows.select(
        F.col("day").alias("Date"),
        F.col("campaign").alias("campaign_name"),
        F.col("adset").alias("adset_name"),
        F.col("ad").alias("ad_name"),
        F.col("spend_text").alias("spend"),
        F.col("impressions_text").alias("impressions"),
        F.col("clicks_text").alias("clicks"),
        F.col("impressions_text").alias("reach"),
        F.col("cost_text").alias("cpm"),
        F.col("clicks_text").alias("ctr"),
        F.col("spend_text").alias("cpp"),
    )


def _google_export(rows):
    return rows.select(
        F.col("day").alias("Date"),
        F.col("clicks_text").alias("status"),
        "campaign",
        F.col("adset").alias("ad_set"),
        "ad",
        F.col("impressions_text").alias("impressions"),
        F.col("clicks_text").alias("clicks"),
        F.col("cost_text").alias("cost"),
        F.col("channel").alias("ad_set_id"),
        F.col("spend_text").alias("cpm"),
        F.col("cost_text").alias("cpc"),
        F.col("clicks_text").alias("ctr"),
        F.col("impressions_text").alias("conversions"),
    )


def _naver_export(rows):
    """All columns of the layout; those it drops hold anything."""
    named = ["campaign_status", "campaign_id", "adgroup_status", "status"]
    return rows.select(
        F.col("day").alias("Date"),
        F.col("campaign").alias("campaign_name"),
        F.col("channel").alias("campaign_status"),
        F.col("channel").alias("campaign_id"),
        F.col("adset").alias("adgroup_name"),
        F.col("ad").alias("adgroup_id"),
        F.col("channel").alias("adgroup_status"),
        F.col("clicks_text").alias("adgroup_clkCnt"),
        F.col("impressions_text").alias("adgroup_impCnt"),
        F.col("cost_text").alias("adgroup_salesAmt"),
        F.col("ad").alias("ad_name"),
        F.col("channel").alias("adgroup_nccCampaignId"),
        F.col("clicks_text").alias("adgroup_ctr"),
        F.col("spend_text").alias("adgroup_ror"),
        F.col("impressions_text").alias("adgroup_viewCnt"),
        F.col("cost_text").alias("adgroup_cpc"),
        F.col("clicks_text").alias("adgroup_ccnt"),
        *[F.col("channel").alias(c) for c in NAVER.drops if c not in named],
    )


def _adison_export(rows):
    return rows.select(
        F.col("day").alias("Date"),
        F.col("channel").alias("채널"),
        F.col("ad").alias("플랫폼"),
        F.col("campaign").alias("캠페인"),
        F.col("impressions_text").alias("오퍼월 리스트 노출"),
        F.col("clicks_text").alias("클릭"),
        F.col("clicks_text").alias("참여"),
        F.col("impressions_text").alias("완료"),
        F.col("spend_text").alias("광고비"),
        F.col("spend_text").alias("광고단가"),
        F.col("day").alias("Unnamed: 0"),
        F.col("clicks_text").alias("유니크 참여"),
        F.col("spend_text").alias("CTR"),
        F.col("cost_text").alias("CVR"),
        F.col("day").alias("리포팅 기간"),
    )


def _pincrux_export(rows):
    return rows.select("day", "day", "clicks_text", "impressions_text", "channel", "campaign").toDF(
        "Date", "date", "clicks", "complete", "channel", "campaign"
    )


def _sheet(spark, sf_dir):
    return fixture(spark, sf_dir, "fx_sheet").withColumnRenamed("cost_text", "Cost")


@query
def channel_facebook(spark, sf_dir):
    return adchannels.facebook(_facebook_export(_ad_text(spark, sf_dir)))


@query
def channel_google(spark, sf_dir):
    return adchannels.google(_google_export(_ad_text(spark, sf_dir)))


@query
def channel_naver(spark, sf_dir):
    return adchannels.naver(_naver_export(_ad_text(spark, sf_dir)))


@query
def channel_adison(spark, sf_dir):
    return adchannels.adison(_adison_export(_ad_text(spark, sf_dir)))


@query
def channel_pincrux(spark, sf_dir):
    return adchannels.pincrux(_pincrux_export(_ad_text(spark, sf_dir)), _sheet(spark, sf_dir), ["row_no"])


@query
def spend_lookup(spark, sf_dir):
    return adchannels.sheet_spend(_sheet(spark, sf_dir), ["row_no"]).withColumnRenamed("Cost", "cost_text")


@query
def per_date_sum(spark, sf_dir):
    return adchannels.sum_per_date(_ads(spark, sf_dir), ["clicks", "impressions"])


@query
def channel_unify(spark, sf_dir):
    """The channels' exports are of the same rows, which are worked out once and landed as files."""
    made, path = _ad_text(spark, sf_dir), scratch_dir(spark, "ads", sf_dir)
    made.write.mode("overwrite").parquet(path)
    rows = spark.read.schema(made.schema).parquet(path)
    exports = {
        "facebook": _facebook_export(rows),
        "naver": _naver_export(rows),
        "google": _google_export(rows),
        "adison": _adison_export(rows),
        "pincrux": _pincrux_export(rows),
    }
    return adchannels.unify(exports, _sheet(spark, sf_dir), ["row_no"])


@query
def derived_ad_cost(spark, sf_dir):
    raw = fixture(spark, sf_dir, "fx_ad").select(
        "date",
        "ad",
        (F.col("spend").cast("double") * 1000).alias("average_cost"),
        F.col("clicks").cast("bigint").alias("interactions"),
        F.col("spend").cast("double").alias("average_cpm"),
        F.col("impressions").cast("double").alias("average_cpc"),
    )
    return adchannels.micro_costs(raw)


@query
def unpivot_costs(spark, sf_dir):
    wide = fixture(spark, sf_dir, "fx_wide").toDF(
        "date", "광고비-Pincrux", "광고비-Naver", "Clicks-Naver", "note"
    )
    return adchannels.unpivot_sheet(wide, since="1996-07-01").withColumnsRenamed(
        {"Cost": "cost_value", "Clicks": "clicks_value"}
    )


@query
def unpivot_channel_first(spark, sf_dir):
    wide = fixture(spark, sf_dir, "fx_wide").toDF(
        "date", "Pincrux-cost", "Naver-cost", "Naver-clicks", "note"
    )
    return adchannels.unpivot_sheet(wide, metric_first=False, until="2000-01-01").withColumnsRenamed(
        {"cost": "cost_value", "clicks": "clicks_value", "note": "note_value"}
    )


@query
def naver_stats_join(spark, sf_dir):
    def entity(name: str, **renames: str) -> DataFrame:
        return fixture(spark, sf_dir, name).withColumnsRenamed(renames)

    joined = adchannels.join_search_ads(
        entity("fx_search_campaign", ncc_campaign_id="nccCampaignId"),
        entity("fx_search_campaign_stat", clk="clkCnt", sales="salesAmt"),
        entity("fx_search_group", ncc_adgroup_id="nccAdgroupId", ncc_campaign_id="nccCampaignId"),
        entity("fx_search_group_stat", clk="clkCnt", sales="salesAmt"),
    )
    return joined


# --- event cleansing -----------------------------------------------------------------


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_raw")


@query
def sentinel_null(spark, sf_dir):
    rows = clean.null_sentinels(_raw(spark, sf_dir))
    return clean.select_existing(rows, ["seq", "alt_id", "dirty", "amount", "absent"])


@query
def test_data_null(spark, sf_dir):
    return clean.null_sentinels(_raw(spark, sf_dir).select("seq", "alt_id", "dirty"), TEST_VALUES)


@query
def column_merge(spark, sf_dir):
    rows = clean.merge_columns(_raw(spark, sf_dir), [("title_new", "title")])
    return clean.join_with_slash(rows, "title", "kind_flag").select("seq", "title")


@query
def event_relabel(spark, sf_dir):
    rows = clean.prefix_flagged(_raw(spark, sf_dir), "kind_flag", "brand")
    rows = clean.mark_zero_amount(rows, "challenge_complete_checkout", "amount")
    return rows.select("seq", "event")


@query
def membership_relabel(spark, sf_dir):
    rows = _raw(spark, sf_dir).select(
        "seq", "event", F.explode_outer(id_values(F.col("challenge_ids"))).alias("challenge_id")
    )
    return clean.prefix_by_membership(rows, fixture(spark, sf_dir, "fx_id_type"))


@query
def service_type_correction(spark, sf_dir):
    rows = fixture(spark, sf_dir, "fx_event").select("event_id", "event", "challenge_id")
    typed = rows.join(fixture(spark, sf_dir, "fx_id_type"), "challenge_id", "left")
    kind = F.col("service_type").cast("int")
    return typed.select("event_id", clean.corrected_event(F.col("event"), kind).alias("event"))


@query
def row_filter(spark, sf_dir):
    rows = clean.null_sentinels(_raw(spark, sf_dir))
    return clean.keep_known(rows, "dirty", ["invite"]).select("seq", "event", "dirty")


@query
def first_flag(spark, sf_dir):
    rows = clean.ensure_column(fixture(spark, sf_dir, "fx_event").drop("order_no"), "order_no")
    number = rows.select("*", F.col("order_count").try_cast("double").alias("order_number"))
    return number.select(
        "event_id",
        "order_no",
        clean.first_order(number).alias("first_by_text"),
        clean.first_order(number, "order_number").alias("first_by_number"),
    )


@query
def local_event_date(spark, sf_dir):
    epoch = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)")
    rows = table(spark, sf_dir, "events").select("event_id", epoch.alias("time"))
    return clean.with_event_date(rows)


@query
def period_labels(spark, sf_dir):
    rows = fixture(spark, sf_dir, "fx_event").select("event_id", "event_date")
    return clean.with_periods(rows, AS_OF)


@query
def id_and_flag_casts(spark, sf_dir):
    rows = _raw(spark, sf_dir).select(
        "seq",
        F.col("amount").alias("goal_id"),
        F.col("amount"),
        F.when(F.col("seq") % 3 == 0, F.lit("true")).when(F.col("seq") % 3 == 1, F.lit("True")).alias("first"),
    )
    return clean.cast_ids_and_flags(rows, ["goal_id", "amount"], ["first"])


@query
def alternate_ids(spark, sf_dir):
    rows = clean.null_sentinels(_raw(spark, sf_dir))
    return identity.use_alternate_id(rows, "distinct_id", ["alt_id"]).select("seq", "distinct_id")


@query
def identity_map(spark, sf_dir):
    rows = clean.null_sentinels(_raw(spark, sf_dir))
    rows = identity.use_alternate_id(rows, "distinct_id", ["alt_id"])
    return identity.map_ids(rows, "device_id", "distinct_id", ["seq"]).select("seq", "device_id", "distinct_id")


@query
def event_dedup(spark, sf_dir):
    rows = clean.null_sentinels(_raw(spark, sf_dir)).select(
        "event", "distinct_id", "event_date", "order_count", "insert_id"
    )
    return dedup.dedup_events(rows)


@query
def row_dedup(spark, sf_dir):
    return dedup.dedup_rows(_raw(spark, sf_dir).select("event", "distinct_id", "event_date"))


@query
def cleansed_events(spark, sf_dir):
    """The whole event flow: ids, merges, relabels, casts, de-duplication."""
    rows = clean.null_sentinels(_raw(spark, sf_dir))
    rows = identity.use_alternate_id(rows, "distinct_id", ["alt_id"])
    rows = identity.map_ids(rows, "device_id", "distinct_id", ["seq"])
    rows = clean.merge_columns(rows, [("title_new", "title")])
    rows = clean.prefix_flagged(rows, "kind_flag", "brand")
    rows = clean.mark_zero_amount(rows, "challenge_complete_checkout", "amount")
    rows = rows.select(
        "event",
        "distinct_id",
        "event_date",
        "order_count",
        "insert_id",
        F.explode_outer(id_values(F.col("challenge_ids"))).alias("challenge_id"),
    )
    rows = clean.prefix_by_membership(rows, fixture(spark, sf_dir, "fx_id_type"))
    rows = clean.keep_known(rows, "distinct_id", ["content_view"])
    return dedup.dedup_events(rows)


# --- marts --------------------------------------------------------------------------------


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["fx_challenge", "fx_goal", "fx_category", "fx_user_challenge", "fx_result", "fx_info"]
    return marts.challenge_base(*[fixture(spark, sf_dir, n) for n in names])


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.commerce_products(*[fixture(spark, sf_dir, n) for n in ("fx_bridge", "fx_commerce", "fx_product")])


@query
def challenge_goal_join(spark, sf_dir):
    return marts.challenge_goals(*[fixture(spark, sf_dir, n) for n in ("fx_challenge", "fx_goal", "fx_category")])


@query
def user_challenge_results(spark, sf_dir):
    return marts.challenge_results(fixture(spark, sf_dir, "fx_user_challenge"), fixture(spark, sf_dir, "fx_result"))


@query
def challenge_base(spark, sf_dir):
    return _base(spark, sf_dir)


@query
def commerce_products(spark, sf_dir):
    return _products(spark, sf_dir)


@query
def challenge_mart(spark, sf_dir):
    return marts.challenge_mart(_base(spark, sf_dir), _products(spark, sf_dir), RULES)


@query
def challenge_revenue(spark, sf_dir):
    """Revenue per challenge without products."""
    base = _base(spark, sf_dir).withColumn("product_fee", F.lit(None).cast("string"))
    return marts.with_challenge_revenue(base, RULES).select(
        "challenge_id", "service_type", "is_brand", "is_corp",
        "revenue_from_brand", "revenue_from_challenge", "revenue",
    )


def _stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.store_mart(*[fixture(spark, sf_dir, n) for n in ("fx_store_order", "fx_store_item", "fx_store_option")])


@query
def store_mart(spark, sf_dir):
    return _stores(spark, sf_dir)


@query
def store_revenue(spark, sf_dir):
    options = fixture(spark, sf_dir, "fx_store_option")
    return options.select("pill_option_id", marts.store_revenue().alias("revenue"))


# --- enriched events ----------------------------------------------------------------------


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.all_users(fixture(spark, sf_dir, "fx_user"), fixture(spark, sf_dir, "fx_user_store"))


@query
def user_union(spark, sf_dir):
    return _users(spark, sf_dir)


@query
def event_attribution(spark, sf_dir):
    events = fixture(spark, sf_dir, "fx_event").select("event_id", "event", "distinct_id")
    return enrich.attribute(events, _users(spark, sf_dir))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    epoch = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)")
    events = fixture(spark, sf_dir, "fx_event").select(
        "event", "distinct_id", "challenge_id", "first", "order_no", "order_count", epoch.alias("time")
    )
    challenges = marts.with_challenge_revenue(
        _base(spark, sf_dir).withColumn("product_fee", F.lit(None).cast("string")), RULES
    )
    stores = _stores(spark, sf_dir).select("order_no", "revenue")
    return enrich.enrich(events, _users(spark, sf_dir), challenges, stores)


@query
def enriched_events(spark, sf_dir):
    return _enriched(spark, sf_dir)


@query
def enriched_report(spark, sf_dir):
    """The campaign report over the enriched events."""
    return metrics.campaign_report(_enriched(spark, sf_dir), AS_OF)


@query
def other_events(spark, sf_dir):
    handled = ["challenge_complete_checkout", "brand_challenge_complete_checkout", "store_complete_checkout"]
    return enrich.other_events(fixture(spark, sf_dir, "fx_event"), handled).select("event_id", "event")


# --- funnel ------------------------------------------------------------------------------------


def _funnel(spark: SparkSession, sf_dir: str, **kwargs) -> DataFrame:
    return funnel.funnel(fixture(spark, sf_dir, "fx_af"), AS_OF, **kwargs)


@query
def funnel_all_periods(spark, sf_dir):
    return _funnel(spark, sf_dir)


@query
def funnel_of_days(spark, sf_dir):
    """The same funnel from the steps per id that were kept day by day."""
    return funnel.funnel_of_days(_kept(spark, sf_dir, "funnel-steps", funnel.day_steps(fixture(spark, sf_dir, "fx_af"))), AS_OF)


@query
def funnel_null_as_value(spark, sf_dir):
    return _funnel(spark, sf_dir, null_as_value=True)


@query
def funnel_device(spark, sf_dir):
    rows = _funnel(spark, sf_dir)
    return rows.select(*[c for c in rows.columns if "uid" not in c])


@query
def funnel_user(spark, sf_dir):
    rows = _funnel(spark, sf_dir)
    return rows.select("date", "period", *[c for c in rows.columns if "uid" in c])


@query
def step_membership(spark, sf_dir):
    return funnel.step_members(
        fixture(spark, sf_dir, "fx_af"), "appsflyer_id", "af_content_view", "apply_complete_payment_server"
    )


# --- lifetime value --------------------------------------------------------------------------------


def _day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_day")


def _user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_user_info")


@query
def ltv_challenge_rows(spark, sf_dir):
    return ltv.challenge_rows(_day(spark, sf_dir))


@query
def ltv_store_rows(spark, sf_dir):
    return ltv.store_rows(_day(spark, sf_dir))


@query
def ltv_device_merge(spark, sf_dir):
    rows = ltv.contributions(_day(spark, sf_dir)).select("distinct_id", "store_value")
    return identity.devices_to_users(rows, _user_info(spark, sf_dir))


@query
def ltv_accumulate(spark, sf_dir):
    """The state before the day, then the day."""
    day, info = _day(spark, sf_dir), _user_info(spark, sf_dir)
    before = day.where(F.col("event_date") < AS_OF)
    state = ltv.accumulate(ltv.empty_state(spark), before, info, days_before(AS_OF, 1))
    return ltv.accumulate(state, day.where(F.col("event_date") == AS_OF), info, AS_OF)


@query
def ltv_daily_chain(spark, sf_dir):
    """Yesterday's state, which must be there, and today's checkouts, as the daily job does."""
    day, info = _day(spark, sf_dir), _user_info(spark, sf_dir)
    eve = days_before(AS_OF, 1)
    first = ltv.accumulate(ltv.empty_state(spark), day.where(F.col("event_date") <= eve), info, eve)
    state = scans.require_snapshot(first, eve)
    return ltv.accumulate(state, day.where(F.col("event_date") == AS_OF), info, AS_OF)


@query
def ltv_bucketed_state(spark, sf_dir):
    """The same days over a state that is kept in buckets by user."""
    path = scratch_dir(spark, "ltv-state", sf_dir)
    day, info = _day(spark, sf_dir), _user_info(spark, sf_dir)
    eve = days_before(AS_OF, 1)
    first = ltv.advance(ltv.keyed_state(ltv.empty_state(spark)), day.where(F.col("event_date") <= eve), info, eve)
    sinks.save_bucketed_day(first, path, eve, ltv.STATE_KEY, 8)
    state = scans.read_state(spark, path, eve)
    return ltv.advance(state, day.where(F.col("event_date") == AS_OF), info, AS_OF).drop(ltv.STATE_KEY)


@query
def ltv_stream(spark, sf_dir):
    """Checkout files arriving in two lots, taken in by a stream."""
    base = f"{scratch_dir(spark, 'ltv-stream', sf_dir)}/{uuid.uuid4().hex}"  # a stream's progress is its own
    arriving, out = f"{base}/in", f"{base}/out"
    day = _day(spark, sf_dir)
    schema = day.schema
    for lot in (day.where(F.col("event_date") < "2024-01-15"), day.where(F.col("event_date") >= "2024-01-15")):
        lot.write.mode("append").parquet(arriving)
        source = spark.readStream.schema(schema).parquet(arriving)
        run_ltv_stream(source, out, f"{base}/checkpoint")
    return read_ltv(spark, out, _user_info(spark, sf_dir))


# --- first rows and cut-offs -----------------------------------------------------------------------


@query
def first_row_per_group(spark, sf_dir):
    """The dearest order of each customer; the smaller key on a tie."""
    orders = table(spark, sf_dir, "orders").withColumn("negative_key", -F.col("o_orderkey"))
    return firstrow.first_per_key(
        orders, ["o_custkey"], ["o_totalprice", "negative_key"], ["o_orderkey", "o_totalprice"], last=True
    )


@query
def first_match_per_key(spark, sf_dir):
    return firstrow.first_per_key(
        table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"], ["o_orderkey"], ["o_custkey"]
    )


@query
def sheet_cutoff(spark, sf_dir):
    """Rows before the first urgent order that has no cost."""
    sheet = _sheet(spark, sf_dir)
    stop = (F.col("channel") == "Pincrux") & (F.col("Cost") == "None")
    return firstrow.until_terminator(sheet, stop, "row_no").withColumnRenamed("Cost", "cost_text")


@query
def earliest_date(spark, sf_dir):
    return firstrow.earliest(fixture(spark, sf_dir, "fx_af"))


@query
def lookup_first(spark, sf_dir):
    return firstrow.lookup(_sheet(spark, sf_dir), "date", "2024-01-05", ["row_no"]).withColumnRenamed(
        "Cost", "cost_text"
    )


# --- scalar functions -----------------------------------------------------------------------------


@query
def num_clean(spark, sf_dir):
    rows = _ad_text(spark, sf_dir)
    return rows.select(
        "spend_text",
        "clicks_text",
        clean_number(F.col("spend_text")).alias("spend"),
        clean_number(F.col("clicks_text")).alias("clicks"),
        clean_sheet_number(F.col("clicks_text")).alias("sheet_clicks"),
    )


@query
def text_to_numbers(spark, sf_dir):
    rows = _raw(spark, sf_dir)
    return rows.select(
        "seq",
        text_to_long(F.col("amount")).alias("as_long"),
        text_to_double(F.col("amount")).alias("as_double"),
        is_float(F.col("amount")).alias("float_like"),
    )


@query
def bool_text(spark, sf_dir):
    rows = fixture(spark, sf_dir, "fx_event")
    text = F.when(F.col("event_id") % 3 == 0, F.lit("None")).otherwise(F.initcap(F.col("first").cast("string")))
    return rows.select("event_id", is_true(text).alias("flag"), is_true(F.col("first")).alias("same"))


@query
def url_decode_keys(spark, sf_dir):
    """Over users' campaigns and over whole page texts."""
    users = fixture(spark, sf_dir, "fx_user").select(F.col("distinct_id").alias("id"), F.col("campaign").alias("v"))
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("id"), F.col("html").alias("v"))
    return users.unionByName(pages).select("id", unquote(F.col("v")).alias("decoded"))


@query
def id_kinds(spark, sf_dir):
    rows = _raw(spark, sf_dir)
    return rows.select(
        "seq", is_uuid_like(F.col("dirty")).alias("uuid_like"), is_custom_id(F.col("dirty")).alias("custom")
    )


@query
def os_class_of_texts(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", os_class(F.col("url"), F.col("html")).alias("os"))


@query
def os_class_of_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", os_class(F.col("source"), F.col("text")).alias("os"))


@query
def json_explode_ids(spark, sf_dir):
    rows = _raw(spark, sf_dir)
    return rows.select("seq", F.explode_outer(id_values(F.col("challenge_ids"))).alias("challenge_id"))


@query
def json_instagram(spark, sf_dir):
    rows = fixture(spark, sf_dir, "fx_challenge")
    return rows.select("challenge_id", any_named(F.col("custom_fields"), "instagram").alias("need_instagram"))


@query
def json_decoded(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 4 == 0, F.col("event_type")).otherwise(F.col("props"))
    value = json_decode(text)
    return rows.select(
        "event_id",
        value.isNotNull().alias("parsed"),
        F.try_variant_get(value, "$.k", "bigint").alias("k"),
    )


@query
def expand_properties(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    kept = keep_keys(json_value_map(F.col("props")), ["k"])
    return rows.select("event_id", F.size(kept).alias("n"), kept["k"].alias("k"))


@query
def id_list(spark, sf_dir):
    rows = _raw(spark, sf_dir)
    return rows.select("seq", id_list_text(id_values(F.col("challenge_ids"))).alias("ids"))


@query
def date_functions(spark, sf_dir):
    rows = fixture(spark, sf_dir, "fx_af")
    day = text_to_date(F.col("time"))
    return rows.select(
        "time",
        day.alias("day"),
        day_difference(day, F.lit(days_before(AS_OF, 0))).alias("age"),
        F.lit(days_before(AS_OF, 6)).alias("week_start"),
    )


@query
def ratio_guard(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_linenumber").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("part"),
        F.count_if(F.col("l_discount") == 0).alias("whole"),
    )
    return rows.withColumn("ratio", percent(F.col("part"), F.col("whole")))


# --- scans and sinks on files made from the tables ---------------------------------------------------


@query
def parquet_scan(spark, sf_dir):
    return scans.read_parquet(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_quantity"])


@query
def json_scan(spark, sf_dir):
    path = scratch_dir(spark, "json", sf_dir)
    rows = fixture(spark, sf_dir, "fx_day").drop("event_date")
    rows.write.mode("overwrite").json(path, compression="gzip")
    return scans.read_json(spark, path, "distinct_id string, event string, revenue double")


@query
def csv_text_scan(spark, sf_dir):
    """Missing values come back as the text 0."""
    path = scratch_dir(spark, "csv", sf_dir)
    sinks.save_csv(_ad_text(spark, sf_dir).select("day", "channel", "campaign", "adset", "spend_text"), path)
    return scans.read_csv(spark, path)


def _daily_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_event").select(
        "event_id", "event", "distinct_id", F.col("event_date").alias("date")
    )


def _daily_snapshots(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_dir(spark, "snapshots", sf_dir)
    sinks.save_snapshot(_daily_rows(spark, sf_dir), path)
    return path


@query
def regex_scan(spark, sf_dir):
    """Two of the given tables by name, columns optional, rows distinct."""
    return scans.read_matching(
        spark, sf_dir, r"/(customer|supplier)\.parquet(/[^/]*)?$", ["c_name", "c_nationkey", "s_name", "absent"], distinct=True
    )


@query
def period_file_scan(spark, sf_dir):
    path = scratch_dir(spark, "daily", sf_dir)
    _daily_rows(spark, sf_dir).repartition("date").write.mode("overwrite").partitionBy("date").parquet(path)
    files = scans.read_period_files(spark, path, "2024-01-10", "2024-01-20", ["event_id", "Date", "absent"])
    return files.withColumnRenamed("Date", "file_date")


@query
def period_csv_scan(spark, sf_dir):
    """Daily CSV files, which hold missing values as nothing."""
    path = scratch_dir(spark, "daily-csv", sf_dir)
    rows = _ad_text(spark, sf_dir).select("campaign", "spend_text", F.col("day").alias("date"))
    rows.write.mode("overwrite").partitionBy("date").option("header", True).csv(path, compression="gzip")
    files = scans.read_period_csv(spark, path, "2024-01-03", "2024-01-12", ["campaign", "spend_text", "Date", "absent"])
    return files.withColumnRenamed("Date", "file_date")


@query
def period_scan(spark, sf_dir):
    path = _daily_snapshots(spark, sf_dir)
    return scans.read_period(spark, path, "2024-01-24", "2024-02-03", ["event_id", "event", "date", "absent"])


@query
def latest_snapshot(spark, sf_dir):
    """The newest day up to a date some days after the last."""
    path = _daily_snapshots(spark, sf_dir)
    return scans.latest_snapshot(spark, path, "2024-02-03").select("event_id", "event", "date")


@query
def typed_save(spark, sf_dir):
    path = scratch_dir(spark, "typed", sf_dir)
    rows = _raw(spark, sf_dir).select("seq", "amount", F.col("kind_flag").alias("flag"), F.col("event_date").alias("date"))
    sinks.save_typed(rows, path, ["amount"], ["flag"])
    return scans.read_all(spark, path)


@query
def period_report_scan(spark, sf_dir):
    path = scratch_dir(spark, "report", sf_dir)
    sinks.save_report(campaign_report_all(spark, sf_dir), path, AS_OF)
    return scans.read_report(spark, path, "weekly", AS_OF, ["media_source", "campaign", "mau", "unique_installs", "level"])


@query
def attribution_files(spark, sf_dir):
    """One CSV folder for each of two apps and each kind, with columns in another order for each, and some of its own."""
    path = scratch_dir(spark, "attribution", sf_dir)
    rows = fixture(spark, sf_dir, "fx_af").select(
        F.col("event").alias("Event Name"),
        F.col("time").alias("Event Time"),
        F.col("appsflyer_id").alias("AppsFlyer ID"),
        F.col("user_id").alias("Customer User ID"),
        "kind",
        F.when(F.pmod(F.xxhash64("time", "user_id"), F.lit(2)) == 0, F.lit("ios")).otherwise(F.lit("aos")).alias("app"),
    )
    texts = rows.columns[:4]
    kinds = [*ATTRIBUTION_KINDS, *ATTRIBUTION_SKIPPED]
    for i, (app, kind) in enumerate((a, k) for a in ("ios", "aos") for k in kinds):
        order = texts[i % 4 :] + texts[: i % 4]
        part = rows.where((F.col("app") == app) & (F.col("kind") == kind)).select(F.lit("own").alias(f"Column {i}"), *order)
        folder = f"{path}/{app}_{AS_OF}_{AS_OF}_{kind}.csv.gz"
        part.write.mode("overwrite").option("header", True).csv(folder, compression="gzip")
    return scans.shape_attribution(scans.read_attribution(spark, path, AS_OF))


def _exported(spark: SparkSession, sf_dir: str, name: str, rows: DataFrame) -> DataFrame:
    """Rows written as JSON lines, which leave out what is missing, and read again without a schema."""
    path = scratch_dir(spark, name, sf_dir)
    rows.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").option("compression", "gzip").text(path)
    return scans.read_open_json(spark, path)


@query
def event_flatten(spark, sf_dir):
    """An export of events whose properties differ by row."""
    extra = F.when(F.col("revenue") > 1, F.struct("event_date").alias("nested"))
    rows = fixture(spark, sf_dir, "fx_day").select("event", F.struct("distinct_id", "revenue", extra.alias("extra")).alias("properties"))
    events = _exported(spark, sf_dir, "event-export", rows)
    return scans.flatten_open(events, {"distinct_id": "string", "revenue": "double"}, {"event": "string"}).select(
        "distinct_id", "revenue", "event"
    )


def _user_export(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    users = fixture(spark, sf_dir, "fx_user").select(
        "distinct_id", F.struct("corp_name", "media_source", "campaign").alias("properties")
    )
    rows = _exported(spark, sf_dir, "user-export", users)
    return scans.flatten_open(rows, dict.fromkeys(columns, "string"), {"distinct_id": "string"})


@query
def user_export(spark, sf_dir):
    """Exported users that have an attribution."""
    users = _user_export(spark, sf_dir, ["corp_name", "media_source", "campaign"])
    users = users.where(scans.is_attributed(F.col("media_source"), F.col("corp_name")))
    return users.select("corp_name", "media_source", "campaign", "distinct_id")


@query
def open_export(spark, sf_dir):
    """Properties that no column was named for, as kept beside the others."""
    users = _user_export(spark, sf_dir, ["media_source"])
    others = F.col("other_properties")
    return users.select(
        "distinct_id", "media_source", F.size(others).alias("n_others"), others["campaign"].alias("campaign"), others["corp_name"].alias("corp_name")
    )

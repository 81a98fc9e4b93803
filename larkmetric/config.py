"""Names, sentinels, tiers and channel layouts.

Event, category and flag names are parameters: they name things in the
caller's data, so they live here and in no operator.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: texts that stand for "no value" --------------------------
SENTINELS = ["None", "", "00000000-0000-0000-0000-000000000000"]
TEST_VALUES = ["", "None", "test", "테스트"]
TEXT_TRUE = ["true", "True"]

# --- fixed values: words that name a device class ------------------------------
AOS_WORDS = ["android", "samsung"]
IOS_WORDS = ["ios", "ipad", "mac", "iphone", "apple"]
WEB_WORD, MOBILE_WORD = "browser", "mobile"
ORGANIC = "organic"

# --- fixed values: event log columns ---------------------------------------
EVENT_COLUMNS = [
    "event",
    "distinct_id",
    "challenge_id",
    "first",
    "order_no",
    "order_count",
    "time",
]
USER_COLUMNS = ["distinct_id", "corp_name", "media_source", "campaign"]
GROUP_KEYS = ["media_source", "campaign"]
ROLLUP_KEYS = ["channel", "campaign", "adset", "ad"]
AD_REPORT_METRICS = ["spend", "impressions", "clicks"]

# --- fixed values: attribution log ------------------------------------------
ATTRIBUTION_COLUMNS = [
    "Install Time",
    "Event Time",
    "Event Name",
    "Event Value",
    "Media Source",
    "Channel",
    "Keywords",
    "Campaign",
    "Campaign ID",
    "Adset",
    "Adset ID",
    "Ad",
    "Ad ID",
    "Ad Type",
    "AppsFlyer ID",
    "Customer User ID",
    "App ID",
    "appsflyer_type",
]
ATTRIBUTION_RENAMES = {
    "Event Name": "event",
    "Event Value": "event_value",
    "Install Time": "install_time",
    "Event Time": "time",
    "Customer User ID": "user_id",
    "AppsFlyer ID": "appsflyer_id",
    "App ID": "app_id",
}
ATTRIBUTION_KINDS = ["inapp", "install", "org_inapp", "org_install"]
ATTRIBUTION_SKIPPED = ["reinstall", "reinapp"]

# --- report periods: label -> days looked back, as_of included ---------------
PERIODS = {"monthly": 30, "weekly": 7, "daily": 1}

# Rows of a database table that one task reads, about.
ROWS_PER_TASK = 300_000

# The local day of an event is its UTC time less this many hours.
EVENT_DATE_SHIFT_HOURS = 9


@dataclass(frozen=True)
class EventNames:
    install: str = "$ae_first_open"
    signup: str = "signup"
    invite: str = "invite"
    challenge: str = "challenge_complete_checkout"
    brand: str = "brand_challenge_complete_checkout"
    corp: str = "corp_challenge_complete_checkout"
    store: str = "store_complete_checkout"
    store_checkout: str = "store_complete_checkout"


@dataclass(frozen=True)
class FunnelEvents:
    install: str = "install"
    signup: str = "signup"
    view: str = "af_content_view"
    purchase: str = "apply_complete_payment_server"
    store_purchase: str = "store_complete_checkout"


@dataclass(frozen=True)
class Tier:
    """Price ``n`` (plus ``m`` with photo proof) for lo..hi registrations."""

    lo: int
    hi: int | None
    n: int
    m: int
    hi_incl: bool = False
    lo_incl: bool = True


# --- fixed values: price tiers of the three brand categories -----------------
FLAT_TIERS = (
    Tier(10, 100, 3000000, 1000000, hi_incl=True),
    Tier(100, 300, 4000000, 1500000, hi_incl=True, lo_incl=False),
    Tier(300, 500, 5000000, 2000000, hi_incl=True, lo_incl=False),
    Tier(500, None, 5000000, 2000000, lo_incl=False),
)
MID_TIERS = (
    Tier(300, 500, 15000, 4000),
    Tier(500, 1000, 13000, 4000),
    Tier(1000, 2000, 10000, 4000),
    Tier(2000, None, 8000, 3200),
)
HIGH_TIERS = (
    Tier(500, 1000, 10000, 3000),
    Tier(1000, 3000, 8000, 3000),
    Tier(3000, 4000, 6000, 3000),
    Tier(4000, None, 4800, 2400),
)

CHALLENGE, BRAND, CORP = 2, 1, 3  # service types; CHALLENGE is the default


@dataclass(frozen=True)
class ServiceRules:
    """Which category names decide a service type, and the tiers they price."""

    corp_level3: str = "corp_only"
    corp_level2: str = "corp"
    brand_level2: str = "brand"
    flat_level3: str = "brand_action"
    mid_level3: str = "brand_visit"
    high_level3: str = "brand_review"

    @property
    def tiers(self) -> dict[str, tuple[Tier, ...]]:
        return {
            self.flat_level3: FLAT_TIERS,
            self.mid_level3: MID_TIERS,
            self.high_level3: HIGH_TIERS,
        }


@dataclass(frozen=True)
class ChannelLayout:
    channel: str
    renames: dict[str, str]
    numbers: list[str]
    drops: list[str]


INDEX_COLUMNS = ["Unnamed: 0", "index"]

# --- fixed values: column layout of each ad channel's export -----------------
FACEBOOK = ChannelLayout(
    channel="facebook",
    renames={
        "Date": "date",
        "campaign_name": "campaign",
        "adset_name": "adset",
        "ad_name": "ad",
    },
    numbers=["spend", "impressions", "clicks", "reach", "cpm", "ctr", "cpp"],
    drops=[],
)
GOOGLE = ChannelLayout(
    channel="google",
    renames={"Date": "date", "ad_set_id": "adset_id", "ad_set": "adset", "cost": "spend"},
    numbers=["cpm", "cpc", "ctr", "impressions", "clicks", "conversions", "spend", "status"],
    drops=[],
)
NAVER = ChannelLayout(
    channel="naver",
    renames={
        "campaign_name": "campaign",
        "adgroup_name": "adset",
        "ad_name": "ad",
        "campaign_status": "status",
        "Date": "date",
        "adgroup_id": "adset_id",
        "adgroup_nccCampaignId": "campaign_id",
        "adgroup_status": "status",
        "adgroup_ctr": "ctr",
        "adgroup_clkCnt": "clicks",
        "adgroup_ror": "ror",
        "adgroup_viewCnt": "views",
        "adgroup_cpc": "cpc",
        "adgroup_ccnt": "conversions",
        "adgroup_impCnt": "impressions",
        "adgroup_salesAmt": "spend",
    },
    numbers=["ctr", "clicks", "ror", "views", "cpc", "conversions", "impressions", "spend"],
    drops=[
        "campaign_campaignTp",
        "campaign_totalChargeCost",
        "status",
        "campaign_expectCost",
        "campaign_ctr",
        "campaign_convAmt",
        "campaign_clkCnt",
        "campaign_crto",
        "campaign_ror",
        "campaign_viewCnt",
        "campaign_cpc",
        "campaign_ccnt",
        "campaign_id",
        "campaign_cpConv",
        "campaign_impCnt",
        "campaign_salesAmt",
        "adgroup_mobileChannelId",
        "adgroup_pcChannelId",
        "adgroup_pcChannelKey",
        "adgroup_mobileChannelKey",
        "adgroup_nccAdgroupId",
        "adgroup_expectCost",
        "adgroup_adgroupAttrJson",
        "adgroup_adgroupType",
        "adgroup_convAmt",
        "adgroup_crto",
        "adgroup_cpConv",
    ],
)
ADISON = ChannelLayout(
    channel="adison",
    renames={
        "Date": "date",
        "플랫폼": "platform",
        "캠페인": "campaign",
        "오퍼월 리스트 노출": "impressions",
        "클릭": "clicks",
        "참여": "participations",
        "유니크 참여": "unique_participations",
        "완료": "completes",
        "CTR": "ctr",
        "CVR": "cvr",
        "광고비": "spend",
    },
    numbers=[
        "impressions",
        "clicks",
        "participations",
        "unique_participations",
        "completes",
        "ctr",
        "cvr",
        "spend",
    ],
    drops=["리포팅 기간", "광고단가", "채널"],
)
PINCRUX = ChannelLayout(
    channel="pincrux",
    renames={"complete": "completes"},
    numbers=["clicks", "completes"],
    drops=["Date", "conversion_rate", "channel", "campaign"],
)
PINCRUX_SHEET_CHANNEL = "Pincrux"
SHEET_COST_HEADER = "광고비"

# --- fixed values: fields kept of the search-ad entities ----------------------
SEARCH_CAMPAIGN_FIELDS = [
    "nccCampaignId",
    "name",
    "campaignTp",
    "totalChargeCost",
    "status",
    "expectCost",
]
SEARCH_ADGROUP_FIELDS = [
    "nccAdgroupId",
    "nccCampaignId",
    "mobileChannelId",
    "pcChannelId",
    "name",
    "targets",
    "pcChannelKey",
    "mobileChannelKey",
    "status",
    "expectCost",
    "adgroupAttrJson",
    "adgroupType",
]

# --- fixed values: lifetime-value state ---------------------------------------
LTV_COUNTS = ["brand_challenge_count", "challenge_count"]
LTV_VALUES = [
    "brand_challenge_value",
    "_brand_challenge_value",
    "challenge_value",
    "_challenge_value",
    "store_value",
]


@dataclass(frozen=True)
class LtvRules:
    """Value credited per checkout beside the revenue columns."""

    brand_unit_value: float = 1.0
    challenge_unit_value: float = 1.0

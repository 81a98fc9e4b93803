"""Ad channel exports to one table (PRJ-15 … PRJ-23, JOIN-9, JOIN-16)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..config import ChannelLayout
from ..functions import clean_number, exact_sum, to_number
from .firstrow import first_per_key
from .joins import hot_join


def _shape(df: DataFrame, layout: ChannelLayout) -> DataFrame:
    """Rename, drop and cast in one projection.

    By position: an export may have both ``Date`` and ``date``.
    """
    dropped = set(layout.drops) | set(config.INDEX_COLUMNS)
    columns = df.dtypes
    places = [f"_{i}" for i in range(len(columns))]
    out: list[Column] = []
    for place, (name, kind) in zip(places, columns):
        new = layout.renames.get(name, name)
        if name in dropped or new in dropped:
            continue
        value = to_number(F.col(place), kind) if new in layout.numbers else F.col(place)
        out.append(value.alias(new))
    return df.toDF(*places).select(*out)


def facebook(df: DataFrame) -> DataFrame:
    return _shape(df, config.FACEBOOK).withColumn("channel", F.lit("facebook"))


def google(df: DataFrame) -> DataFrame:
    """Costs are compared as text: ``0.0`` passes, ``0`` and ``-1`` do not."""
    paid = df.where(F.col("cost").cast("string") > F.lit("0"))
    return _shape(paid, config.GOOGLE).withColumn("channel", F.lit("google"))


def naver(df: DataFrame) -> DataFrame:
    shaped = _shape(df, config.NAVER)
    return shaped.where(F.col("spend") > 0).withColumn("channel", F.lit("naver"))


def adison(df: DataFrame) -> DataFrame:
    return _shape(df, config.ADISON).withColumn("channel", F.lit("adison"))


def sum_per_date(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy("date").agg(
        *[exact_sum(F.col(c)).alias(c) for c in columns]
    )


def sheet_spend(sheet: DataFrame, order: list[str], channel: str = config.PINCRUX_SHEET_CHANNEL) -> DataFrame:
    """Per date the cost text of the first sheet row of the channel that has one."""
    rows = sheet.where(
        (F.col("channel") == channel) & F.coalesce(F.col("Cost") != "None", F.lit(True))
    )
    return first_per_key(rows, ["date"], order, ["Cost"])


def pincrux(df: DataFrame, sheet: DataFrame, order: list[str]) -> DataFrame:
    """Daily sums, with the spend looked up in the cost sheet."""
    daily = sum_per_date(_shape(df, config.PINCRUX), config.PINCRUX.numbers)
    spend = sheet_spend(sheet, order).select("date", clean_number(F.col("Cost")).alias("spend"))
    return daily.join(spend, "date", "left").withColumn("channel", F.lit("pincrux"))


def unify(exports: dict[str, DataFrame], sheet: DataFrame | None = None, order: list[str] = ()) -> DataFrame:
    """All channels' exports as one ad table with a date column.

    A channel whose export is empty to the point of having no column adds nothing.
    """
    shapers = {
        "facebook": facebook,
        "google": google,
        "naver": naver,
        "adison": adison,
        "pincrux": lambda df: pincrux(df, sheet, list(order)),
    }
    frames = [shapers[name](df) for name, df in exports.items() if df.columns]
    if not frames:
        raise LookupError("no channel has an export")
    table = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return table.withColumn("date", F.col("date").try_cast("date"))


def micro_costs(df: DataFrame) -> DataFrame:
    """Cost from average cost and interactions; money comes in millionths."""
    return df.withColumns(
        {
            "cost": (F.col("average_cost") * F.col("interactions") / 1000000).cast("bigint"),
            "cpm": F.col("average_cpm") / 1000000,
            "cpc": F.col("average_cpc") / 1000000,
        }
    ).drop("average_cost", "interactions", "average_cpm", "average_cpc")


def unpivot_sheet(
    df: DataFrame, metric_first: bool = True, since: str | None = None, until: str | None = None
) -> DataFrame:
    """Wide sheet columns ``metric-channel`` (or ``channel-metric``) to rows.

    One row per date and header, with the value under its metric's column. A
    header without exactly one ``-`` is skipped, or with ``channel-metric``
    headers counted under channel ``total_<header>``.
    """
    headers = [c for c in df.columns if c and c != "date"]
    if since is not None:
        df = df.where(F.col("date") >= since)
    if until is not None:
        df = df.where(F.col("date") <= until)
    plan = []
    for header in headers:
        parts = header.split("-")
        if len(parts) == 2:
            metric, channel = parts if metric_first else parts[::-1]
            if metric_first and metric == config.SHEET_COST_HEADER:
                metric = "Cost"
        elif metric_first:
            continue
        else:
            metric, channel = header, f"total_{header}"
        plan.append((header, channel, metric))
    metrics = list(dict.fromkeys(metric for _, _, metric in plan))
    cells = [
        F.struct(
            F.lit(channel).alias("channel"),
            *[(F.col(f"`{header}`") if m == metric else F.lit(None).cast("string")).alias(m) for m in metrics],
        )
        for header, channel, metric in plan
    ]
    return df.select("date", F.inline(F.array(*cells)))


def join_search_ads(
    campaigns: DataFrame, campaign_stats: DataFrame, adgroups: DataFrame, adgroup_stats: DataFrame
) -> DataFrame:
    """Campaigns (with stats where there are some) of ad groups that have stats."""

    def prefixed(df: DataFrame, prefix: str, fields: list[str] | None = None) -> DataFrame:
        names = [c for c in df.columns if fields is None or c in fields]
        return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in names])

    c = prefixed(campaigns, "campaign", config.SEARCH_CAMPAIGN_FIELDS)
    g = prefixed(adgroups, "adgroup", config.SEARCH_ADGROUP_FIELDS)
    cs, gs = prefixed(campaign_stats, "campaign"), prefixed(adgroup_stats, "adgroup")
    groups = gs.join(g, gs["adgroup_id"] == g["adgroup_nccAdgroupId"])
    with_stats = c.join(cs, c["campaign_nccCampaignId"] == cs["campaign_id"], "left")
    key = "adgroup_nccCampaignId"
    return hot_join(groups, with_stats.withColumnRenamed("campaign_nccCampaignId", key), key, "inner")

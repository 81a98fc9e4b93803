"""Challenge and store marts with their revenue (JOIN-1 … JOIN-6, JOIN-17, REV-1/2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import BRAND, CHALLENGE, CORP, ServiceRules, Tier
from ..functions import any_named
from .dedup import spread_distinct
from .joins import full_outer


def challenge_goals(challenge: DataFrame, goal: DataFrame, category: DataFrame) -> DataFrame:
    """Challenges with their category levels; photo proof is read before joining."""
    flagged = challenge.select(
        "challenge_id", "goal_id", any_named(F.col("custom_fields"), "instagram").alias("need_instagram")
    )
    return (
        flagged.join(goal, "goal_id", "left")
        .join(category, "goal_category_id", "left")
        .drop("goal_id", "goal_category_id")
    )


def challenge_results(user_challenge: DataFrame, result: DataFrame) -> DataFrame:
    """Challenges users joined, with count and margin.

    Users are not kept, so their rows are reduced to challenges before the join.
    """
    ids = user_challenge.select("challenge_id").distinct()
    return ids.join(result.distinct(), "challenge_id", "left")


def challenge_base(
    challenge: DataFrame,
    goal: DataFrame,
    category: DataFrame,
    user_challenge: DataFrame,
    result: DataFrame,
    info: DataFrame,
) -> DataFrame:
    """One row per challenge (distinct), with both registration counts."""
    users = challenge_results(user_challenge, result)
    goals = challenge_goals(challenge, goal, category)
    # Either side has about one row per challenge: no key is hot here.
    both = users.join(goals, "challenge_id", "full_outer").distinct()
    extra = info.select(
        "challenge_id", F.col("register_count").alias("info_register_count"), "fee"
    )
    return both.join(extra, "challenge_id", "left")


def commerce_products(bridge: DataFrame, commerce: DataFrame, product: DataFrame) -> DataFrame:
    return bridge.join(commerce, "challenge_commerce_id", "left").join(product, "product_id", "left")


def challenge_mart(base: DataFrame, products: DataFrame, rules: ServiceRules = ServiceRules()) -> DataFrame:
    """Challenges and their products, whichever exist, with revenue."""
    return with_challenge_revenue(full_outer(base, products, "challenge_id").distinct(), rules)


def service_type(level2: Column, level3: Column, rules: ServiceRules = ServiceRules()) -> Column:
    """Corp is tested before brand; anything else is a plain challenge."""
    return (
        F.when((level3 == rules.corp_level3) | (level2 == rules.corp_level2), F.lit(CORP))
        .when((level2 == rules.brand_level2) | level3.isin(*rules.tiers), F.lit(BRAND))
        .otherwise(F.lit(CHALLENGE))
    )


def _within(count: Column, tier: Tier) -> Column:
    above = (count >= tier.lo) if tier.lo_incl else (count > tier.lo)
    if tier.hi is None:
        return above
    return above & ((count <= tier.hi) if tier.hi_incl else (count < tier.hi))


def brand_price(level3: Column, count: Column, proof: Column, rules: ServiceRules = ServiceRules()) -> Column:
    """Tier price by category and registrations; 0 below the lowest tier."""
    prices = [
        F.when(
            (level3 == category) & _within(count, tier),
            F.lit(tier.n) + F.when(proof, F.lit(tier.m)).otherwise(F.lit(0)),
        )
        for category, tiers in rules.tiers.items()
        for tier in tiers
    ]
    return F.coalesce(*prices, F.lit(0))


def with_challenge_revenue(df: DataFrame, rules: ServiceRules = ServiceRules()) -> DataFrame:
    """Adds service type, its two flags, and revenue from brand, user and both."""
    zero = F.lit(0)
    count = F.greatest(
        F.coalesce("register_count", zero), F.coalesce("info_register_count", zero)
    )
    kind = service_type(F.col("level2"), F.col("level3"), rules)
    brand = F.when(
        kind == BRAND, brand_price(F.col("level3"), count, F.col("need_instagram"), rules)
    ).otherwise(zero)
    margin = F.coalesce(F.col("margin").try_cast("double"), F.lit(0.0))
    share = F.when(count > 0, margin / count).otherwise(F.lit(0.0))
    user = share + F.coalesce(F.col("product_fee").try_cast("double"), F.lit(0.0))
    return df.withColumns(
        {
            "service_type": kind,
            "is_brand": kind == BRAND,
            "is_corp": kind == CORP,
            "revenue_from_brand": brand.cast("double"),
            "revenue_from_challenge": user,
            "revenue": brand + user,
        }
    )


def store_mart(orders: DataFrame, items: DataFrame, options: DataFrame) -> DataFrame:
    """Order numbers with option price, fee ratio and reward, and their revenue."""
    joined = (
        orders.join(items, "pill_order_id")
        .join(options, "pill_option_id")
        .drop("pill_order_id", "pill_option_id")
    )
    return spread_distinct(joined).withColumn("revenue", store_revenue())


def store_revenue() -> Column:
    price = F.col("discounted_price").try_cast("double").cast("bigint")
    return price * F.col("fee_ratio").try_cast("double") + F.col("reward_amount").try_cast("double")

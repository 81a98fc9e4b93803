"""Hierarchical ad rollup (AGG-1)."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import PERIODS, ROLLUP_KEYS
from ..functions import as_limbs, days_before, limb_sums, limbs, named_limbs, whole
from .clean import within_days


def _metrics(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def _finest(df: DataFrame, extra: list[str], metrics: list[str]) -> DataFrame:
    """Exact sums of the full key, in limbs. Only these groups, not the input rows, are
    multiplied by levels and periods afterwards."""
    return df.groupBy(*extra, *ROLLUP_KEYS).agg(
        *[part for m in metrics for part in as_limbs(m, limb_sums(limbs(F.col(m))))]
    )


def _levels(finest: DataFrame, extra: list[str], metrics: list[str]) -> DataFrame:
    """Sums for every prefix of the keys whose columns are all set."""
    levels = []
    for depth, key in enumerate(ROLLUP_KEYS, 1):
        parents = ROLLUP_KEYS[: depth - 1]
        present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in ROLLUP_KEYS[:depth]])
        levels.append(
            F.struct(
                F.when(present, F.lit(key)).alias("key"),
                F.col(key).alias("value"),
                *[
                    (F.col(k) if k in parents else F.lit(None).cast("string")).alias(k)
                    for k in ROLLUP_KEYS[:-1]
                ],
            )
        )
    names = ["key", "value", *ROLLUP_KEYS[:-1]]
    return (
        finest.select(*extra, *[part for m in metrics for part in named_limbs(m)], F.inline(F.array(*levels)))
        .where(F.col("key").isNotNull())
        .groupBy(*extra, *names)
        .agg(*[whole(limb_sums(named_limbs(m))).alias(m) for m in metrics])
    )


def ad_rollup(df: DataFrame, ratios: bool = False) -> DataFrame:
    """Sums per channel, campaign, ad set and ad.

    ``key`` names the level and ``value`` holds its last key. Rates are summed
    like any number; ``ratios`` adds rates worked out from the sums.
    """
    metrics = _metrics(df)
    return _with_ratios(_levels(_finest(df, [], metrics), [], metrics), ratios)


def ad_rollup_periods(df: DataFrame, as_of: str | dt.date, ratios: bool = False) -> DataFrame:
    """The rollup over each report period, in one pass over the ad table.

    Periods nest, so rows are summed in disjoint day bands before a band is
    counted for every period it lies in.
    """
    days = F.datediff(F.lit(days_before(as_of, 0)), F.col("date"))
    bands = sorted(PERIODS.values())
    band = reduce(lambda c, b: c.when(days < b, F.lit(b)), bands[1:], F.when(days < bands[0], F.lit(bands[0])))
    metrics = _metrics(df)
    window = within_days(df, as_of, bands[-1], "date").withColumn("_band", band)
    member = F.array(*[F.when(F.col("_band") <= n, F.lit(label)) for label, n in PERIODS.items()])
    banded = _finest(window, ["_band"], metrics).withColumn("period", F.explode(member))
    per_period = banded.where(F.col("period").isNotNull())
    return _with_ratios(_levels(per_period, ["period"], metrics), ratios)


def _with_ratios(df: DataFrame, wanted: bool) -> DataFrame:
    if not wanted:
        return df
    clicks, shown, spend = F.col("clicks"), F.col("impressions"), F.col("spend")
    return df.withColumns(
        {
            "ctr_of_sums": F.when(shown > 0, clicks / shown * 100),
            "cpm_of_sums": F.when(shown > 0, spend / shown * 1000),
            "cpc_of_sums": F.when(clicks > 0, spend / clicks),
        }
    )

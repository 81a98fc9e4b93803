"""Joins for facts with hot and missing keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNHASHABLE = ("map", "variant")


def spread_nulls(key: Column, *by: str, ways: int = 4096) -> Column:
    """A text join key whose NULLs, which match nothing, do not share one task.

    Keys begin with ``=`` and stand-ins for NULL do not, so no key equals a stand-in.
    """
    return F.coalesce(F.concat(F.lit("="), key), F.pmod(F.xxhash64(*by), F.lit(ways)).cast("string"))


def hot_join(facts: DataFrame, dim: DataFrame, on: str, how: str = "left") -> DataFrame:
    """Join facts that may have most rows under one key, or under none.

    AQE splits a hot partition only if both sides come straight from a shuffle
    made for the join. A ``dim`` that was just grouped by its key would skip
    that shuffle; the concatenation makes it a key of its own, so the (smaller)
    dim is shuffled for the join, and the hot facts can be split.
    """
    by = [name for name, kind in facts.dtypes if name != on and not kind.startswith(UNHASHABLE)]
    key = facts[on].cast("string")
    left = F.concat(F.lit("="), key)
    if how == "left" and by:
        left = spread_nulls(key, *[f"`{name}`" for name in by[:2]])
    right = dim.withColumnRenamed(on, "_on")
    return facts.join(right, left == F.concat(F.lit("="), right["_on"].cast("string")), how).drop("_on")


def full_outer(dim: DataFrame, facts: DataFrame, on: str) -> DataFrame:
    """``dim`` full-outer-join ``facts`` for a fact side with hot keys.

    Spark cannot split a hot key in a full outer join, but it can in a left
    join: facts with what matches, then the ``dim`` rows without facts.
    Keys are compared with ``=``, so NULL keys match nothing and stay.
    """
    keyed = facts.where(facts[on].isNotNull())
    unmatched = dim.join(keyed.select(on).distinct(), on, "left_anti")
    alone = facts.where(facts[on].isNull())
    joined = hot_join(keyed, dim, on, "left").unionByName(unmatched, allowMissingColumns=True)
    return joined.unionByName(alone, allowMissingColumns=True)

"""Text functions (STR-1 … STR-4)."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import AOS_WORDS, IOS_WORDS, MOBILE_WORD, WEB_WORD


def unquote(c: Column) -> Column:
    """URL decode that leaves ``+`` and a ``%`` without two hex digits alone."""
    safe = F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(F.replace(safe, F.lit("+"), F.lit("%2B")))


def is_uuid_like(c: Column) -> Column:
    return F.coalesce(F.contains(c, F.lit("-")), F.lit(False))


def is_custom_id(c: Column) -> Column:
    return F.coalesce(~F.contains(c, F.lit("-")), F.lit(False))


def os_class(*columns: Column) -> Column:
    """``aos``, ``ios`` or ``web`` from the first column that decides it."""

    def decide(c: Column) -> Column:
        v = F.lower(c)

        def has(*words: str) -> Column:
            return reduce(or_, [F.contains(v, F.lit(w)) for w in words])

        return (
            F.when(has(*AOS_WORDS), F.lit("aos"))
            .when(has(*IOS_WORDS), F.lit("ios"))
            .when(has(WEB_WORD) & ~has(MOBILE_WORD), F.lit("web"))
        )

    return F.coalesce(*[decide(c) for c in columns])

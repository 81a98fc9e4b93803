"""JSON and list functions (JSON-1 … JSON-3, ARR-1, PRJ-22)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import JSON_BLANKS, JSON_NUMBER


def json_decode(c: Column, schema: str | None = None) -> Column:
    """Parsed value, or NULL for text that is no JSON."""
    return F.from_json(c, schema) if schema else F.try_parse_json(c)


def id_values(c: Column) -> Column:
    """A JSON list, or one number, as an array of text ids; else NULL."""
    v = F.btrim(c, F.lit(JSON_BLANKS))
    return F.when(v.rlike(JSON_NUMBER), F.array(v)).otherwise(F.from_json(v, "array<string>"))


def any_named(c: Column, name: str) -> Column:
    """Does a JSON list of ``{"name": …}`` hold this name?"""
    items = F.from_json(c, "array<struct<name:string>>")
    return F.coalesce(F.exists(items, lambda x: x["name"] == name), F.lit(False))


def json_value_map(c: Column) -> Column:
    return F.from_json(c, "map<string,string>")


def keep_keys(c: Column, keys: list[str]) -> Column:
    return F.map_filter(c, lambda k, _: k.isin(*keys))


def id_list_text(c: Column) -> Column:
    return F.coalesce(F.array_join(c, ","), F.lit(""))

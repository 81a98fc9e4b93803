from .dates import day_difference, days_before, local_event_date, local_today, text_to_date
from .jsons import any_named, id_list_text, id_values, json_decode, json_value_map, keep_keys
from .numbers import (
    add_limbs,
    as_limbs,
    clean_number,
    clean_sheet_number,
    exact_sum,
    is_float,
    is_true,
    limb_sums,
    limbs,
    named_limbs,
    percent,
    text_to_double,
    text_to_id,
    text_to_long,
    to_number,
    whole,
)
from .text import is_custom_id, is_uuid_like, os_class, unquote

__all__ = [
    "add_limbs",
    "any_named",
    "as_limbs",
    "clean_number",
    "clean_sheet_number",
    "day_difference",
    "days_before",
    "exact_sum",
    "id_list_text",
    "id_values",
    "is_custom_id",
    "is_float",
    "is_true",
    "is_uuid_like",
    "json_decode",
    "json_value_map",
    "keep_keys",
    "limb_sums",
    "limbs",
    "local_event_date",
    "local_today",
    "named_limbs",
    "os_class",
    "percent",
    "text_to_date",
    "text_to_double",
    "text_to_id",
    "text_to_long",
    "to_number",
    "unquote",
    "whole",
]

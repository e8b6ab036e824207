from curate.functions.nested import (
    array_size_histogram,
    distinct_entry_keys,
    entry_value,
    pivot_entries,
)
from curate.functions.text import (
    launch_year,
    ms_to_minutes,
    parse_grouped_int,
    parse_money,
    parse_score,
    parse_unit,
    score_text,
    split_list,
    strip_list_markup,
    to_date_strict,
    to_decimal,
    to_double,
    to_float,
    to_int,
    to_iso_date,
)

__all__ = [
    "array_size_histogram",
    "distinct_entry_keys",
    "entry_value",
    "launch_year",
    "ms_to_minutes",
    "parse_grouped_int",
    "parse_money",
    "parse_score",
    "parse_unit",
    "pivot_entries",
    "score_text",
    "split_list",
    "strip_list_markup",
    "to_date_strict",
    "to_decimal",
    "to_double",
    "to_float",
    "to_int",
    "to_iso_date",
]

"""Operators on arrays of key/value entries.

An entry is a struct or a map with the same field names; ``entry[field]``
reads either one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def entry_value(entries: Column, key_field: str, value_field: str, key: str) -> Column:
    """Value of the first entry whose key equals ``key``; null without one."""
    matches = F.filter(entries, lambda e: e[key_field] == key)
    return F.get(matches, 0)[value_field]


def pivot_entries(
    df: DataFrame,
    entries: str,
    outputs: Mapping[str, str],
    key_field: str = "Source",
    value_field: str = "Value",
) -> DataFrame:
    """Turn named entries of an array into columns and drop the array.

    ``outputs`` maps an entry key to the column that holds its value.
    """
    columns = {
        out: entry_value(F.col(entries), key_field, value_field, key)
        for key, out in outputs.items()
    }
    return df.withColumns(columns).drop(entries)


def distinct_entry_keys(df: DataFrame, entries: str, key_field: str = "Source") -> DataFrame:
    """The different keys that occur in an array column.

    Repeats inside one row are dropped before the rows are multiplied.
    """
    keys = F.array_distinct(F.transform(F.col(entries), lambda e: e[key_field]))
    return df.select(F.explode(keys).alias(key_field)).distinct()


def array_size_histogram(df: DataFrame, entries: str, size_name: str = "size") -> DataFrame:
    """Number of rows per array length; a null array has length -1."""
    size = F.coalesce(F.size(entries), F.lit(-1))
    return df.groupBy(size.alias(size_name)).agg(F.count("*").alias("count"))

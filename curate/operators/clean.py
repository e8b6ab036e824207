"""Standardising and typing of whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sentinel_to_null(df: DataFrame, columns: Iterable[str], sentinel: str = "N/A") -> DataFrame:
    return df.replace(sentinel, None, subset=list(columns))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Null (or NaN) to a default, one default per column.

    A default that cannot be read as the type of its column leaves it alone; a
    column that does not exist is an error.
    """
    filled = {}
    for name, default in defaults.items():
        dtype = df.schema[name].dataType
        value = F.col(f"`{name}`")
        if isinstance(dtype, (T.FloatType, T.DoubleType)):
            value = F.nanvl(value, F.lit(None).cast(dtype))
        filled[name] = F.coalesce(value, F.lit(default).try_cast(dtype))
    return df.withColumns(filled)


def apply_types(df: DataFrame, parsers: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """Replace the named columns by their parsed form in one projection."""
    return df.withColumns({name: parse(F.col(name)) for name, parse in parsers.items()})


def clamp_negative(df: DataFrame, column: str) -> DataFrame:
    """Values below zero become zero; null stays null and the column keeps its type."""
    value, dtype = F.col(f"`{column}`"), df.schema[column].dataType
    return df.withColumn(column, F.when(value < 0, F.lit(0).cast(dtype)).otherwise(value))


def fill_with_mean(df: DataFrame, column: str, flag: str | None = None) -> DataFrame:
    """Null to the mean of the column, with an optional flag column."""
    mean = df.agg(F.avg(column)).scalar()
    filled = {column: F.coalesce(F.col(column).cast("double"), mean)}
    if flag:
        filled[flag] = F.col(column).isNull()
    return df.withColumns(filled)


def with_audit_time(df: DataFrame, name: str = "loaded_at") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def with_flag(df: DataFrame, name: str, condition: Column) -> DataFrame:
    """True where the rule holds, false where it fails or cannot be told."""
    return df.withColumn(name, F.coalesce(condition, F.lit(False)))

"""Size checks for broadcasts and joins that survive hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 128 * 1024 * 1024

# A key is hot when it holds more than one in HOT_PARTS rows, so there are
# fewer than HOT_PARTS hot keys however large the data is. Up to HOT_ROWS rows
# are no burden for a task and never hot.
HOT_PARTS = 10_000
HOT_ROWS = 100_000



@dataclass(frozen=True)
class HotLimits:
    """A key is hot above ``rows`` rows and above one in ``parts`` of all rows."""

    rows: int
    parts: int


_COUNT = "__rows"
_PARTS = "__parts"
_PART = "__part"


def _column_bytes(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + F.lit(16)
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
    return F.lit(16)


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure a table and say whether it may be broadcast. Runs one small job."""
    row_bytes = sum((_column_bytes(f) for f in df.schema.fields), F.lit(0).cast("long"))
    measured = df.agg(F.count("*").alias("rows"), F.sum(row_bytes).alias("bytes")).first()
    return measured["rows"] <= max_rows and (measured["bytes"] or 0) <= max_bytes


def count_rows_by(df: DataFrame, keys: Sequence[str], name: str = _COUNT) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def hot_keys(
    counts: DataFrame, keys: Sequence[str], count: str = _COUNT, limits: HotLimits | None = None
) -> DataFrame:
    """Keys above the hot share, with the number of parts to spread each over.

    There are fewer than ``parts`` of them, and their parts add up to less
    than twice that: it is the proven bound for broadcasting the list.
    """
    limits = limits or HotLimits(HOT_ROWS, HOT_PARTS)
    total = counts.agg(F.sum(count)).scalar()
    share = F.col(count) * F.lit(limits.parts)
    return counts.filter((F.col(count) > limits.rows) & (share > total)).select(
        *keys, F.ceil(share / total).cast("int").alias(_PARTS)
    )


def has_hot_keys(df: DataFrame, keys: Sequence[str], limits: HotLimits | None = None) -> bool:
    """Whether some key, null included, holds a hot share of the rows. Runs one small job."""
    limits = limits or HotLimits(HOT_ROWS, HOT_PARTS)
    seen = count_rows_by(df, keys).agg(F.max(_COUNT).alias("most"), F.sum(_COUNT).alias("all")).first()
    most = seen["most"] or 0
    return most > limits.rows and most * limits.parts > seen["all"]


def split_hot(
    df: DataFrame, keys: Sequence[str], limits: HotLimits | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary keys and rows of hot keys; null is a key like others.

    No ordinary key holds more than the hot share of the rows. Where no key is
    hot, the adaptive planner finds the list empty and skips the second half.
    """
    marked = df.withColumn("__group", F.struct(*keys))
    counts = count_rows_by(marked, ["__group"])
    hot = F.broadcast(hot_keys(counts, ["__group"], limits=limits).select("__group"))
    ordinary = marked.join(hot, "__group", "left_anti").drop("__group")
    return ordinary, marked.join(hot, "__group", "left_semi").drop("__group")


def join_unique(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    counts: DataFrame | None = None,
    count: str = _COUNT,
    limits: HotLimits | None = None,
) -> DataFrame:
    """Join ``left`` with a ``right`` that has one row per key.

    Every hot key of ``left`` is cut into parts by the input partition its rows
    come from, and its row in ``right`` is repeated once per part, so no task
    receives a whole hot key; rows with a null key are spread too. ``counts`` gives
    the rows per key where the caller has them already. ``how`` is inner, left, left_semi or left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"join_unique cannot do a {how!r} join")
    if counts is None:
        counts = count_rows_by(left.dropna(subset=list(keys)), keys, count)
    hot = F.broadcast(hot_keys(counts, keys, count, limits))
    own_part = F.pmod(F.spark_partition_id(), F.col(_PARTS))
    # A null key matches nothing, so its rows may go to any part.
    keyless = F.lit(False)
    for key in keys:
        keyless = keyless | F.col(f"`{key}`").isNull()
    any_part = F.pmod(F.monotonically_increasing_id(), F.lit(HOT_PARTS)).cast("int")
    spread_left = left.join(hot, list(keys), "left").withColumn(
        _PART, F.when(keyless, any_part).otherwise(F.coalesce(own_part, F.lit(0)))
    )
    all_parts = F.sequence(F.lit(0), F.coalesce(F.col(_PARTS), F.lit(1)) - 1)
    spread_right = right.join(hot, list(keys), "left").withColumn(_PART, F.explode(all_parts))
    joined = spread_left.drop(_PARTS).join(
        spread_right.drop(_PARTS), [*keys, _PART], how
    )
    return joined.drop(_PART)

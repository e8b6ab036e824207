"""Running values, ranks and carried values over groups that may hold any share of the rows.

Rows are dealt out by ranges of (group, order), so a large group lies in many ranges, in
order. Each range is windowed on its own; one value per group and range is carried on to
the ranges after it and joined back. No task holds more than a range, whatever the type
of the order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curate.operators.skew import HotLimits, has_hot_keys, join_unique
from curate.sinks.files import stored

RANGE = "__range"


def by_ranges(df: DataFrame, order: Sequence[str | Column], ranges: int | None = None) -> DataFrame:
    """The rows in ranges of ``order``, numbered in that order by ``__range``.

    Written and read back, since the bounds are sampled anew each time a plan runs.
    ``ranges`` is their number, by default that of shuffle partitions, which the
    adaptive planner lowers for small tables.
    """
    dealt = df.repartitionByRange(*([ranges] if ranges else []), *order)
    return stored(dealt.withColumn(RANGE, F.spark_partition_id()), "ranges")


def _link(group: Sequence[str]) -> Column:
    # Structs equal on null fields, as the groups of a window do.
    return F.struct(*group, RANGE).alias("__link")


def _earlier(group: Sequence[str]):
    return Window.partitionBy(*group).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)


def carried_max(ranged: DataFrame, group: Sequence[str], order: str, value: str, name: str) -> DataFrame:
    """Add the largest ``value`` so far in each group; one row per group and order."""
    inside = Window.partitionBy(*group, RANGE).orderBy(order)
    per_range = ranged.groupBy(*group, RANGE).agg(F.max(value).alias(value))
    carried = per_range.select(_link(group), F.max(value).over(_earlier(group)).alias("__carried"))
    return (
        ranged.withColumns({"__local": F.max(value).over(inside), "__link": _link(group)})
        .join(carried, "__link")
        .withColumn(name, F.greatest("__local", "__carried"))
        .drop("__link", "__local", "__carried", RANGE)
    )


def last_known(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    limits: HotLimits | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Add the last ``value`` that is not null, up to and with the row itself.

    Rows that are equal in ``order`` may come in any order. Groups are windowed as
    they are unless one of them is hot.
    """
    so_far = (Window.unboundedPreceding, Window.currentRow)
    if not has_hot_keys(df, group, limits):
        window = Window.partitionBy(*group).orderBy(*order).rowsBetween(*so_far)
        return df.withColumn(name, F.last(value, ignorenulls=True).over(window))
    # The last sort key cuts rows of one group and order value, too.
    ranged = by_ranges(df, [*group, *order, F.monotonically_increasing_id()], ranges)
    inside = Window.partitionBy(*group, RANGE).orderBy(*order).rowsBetween(*so_far)
    known = F.when(F.col(value).isNotNull(), F.struct(*order))
    per_range = ranged.groupBy(*group, RANGE).agg(F.max_by(value, known).alias("__last"))
    carried = per_range.select(
        _link(group), F.last("__last", ignorenulls=True).over(_earlier(group)).alias("__carried")
    )
    return (
        ranged.withColumns(
            {"__local": F.last(value, ignorenulls=True).over(inside), "__link": _link(group)}
        )
        .join(carried, "__link")
        .withColumn(name, F.coalesce("__local", "__carried"))
        .drop("__link", "__local", "__carried", RANGE)
    )


def top_of_large_groups(
    df: DataFrame,
    group: Sequence[str],
    by: str,
    n: int,
    ties: Sequence[str],
    rank_name: str,
    ranges: int | None = None,
) -> DataFrame:
    """The n largest of each group for an n of any size, numbered from 1.

    First the counts of the distinct values of ``by`` are summed up along ranges, which
    gives the value at which each group has its n rows. Rows beyond it go. What is left,
    n rows a group and ties of the last value, is numbered along ranges as well.
    """
    down = F.desc_nulls_last(by)
    counts = df.groupBy(*group, by).agg(F.count("*").alias("__rows"))
    kept = _numbered(by_ranges(counts, [*group, down], ranges), group, [down], F.sum("__rows"))
    cuts = (
        kept.filter(F.col("__before") < n)
        .groupBy(*group)
        .agg(F.min(by).alias("__least"), F.max(F.col(by).isNull()).alias("__nulls"))
        .select(F.struct(*group).alias("__group"), "__least", "__nulls")
    )
    enough = (F.col(by) >= F.col("__least")) | (F.col(by).isNull() & F.col("__nulls"))
    rows = join_unique(df.withColumn("__group", F.struct(*group)), cuts, ["__group"]).filter(enough)
    order = [down, *ties]
    left = rows.select(*df.columns)
    ranged = by_ranges(left, [*group, *order, F.monotonically_increasing_id()], ranges)
    numbered = _numbered(ranged, group, order, F.count("*"))
    rank = (F.col("__before") + 1).cast("int")
    return numbered.filter(F.col("__before") < n).select(*df.columns, rank.alias(rank_name))


def _numbered(ranged: DataFrame, group: Sequence[str], order: Sequence, total: Column) -> DataFrame:
    """Add ``__before``, the ``total`` over the rows of the group before each row."""
    before = Window.partitionBy(*group, RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    per_range = ranged.groupBy(*group, RANGE).agg(total.alias("__total"))
    none = F.lit(0).cast("long")
    carried = per_range.select(
        _link(group), F.coalesce(F.sum("__total").over(_earlier(group)), none).alias("__carried")
    )
    return (
        ranged.withColumns({"__local": F.coalesce(total.over(before), none), "__link": _link(group)})
        .join(carried, "__link")
        .withColumn("__before", F.col("__local") + F.col("__carried"))
        .drop("__link", "__local", "__carried", RANGE)
    )

"""The usual questions: top-k, counts, summaries, running values, enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curate.operators.ranges import by_ranges, carried_max, top_of_large_groups
from curate.operators.skew import HotLimits, fits_broadcast, has_hot_keys, join_unique, split_hot


#: The largest n for which Spark cuts groups before the shuffle.
GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def top_k(df: DataFrame, by: str, k: int = 10, ties: Sequence[str] = ()) -> DataFrame:
    """The k rows with the largest ``by``; null comes last, ``ties`` ascend."""
    return df.orderBy(F.desc_nulls_last(by), *ties).limit(k)


def count_by(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def mean_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias(name))


def mean_and_sum_by(
    df: DataFrame, keys: Sequence[str], value: str, mean_name: str, sum_name: str
) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.avg(value).alias(mean_name), F.sum(value).alias(sum_name)
    )


def top_n_per_group(
    df: DataFrame,
    group: Sequence[str],
    by: str,
    n: int,
    ties: Sequence[str] = (),
    rank_name: str = "rank",
    ranges: int | None = None,
) -> DataFrame:
    """The n rows with the largest ``by`` in each group, numbered from 1.

    Up to Spark's group limit the filter on the row number lets each task cut its
    rows to n per group before the shuffle. Beyond it whole groups would be sorted
    in one task; there ranges are counted, see
    :func:`curate.operators.ranges.top_of_large_groups`. A group may be of any size.
    """
    if n > int(df.sparkSession.conf.get(GROUP_LIMIT)):
        return top_of_large_groups(df, group, by, n, ties, rank_name, ranges)
    window = Window.partitionBy(*group).orderBy(F.desc_nulls_last(by), *ties)
    return df.withColumn(rank_name, F.row_number().over(window)).filter(
        F.col(rank_name) <= n
    )


def running_max(
    df: DataFrame,
    partition: Sequence[str],
    order: str,
    value: str,
    name: str,
    coarse: Column | None = None,
    limits: HotLimits | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Largest ``value`` so far in each partition; equal orders share a result.

    Ordinary partitions are windowed as they are. Hot ones, which may hold any
    share of the rows, are first reduced to one peak per order value; see
    :func:`_running_max_of_hot`. Whether there are any is measured first. ``limits``
    says what is hot, ``ranges`` into how many ranges peaks are dealt out;
    ``coarse``, a column that never falls while ``order`` rises, replaces them.
    """
    so_far = Window.partitionBy(*partition).orderBy(order)
    if not has_hot_keys(df, partition, limits):
        return df.withColumn(name, F.max(value).over(so_far))
    ordinary, hot = split_hot(df, partition, limits)
    plain = ordinary.withColumn(name, F.max(value).over(so_far))
    return plain.unionByName(
        _running_max_of_hot(hot, partition, order, value, name, coarse, limits, ranges)
    )


def _running_max_of_hot(
    df: DataFrame,
    partition: Sequence[str],
    order: str,
    value: str,
    name: str,
    coarse: Column | None,
    limits: HotLimits | None,
    ranges: int | None,
) -> DataFrame:
    """The same result with windows over peaks instead of rows.

    Peaks combine before the shuffle and are dealt out by ranges of partition and
    order, or by coarse steps. Each range or step is windowed on its own, and one
    carried value links it to those before. So a window holds the distinct order
    values of a range, or one row per range of a partition. Peaks join back to the
    rows with hot order values spread.
    """
    keys = [*partition, order]
    peaks = df.groupBy(*keys).agg(
        F.max(value).alias("__peak"), F.count("*").alias("__rows")
    )
    if coarse is None:
        peaks = by_ranges(peaks, keys, ranges)
        running = carried_max(peaks, partition, order, "__peak", name)
    else:
        step = [*partition, "__step"]
        in_step = Window.partitionBy(*step).orderBy(order)
        earlier = (
            Window.partitionBy(*partition)
            .orderBy("__step")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        stepped = peaks.withColumn("__step", coarse)
        carried = (
            stepped.groupBy(*step)
            .agg(F.max("__peak").alias("__peak"))
            .select(
                F.struct(*step).alias("__step_key"),
                F.max("__peak").over(earlier).alias("__carried"),
            )
        )
        running = (
            stepped.withColumn("__local", F.max("__peak").over(in_step))
            .withColumn("__step_key", F.struct(*step))
            .join(carried, "__step_key")
            .withColumn(name, F.greatest("__local", "__carried"))
        )
    # Structs compare field by field and equal on null fields, as windows do.
    key = F.struct(*keys).alias("__key")
    joined = join_unique(
        df.withColumn("__key", key),
        running.select(key, name),
        ["__key"],
        counts=peaks.select(key, "__rows"),
        count="__rows",
        limits=limits,
    )
    return joined.select(*df.columns, name)


def enrich(df: DataFrame, dimension: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join with a dimension that has one row per key.

    The dimension is measured first: a small one is broadcast, a large one is
    joined by shuffle with hot keys spread.
    """
    if fits_broadcast(dimension):
        return df.join(F.broadcast(dimension), list(on), "inner")
    return join_unique(df, dimension, on, "inner")

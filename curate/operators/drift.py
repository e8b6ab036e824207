"""How far the values of a column have moved between two loads."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def histograms(df: DataFrame, columns: Mapping[str, float | None]) -> DataFrame:
    """(column, bucket, rows) of the named columns, all in one scan.

    A column with a width is cut into steps of that width, counted from zero; one
    without is counted by its values. Null is a bucket of its own. Histograms of parts
    of a table add up to that of the whole (``merge_histograms``), so they can be kept
    with each load.
    """
    cells = []
    for name, width in columns.items():
        value = F.col(f"`{name}`")
        step = value if width is None else F.floor(value / F.lit(width))
        cells.append(F.struct(F.lit(name).alias("column"), step.cast("string").alias("bucket")))
    return df.select(F.inline(F.array(*cells))).groupBy("column", "bucket").agg(F.count("*").alias("rows"))


def merge_histograms(one: DataFrame, other: DataFrame) -> DataFrame:
    return one.unionByName(other).groupBy("column", "bucket").agg(F.sum("rows").alias("rows"))


def drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """(column, distance) of two histograms: the share of rows that would have to move to
    another bucket, from 0 to 1 at six digits. Null where one side has no rows."""
    both = before.select("column", "bucket", F.col("rows").alias("old"), F.lit(0).alias("new"))
    both = both.unionByName(
        after.select("column", "bucket", F.lit(0).alias("old"), F.col("rows").alias("new"))
    )
    buckets = both.groupBy("column", "bucket").agg(F.sum("old").alias("old"), F.sum("new").alias("new"))
    totals = buckets.groupBy("column").agg(F.sum("old").alias("all_old"), F.sum("new").alias("all_new"))
    # One row per column of the table.
    moved = F.abs(F.try_divide("new", "all_new") - F.try_divide("old", "all_old"))
    there = (F.col("all_old") > 0) & (F.col("all_new") > 0)
    return (
        buckets.join(F.broadcast(totals), "column")
        .groupBy("column")
        .agg(F.round(F.sum(F.when(there, moved)) / 2, 6).alias("distance"))
    )


def drift_rules(before: DataFrame, after: DataFrame, limits: Mapping[str, float]) -> DataFrame:
    """(rule, column, distance, status): a column beyond its limit, or with one side empty,
    is a warning. Columns without a limit are left out."""
    pairs = [F.lit(x) for pair in limits.items() for x in pair]
    limit = F.create_map(*pairs)[F.col("column")]
    fits = F.coalesce(F.col("distance") <= limit, F.lit(False))
    return (
        drift(before, after)
        .filter(F.col("column").isin(*limits))
        .select(
            F.lit("drift").alias("rule"), "column", "distance",
            F.when(fits, "ok").otherwise("warn").alias("status"),
        )
    )

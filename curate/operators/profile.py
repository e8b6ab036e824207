"""Column profiles taken in one pass over the data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Labels = tuple[str, ...]


@dataclass(frozen=True)
class Counts:
    """Aggregates over a table, and the lines that their one row stands up to.

    The row may come from an aggregate (``over``) or from metrics observed while the
    table is written (``lines_of``).
    """

    aggregates: list[Column]
    lines: Column

    def over(self, df: DataFrame) -> DataFrame:
        return self.lines_of(df.agg(*self.aggregates))

    def lines_of(self, row: DataFrame) -> DataFrame:
        return row.select(self.lines)


def _counts(
    columns: Sequence[tuple[Labels, Column, T.DataType]],
    names: Sequence[str],
    sentinel: str,
) -> Counts:
    counts = [F.count(F.lit(1)).alias("__rows")]
    cells: list[Column] = []
    for i, (labels, column, dtype) in enumerate(columns):
        counts.append(F.count(column).alias(f"__filled_{i}"))
        cells += [F.lit(label) for label in (*labels, dtype.simpleString())]
        cells.append(F.col("__rows") - F.col(f"__filled_{i}"))
        if isinstance(dtype, T.StringType):
            counts.append(F.count(F.when(column == sentinel, 1)).alias(f"__sentinel_{i}"))
            cells.append(F.col(f"__sentinel_{i}"))
        else:
            cells.append(F.lit(0).cast("long"))
    lines = F.stack(F.lit(len(columns)), *cells)
    return Counts(counts, lines.alias(*names, "type", "nulls", "sentinels"))


def profile_columns(df: DataFrame, sentinel: str = "N/A") -> DataFrame:
    """Null and sentinel counts per column: (column, type, nulls, sentinels).

    One aggregate over one scan. Only text can hold the sentinel.
    """
    columns = [((f.name,), F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    return _counts(columns, ["column"], sentinel).over(df)


def stage_counts(df: DataFrame, stages: Sequence[str], sentinel: str = "N/A") -> Counts:
    """What ``profile_stages`` counts, for a table that is read for another reason too."""
    columns = [
        ((stage, f.name), F.col(stage)[f.name], f.dataType)
        for stage in stages
        for f in df.schema[stage].dataType.fields
    ]
    return _counts(columns, ["stage", "column"], sentinel)


def profile_stages(df: DataFrame, stages: Sequence[str], sentinel: str = "N/A") -> DataFrame:
    """Profile several states of the same rows in one scan.

    Each stage is a struct column holding the row as it was at that point. The
    result has one row per stage and column.
    """
    return stage_counts(df, stages, sentinel).over(df)

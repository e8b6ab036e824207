"""Repeated business keys: finding, keeping one row, setting the copies aside.

Nothing here windows over a key: a survivor is a ``min`` or ``max`` that
combines before the shuffle, and copies are found by a join that spreads hot
keys, so a key that holds a third of the table still fits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curate.operators.skew import count_rows_by, join_unique

REASON = "reason"
REPEATED = "repeated key"
MISSING = "missing key"


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their count. Null counts as a key."""
    return count_rows_by(df, [key], "count").filter(F.col("count") > 1)


def rows_with_repeated_keys(
    df: DataFrame, key: str, repeated: DataFrame | None = None
) -> DataFrame:
    """Every row that carries a repeated key, the key as first column.

    ``repeated`` is the result of :func:`repeated_keys` where it is at hand.
    """
    keyed = df.filter(F.col(key).isNotNull())
    if repeated is None:
        repeated = repeated_keys(keyed, key)
    else:
        repeated = repeated.filter(F.col(key).isNotNull())
    rest = [c for c in df.columns if c != key]
    rows = join_unique(
        keyed,
        repeated.select(key),
        [key],
        "left_semi",
        counts=repeated,
        count="count",
    )
    return rows.select(key, *rest)


def keep_one(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: Sequence[str] = (),
    keep: str = "first",
) -> DataFrame:
    """One row per key: the first (or last) by ``order_by``.

    The remaining columns break ties in table order, so the choice is the same
    on every run up to identical rows. Null keys form one group.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    order = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order + rest:
        return df.distinct()
    pick = F.min if keep == "first" else F.max
    kept = df.groupBy(*keys).agg(pick(F.struct(*order, *rest)).alias("__kept"))
    return kept.select(*keys, "__kept.*").select(*df.columns)


def split_duplicates(
    df: DataFrame,
    key: str,
    order_by: Sequence[str] = (),
    null_keys: str = "quarantine",
) -> tuple[DataFrame, DataFrame]:
    """Split into (main, quarantine).

    Main has one row per key; the quarantine has every copy of a repeated key,
    the survivor too. Rows without a key go to the quarantine, which then says
    why in a ``reason`` column. With ``null_keys="collapse"`` they are treated
    as copies of one key in main, are left out of the quarantine, and there is
    no ``reason``.
    """
    if null_keys == "collapse":
        return keep_one(df, key, order_by), rows_with_repeated_keys(df, key)
    if null_keys != "quarantine":
        raise ValueError(f"null_keys must be 'quarantine' or 'collapse', not {null_keys!r}")
    keyed = df.filter(F.col(key).isNotNull())
    return keep_one(keyed, key, order_by), label_quarantine(
        rows_with_repeated_keys(keyed, key), df, key
    )


def label_quarantine(copies: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """Copies and rows without a key, each with its reason.

    A table that has a column of that name already is refused.
    """
    if REASON in df.columns:
        raise ValueError(f"the table has a column {REASON!r} of its own; rename it first")
    missing = df.filter(F.col(key).isNull()).withColumn(REASON, F.lit(MISSING))
    return copies.withColumn(REASON, F.lit(REPEATED)).unionByName(missing)

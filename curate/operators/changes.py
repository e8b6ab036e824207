"""Incremental loads: what is new, what changed, and what held when.

An extension: incremental loading, upsert by business key, history of changes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curate.operators.dedup import keep_one
from curate.operators.ranges import RANGE, by_ranges, last_known
from curate.operators.skew import HotLimits, has_hot_keys, join_unique
from curate.sinks.files import write_parquet


def new_rows(incoming: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Incoming rows whose key the target does not hold yet.

    A row without a key matches nothing, so it is always new.
    """
    known = target.select(key).dropna().distinct()
    return join_unique(incoming, known, [key], "left_anti")


def classify_changes(incoming: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Incoming rows with an ``action``: new, changed or same.

    The target has one row per key and the columns of the incoming table. Rows
    are compared null-safe on all columns but the key.
    """
    values = [c for c in incoming.columns if c != key]
    held = target.select(key, F.struct(*values).alias("__held"))
    joined = join_unique(incoming, held, [key], "left")
    action = (
        F.when(F.col("__held").isNull(), "new")
        .when(F.struct(*values) == F.col("__held"), "same")
        .otherwise("changed")
    )
    return joined.select(key, *values, action.alias("action"))


def upsert(incoming: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """The target after inserting new keys and replacing held ones.

    Of incoming copies of one key the first stays, as in ``keep_one``; rows
    without a key are added as they are.
    """
    incoming = incoming.select(*target.columns)
    keyed = keep_one(incoming.filter(F.col(key).isNotNull()), key)
    keyless = incoming.filter(F.col(key).isNull())
    kept = join_unique(target, keyed.select(key), [key], "left_anti")
    return kept.unionByName(keyed).unionByName(keyless)


def write_upsert(incoming: DataFrame, target: DataFrame, key: str, path: str) -> DataFrame:
    """Write the merged table to a fresh folder and read it back.

    The folder must not exist yet, so a target is never written over while it is
    read; point readers to the new folder once this returns. A second run adds
    the rows without a key once more.
    """
    write_parquet(upsert(incoming, target, key), path, mode="errorifexists")
    return target.sparkSession.read.schema(target.schema).parquet(path)


def history(
    versions: DataFrame,
    key: str,
    at: str,
    values: Sequence[str],
    coarse: Column | None = None,
    limits: HotLimits | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Validity intervals: (key, values..., valid_from, valid_to).

    Versions of a key with the same time are reduced to one, and a version
    equal to the one before it opens no interval. The last interval is open. Rows
    without a key are the history of one more key. Where a key is hot, which is
    measured, versions are dealt out by ranges of key and time and linked from
    range to range; ``coarse`` cuts histories into steps of its own instead.
    """
    one = keep_one(versions.select(key, at, *values), [key, at]).select(
        key, at, F.struct(*values).alias("__state")
    )
    unlike = F.col("__before").isNull() | (F.col("__before") != F.col("__state"))
    if coarse is None and not has_hot_keys(versions, [key], limits):
        in_time = Window.partitionBy(key).orderBy(at)
        changes = one.withColumn("__before", F.lag("__state").over(in_time)).filter(unlike)
        ends = changes.withColumn("__after", F.lead(at).over(in_time))
    else:
        if coarse is None:
            one, coarse = by_ranges(one, [key, at], ranges), F.col(RANGE)
        changes = _previous(one, key, at, "__state", coarse).filter(unlike)
        ends = _next(changes.drop("__before"), key, at, coarse)
    return ends.select(
        key, "__state.*", F.col(at).alias("valid_from"), F.col("__after").alias("valid_to")
    )


def merge_history(
    held: DataFrame,
    versions: DataFrame,
    late: DataFrame,
    key: str,
    at: str,
    values: Sequence[str],
    limits: HotLimits | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """The intervals ``held`` of ``versions`` after ``late`` versions of any time came in.

    Keys without a late version keep their intervals as they are; for the others, null
    included, the intervals are found anew from all their versions. Intervals alone
    would not do: a version that repeated the state before it opened none, but counts
    once a late one comes between.
    """
    touched = late.select(F.struct(key).alias("__key")).distinct()
    columns = [key, at, *values]

    def of_touched(df: DataFrame, how: str) -> DataFrame:
        marked = df.withColumn("__key", F.struct(key))  # equal on null, unlike the key itself
        return join_unique(marked, touched, ["__key"], how, limits=limits).select(*df.columns)

    again = of_touched(versions.select(*columns), "left_semi").unionByName(late.select(*columns))
    found = history(again, key, at, values, limits=limits, ranges=ranges)
    return of_touched(held.select(*found.columns), "left_anti").unionByName(found)


def as_of(
    rows: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    values: Sequence[str],
    limits: HotLimits | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """The rows with the state their key had at their time: ``values`` of the last version
    that is not later, null where there is none.

    Both tables have the columns ``key`` and ``at``. Versions of a key with the same
    time are reduced to one, as in ``history``. Rows without a key or a time have no
    state. Rows and versions are sorted together, so neither side has to fit anywhere;
    hot keys are dealt out by ranges of time.
    """
    if clash := set(values) & set(rows.columns):
        raise ValueError(f"the rows have columns {sorted(clash)} already")
    there = F.col(key).isNotNull() & F.col(at).isNotNull()
    one = keep_one(versions.filter(there).select(key, at, *values), [key, at])
    state, row = F.struct(*values), F.struct(*rows.columns)
    kind = rows.select(row.alias("row")).schema["row"].dataType
    both = one.select(
        key, at, F.lit(0).alias("__side"), F.lit(None).cast(kind).alias("__row"), state.alias("__state")
    )
    state_kind = both.schema["__state"].dataType
    nothing = F.lit(None).cast(state_kind)
    asked = rows.filter(there).select(
        key, at, F.lit(1).alias("__side"), row.alias("__row"), nothing.alias("__state")
    )
    known = last_known(
        both.unionByName(asked), [key], [at, "__side"], "__state", "__known", limits, ranges
    )
    found = known.filter(F.col("__side") == 1).select("__row.*", "__known.*")
    return found.unionByName(
        rows.filter(~there).withColumns({v: F.lit(None).cast(state_kind[v].dataType) for v in values})
    )


def _linked(df: DataFrame, per_step: DataFrame, key: str) -> DataFrame:
    step = F.struct(key, "__step").alias("__link")
    return df.withColumn("__link", step).join(per_step, "__link").drop("__link")


def _previous(df: DataFrame, key: str, at: str, value: str, coarse: Column) -> DataFrame:
    """Add the value before each row as ``__before``, step by step."""
    stepped = df.withColumn("__step", coarse)
    steps = stepped.groupBy(key, "__step").agg(F.max(F.struct(at, value)).alias("__last"))
    by_step = Window.partitionBy(key).orderBy("__step")
    carried = steps.select(
        F.struct(key, "__step").alias("__link"),
        F.lag(F.col("__last")[value]).over(by_step).alias("__carried"),
    )
    in_step = Window.partitionBy(key, "__step").orderBy(at)
    local = stepped.withColumn("__local", F.lag(value).over(in_step))
    return (
        _linked(local, carried, key)
        .withColumn("__before", F.coalesce("__local", "__carried"))
        .drop("__step", "__local", "__carried")
    )


def _next(df: DataFrame, key: str, at: str, coarse: Column) -> DataFrame:
    """Add the time after each row as ``__after``, step by step."""
    stepped = df.withColumn("__step", coarse)
    steps = stepped.groupBy(key, "__step").agg(F.min(at).alias("__first"))
    by_step = Window.partitionBy(key).orderBy("__step")
    carried = steps.select(
        F.struct(key, "__step").alias("__link"),
        F.lead("__first").over(by_step).alias("__carried"),
    )
    in_step = Window.partitionBy(key, "__step").orderBy(at)
    local = stepped.withColumn("__local", F.lead(at).over(in_step))
    return (
        _linked(local, carried, key)
        .withColumn("__after", F.coalesce("__local", "__carried"))
        .drop("__step", "__local", "__carried")
    )

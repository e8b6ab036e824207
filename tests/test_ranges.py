"""Operators over ranges of groups that no task could hold, against plain versions."""

from __future__ import annotations

import datetime
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from curate import operators as op
from curate.operators import ranges as rg
from tests.test_analytics import brute_running_max
from tests.test_changes import brute_history

HOT = op.HotLimits(rows=0, parts=100)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize(("order", "ranges"), [("int", None), ("double", 1), ("string", 7), ("date", 20)])
def test_running_max_of_a_hot_group_by_any_order(spark, order, ranges):
    pick = random.Random(3)
    make = {
        "int": int, "double": lambda i: i / 3, "string": lambda i: f"{i:02d}",
        "date": lambda i: datetime.date(2024, 1, 1) + datetime.timedelta(days=i),
    }[order]
    rows = [
        (pick.choice(["hot", "hot", "hot", "b", None]), pick.choice([None, *map(make, range(30))]),
         pick.choice([None, *map(float, range(60))]))
        for _ in range(400)
    ]
    df = spark.createDataFrame(rows, f"p string, o {order}, v double")
    found = op.running_max(df, ["p"], "o", "v", "m", limits=HOT, ranges=ranges)
    assert bag(found) == brute_running_max(rows)


def test_no_range_is_far_above_the_mean(spark):
    """Rows of one group, dealt out evenly whatever the group."""
    df = spark.range(100_000).select(F.lit("one").alias("g"), (F.col("id") * 7 % 100_000).alias("o"))
    sizes = [r["count"] for r in rg.by_ranges(df, ["g", "o"], 16).groupBy(rg.RANGE).count().collect()]
    assert sum(sizes) == 100_000 and len(sizes) == 16 and max(sizes) < 2 * sum(sizes) / 16


def brute_top(rows, n):
    out = Counter()
    for group in {g for g, _, _ in rows}:
        mine = [r for r in rows if r[0] == group]
        mine.sort(key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        out.update((*r, i) for i, r in enumerate(mine[:n], 1))
    return out


@pytest.mark.parametrize("n", [20, 10_000])
def test_top_n_beyond_the_group_limit(spark, n):
    pick = random.Random(n)
    rows = [
        (pick.choice(["hot", "hot", "b", None]), pick.choice([None, *range(12)]), i) for i in range(600)
    ]
    df = spark.createDataFrame(rows, "g string, v int, id int")
    found = rg.top_of_large_groups(df, ["g"], "v", n, ["id"], "rank", 9)
    assert bag(found) == brute_top(rows, n)


def test_top_n_takes_the_way_that_fits_n(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("g"), "id")
    few, many = (op.top_n_per_group(df, ["g"], "id", n, ranges=8) for n in (1000, 1001))
    assert (few.count(), many.count()) == (2000, 2002)
    assert "WindowGroupLimit" in few._jdf.queryExecution().executedPlan().toString()
    assert many.agg(F.max("rank")).first()[0] == 1001


def test_top_n_of_rows_that_are_all_tied(spark):
    df = spark.range(5000).select(F.lit(1).alias("g"), F.lit(2).alias("v"), "id")
    found = rg.top_of_large_groups(df, ["g"], "v", 2000, [], "rank", 8)
    assert sorted(r["rank"] for r in found.collect()) == list(range(1, 2001))
    empty = rg.top_of_large_groups(df.limit(0), ["g"], "v", 2000, [], "rank")
    assert empty.count() == 0


@pytest.mark.parametrize("limits", [None, HOT])
def test_history_by_ranges(spark, limits):
    pick = random.Random(5)
    rows = [(pick.choice(["a", "a", "b", None]), pick.randint(0, 80), pick.choice("xyz")) for _ in range(300)]
    df = spark.createDataFrame(rows, "k string, at int, v string")
    found = op.history(df, "k", "at", ["v"], limits=limits, ranges=6)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(brute_history(rows), key=str)


@pytest.mark.parametrize("limits", [None, HOT])
def test_merged_history_equals_a_full_one(spark, limits):
    pick = random.Random(6)
    rows = [(pick.choice(["a", "b", "c", None]), pick.randint(0, 60), pick.choice("xy")) for _ in range(200)]
    schema = "k string, at int, v string"
    early = [r for r in rows if r[0] == "c" or pick.random() < 0.7]
    late = rows.copy()
    for r in early:
        late.remove(r)
    held = op.history(spark.createDataFrame(early, schema), "k", "at", ["v"])
    merged = op.merge_history(
        held, spark.createDataFrame(early, schema), spark.createDataFrame(late, schema),
        "k", "at", ["v"], limits=limits, ranges=5,
    )
    assert sorted(map(tuple, merged.collect()), key=str) == sorted(brute_history(rows), key=str)


def test_a_repeated_state_counts_once_a_late_one_comes_between(spark):
    schema = "k int, at int, v string"
    early = spark.createDataFrame([(1, 0, "x"), (1, 10, "x")], schema)
    late = spark.createDataFrame([(1, 5, "y")], schema)
    held = op.history(early, "k", "at", ["v"])
    assert held.count() == 1
    merged = op.merge_history(held, early, late, "k", "at", ["v"])
    assert bag(merged) == Counter([(1, "x", 0, 5), (1, "y", 5, 10), (1, "x", 10, None)])


@pytest.mark.parametrize("limits", [None, HOT])
def test_as_of_against_a_search(spark, limits):
    pick = random.Random(8)
    keys, times = ["a", "a", "a", "b", None], [None, *range(50)]
    versions = [(pick.choice(keys), pick.choice(times), pick.choice([None, "x", "y"])) for _ in range(120)]
    rows = [(i, pick.choice([*keys, "only here"]), pick.choice(times)) for i in range(300)]
    rows += rows[:5]
    want = Counter()
    for i, key, at in rows:
        seen = [
            (t, v is not None, v) for k, t, v in versions
            if key is not None and at is not None and k == key and t is not None and t <= at
        ]
        best = max((t for t, _, _ in seen), default=None)
        states = [s[1:] for s in seen if s[0] == best]
        want[(i, key, at, min(states)[1] if states else None)] += 1
    df = spark.createDataFrame(rows, "id int, k string, at int")
    states = spark.createDataFrame(versions, "k string, at int, v string")
    found = op.as_of(df, states, "k", "at", ["v"], limits=limits, ranges=7)
    assert found.columns == ["id", "k", "at", "v"]
    assert bag(found) == want
    assert bag(op.as_of(df, states.limit(0), "k", "at", ["v"])) == Counter((*r, None) for r in rows)
    with pytest.raises(ValueError, match="have columns"):
        op.as_of(df, states.withColumnRenamed("v", "id"), "k", "at", ["id"])

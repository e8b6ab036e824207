"""Repeated keys, hot keys and the staged write, against brute force."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curate import operators as op
from curate.operators import skew
from curate.operators.dedup import label_quarantine
from curate.plans import catalogue as cat

SCHEMA = "k string, a int, b string"


def key_order(row):
    """Row order with nulls first, as the survivor is chosen."""
    return tuple((v is not None, v) for v in row[1:])


def brute(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    main = Counter(min(g, key=key_order) for k, g in groups.items() if k is not None)
    copies = Counter(r for k, g in groups.items() if k is not None and len(g) > 1 for r in g)
    return main, copies, Counter(groups.get(None, []))


def bag(df):
    return Counter(tuple(r) for r in df.collect())


ROWS = st.lists(
    st.tuples(
        st.sampled_from([None, "x", "y", "z"]),
        st.sampled_from([None, 1, 2]),
        st.sampled_from([None, "p", "q"]),
    ),
    max_size=25,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS)
def test_split_equals_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    main, copies, keyless = brute(rows)
    found_main, quarantine = op.split_duplicates(df, "k")
    assert bag(found_main) == main
    assert bag(quarantine.filter("reason = 'repeated key'").drop("reason")) == copies
    assert bag(quarantine.filter("reason = 'missing key'").drop("reason")) == keyless
    collapsed, plain = op.split_duplicates(df, "k", null_keys="collapse")
    first_keyless = Counter([min(keyless, key=key_order)]) if keyless else Counter()
    assert bag(collapsed) == main + first_keyless
    assert bag(plain) == copies


def test_survivor_follows_order_by(spark):
    df = spark.createDataFrame([("x", 1, "q"), ("x", 2, "p"), ("x", 3, "p")], SCHEMA)
    assert op.keep_one(df, "k", ["b"]).first() == ("x", 2, "p")
    assert op.keep_one(df, "k", ["a"], keep="last").first() == ("x", 3, "p")
    with pytest.raises(ValueError):
        op.keep_one(df, "k", keep="any")
    with pytest.raises(ValueError):
        op.split_duplicates(df, "k", null_keys="drop")


def test_repeated_keys_count_null_as_a_key(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), ("x", 1, "a")], SCHEMA)
    assert bag(op.repeated_keys(df, "k")) == Counter({(None, 2): 1})
    assert op.rows_with_repeated_keys(df, "k").count() == 0


def test_repeated_rows_have_the_key_first(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x")], "a int, k string")
    assert op.rows_with_repeated_keys(df, "k").columns == ["k", "a"]


@pytest.fixture
def easily_hot(monkeypatch):
    """One in ten rows makes a key hot, also in a small table."""
    monkeypatch.setattr(skew, "HOT_PARTS", 10)
    monkeypatch.setattr(skew, "HOT_ROWS", 0)


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows, most others are single."""
    n = 30_000
    rows = spark.range(0, n, 1, 12).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") / 2).cast("int"))).alias("k"),
        (F.col("id") % 11).cast("int").alias("a"),
        F.col("id").cast("string").alias("b"),
    )
    return rows


def test_hot_keys_are_few_and_spread(spark, skewed, easily_hot):
    counts = skew.count_rows_by(skewed, ["k"])
    assert [tuple(r) for r in skew.hot_keys(counts, ["k"]).collect()] == [("hot", 4)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_unique_equals_the_plain_join(spark, skewed, easily_hot, how):
    right = skewed.select("k").distinct().filter(F.hash("k") % 3 != 0).withColumn("r", F.upper("k"))
    found = op.join_unique(skewed, right, ["k"], how)
    wanted = skewed.join(right, ["k"], how)
    assert sorted(found.columns) == sorted(wanted.columns)
    assert bag(found.select(*wanted.columns)) == bag(wanted)


def test_small_keys_are_never_hot(skewed):
    assert skew.hot_keys(skew.count_rows_by(skewed, ["k"]), ["k"]).count() == 0


def test_split_hot_takes_null_for_a_key(skewed, easily_hot):
    df = skewed.withColumn("k", F.when(F.col("k") != "hot", F.col("k")))
    ordinary, hot = skew.split_hot(df, ["k"])
    assert hot.count() == 10_000 and hot.filter("k is not null").count() == 0
    assert ordinary.count() == 20_000 and ordinary.columns == df.columns


def test_join_unique_refuses_joins_that_repeat_the_right_side(skewed):
    with pytest.raises(ValueError):
        op.join_unique(skewed, skewed, ["k"], "full")


def test_hot_rows_reach_several_tasks(spark, skewed, easily_hot):
    """After the spread no partition of the join holds the whole hot key."""
    right = skewed.select("k").distinct().withColumn("r", F.lit(1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = op.join_unique(skewed, right, ["k"]).filter("k = 'hot'")
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r["count"] for r in sizes) == 10_000
    assert len(sizes) > 1


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("null_keys", ["quarantine", "collapse"])
def test_staged_write_equals_the_split(
    spark, skewed, tmp_path, monkeypatch, easily_hot, small, null_keys
):
    monkeypatch.setattr(cat, "fits_broadcast", lambda df: small)
    df = skewed.withColumn("k", F.when(F.col("b") % 7 != 0, F.col("k")))
    main, quarantine = str(tmp_path / "main"), str(tmp_path / "quarantine")
    cat.write_split(df, "k", main, quarantine, null_keys=null_keys)
    wanted_main, wanted_quarantine = op.split_duplicates(df, "k", null_keys=null_keys)
    found = spark.read.parquet(quarantine)
    assert bag(spark.read.parquet(main).select(*wanted_main.columns)) == bag(wanted_main)
    assert bag(found.select(*wanted_quarantine.columns)) == bag(wanted_quarantine)


def test_staged_write_replaces_an_old_quarantine(spark, tmp_path):
    main, quarantine = str(tmp_path / "main"), str(tmp_path / "quarantine")
    twice = spark.createDataFrame([("x", 1, "a"), ("x", 2, "b")], SCHEMA)
    once = spark.createDataFrame([("x", 1, "a")], SCHEMA)
    cat.write_split(twice, "k", main, quarantine)
    assert spark.read.parquet(quarantine).count() == 2
    cat.write_split(once, "k", main, quarantine)
    assert spark.read.parquet(quarantine).count() == 0
    assert spark.read.parquet(main).count() == 1


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("rows", [0, 1, 3])
def test_staged_write_of_small_tables_counts_every_row(spark, tmp_path, monkeypatch, small, rows):
    """No unique row, no row at all: the main folder is there with its columns."""
    monkeypatch.setattr(cat, "fits_broadcast", lambda df: small)
    main, quarantine = str(tmp_path / "main"), str(tmp_path / "quarantine")
    df = spark.createDataFrame([("x", i, None) for i in range(rows)], SCHEMA)
    total = [F.count("*").alias("n"), F.count_if(F.col("b").isNull()).alias("empty")]
    for _ in range(2):
        split = cat.write_split(df, "k", main, quarantine, columns=["a", "k"], counts=total)
    assert tuple(split.counted.first()) == (rows, rows)
    written = spark.read.parquet(main)
    assert sorted(written.columns) == ["a", "k"] and written.count() == min(rows, 1)
    assert spark.read.parquet(quarantine).count() == (rows if rows > 1 else 0)
    assert {p.name for p in tmp_path.iterdir()} == {"main", "quarantine"}


def test_a_stopped_split_leaves_the_old_main_table(spark, tmp_path, monkeypatch):
    main, quarantine = str(tmp_path / "main"), str(tmp_path / "quarantine")
    cat.write_split(spark.createDataFrame([("x", 1, "a")], SCHEMA), "k", main, quarantine)
    monkeypatch.setattr(cat, "keep_one", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        cat.write_split(spark.createDataFrame([("y", 1, "a")], SCHEMA), "k", main, quarantine)
    assert [r.k for r in spark.read.parquet(main).collect()] == ["x"]


def test_fits_broadcast_measures_rows_and_bytes(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("text"))
    assert skew.fits_broadcast(df)
    assert not skew.fits_broadcast(df, max_rows=99)
    assert not skew.fits_broadcast(df, max_bytes=100_000)


def test_label_quarantine_names_the_reason(spark):
    df = spark.createDataFrame([(None, 1, "a"), ("x", 1, "a")], SCHEMA)
    labelled = label_quarantine(df.filter("k = 'x'"), df, "k")
    assert {(r.k, r.reason) for r in labelled.collect()} == {
        ("x", "repeated key"), (None, "missing key"),
    }


def test_a_reason_column_of_its_own_is_refused(spark):
    df = spark.createDataFrame([("x", "mine")], "k string, reason string")
    with pytest.raises(ValueError, match="reason"):
        op.split_duplicates(df, "k")

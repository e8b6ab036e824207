"""Contracts, profiles, cleaning and rules."""

from __future__ import annotations

import datetime
import logging
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curate import operators as op


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [
            ("a", "N/A", 1869, None),
            ("b", None, 1870, datetime.date(2000, 1, 1)),
            ("a", "x", 2026, None),
            (None, "N/A", 2027, None),
            (None, "y", None, None),
        ],
        "id string, note string, year int, day date",
    )


def test_check_layout(rows, caplog):
    assert op.check_layout(rows, ["id", "note", "year", "day"]) is rows
    with pytest.raises(ValueError, match="extra_one"):
        op.check_layout(rows, ["id", "extra_one"])
    with caplog.at_level(logging.WARNING):
        op.check_layout(rows, ["id", "note"])
    assert "day" in caplog.text and "year" in caplog.text


def test_schema_report(rows):
    found = [tuple(r) for r in op.schema_report(rows).orderBy("position").collect()]
    assert found[2] == (2, "year", "int", True)
    assert len(found) == 4


def test_profile_counts_the_sentinel_in_text_only(rows):
    found = {r["column"]: (r["type"], r.nulls, r.sentinels) for r in op.profile_columns(rows).collect()}
    assert found == {
        "id": ("string", 2, 0), "note": ("string", 1, 2), "year": ("int", 1, 0), "day": ("date", 4, 0),
    }


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([None, "N/A", "x"]), st.sampled_from([None, 1])), max_size=20))
def test_profile_equals_a_row_by_row_count(spark, values):
    df = spark.createDataFrame(values, "a string, b int")
    found = {r["column"]: (r.nulls, r.sentinels) for r in op.profile_columns(df).collect()}
    assert found["a"] == (sum(a is None for a, _ in values), sum(a == "N/A" for a, _ in values))
    assert found["b"] == (sum(b is None for _, b in values), 0)


def test_sentinels_and_defaults(rows):
    cleaned = op.fill_defaults(op.sentinel_to_null(rows, ["note"]), {"note": "0", "year": "text"})
    assert [r.note for r in cleaned.collect()] == ["0", "0", "x", "0", "y"]
    assert cleaned.filter(F.col("year").isNull()).count() == 1
    twice = op.fill_defaults(op.sentinel_to_null(cleaned, ["note"]), {"note": "0"})
    assert twice.collect() == cleaned.collect()


def test_rules(rows):
    rules = [
        op.rule_range("year", 1870, 2026),
        op.rule_not_null("id"),
        op.rule_unique("id"),
        op.rule_matches("note", "^[a-z]$"),
        op.rule_in_set("note", ["N/A", "x"]),
    ]
    found = {r["rule"]: (r.failed_rows, r.status) for r in op.check_rules(rows, rules).collect()}
    assert found == {
        "range": (2, "warn"), "not_null": (2, "warn"), "unique": (2, "warn"),
        "matches": (2, "warn"), "in_set": (1, "warn"),
    }


def test_reference_rule_passes_null(spark, rows):
    known = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    found = op.check_rules(rows, [op.rule_references("id", known, "k")]).first()
    assert (found.failed_rows, found.status) == (1, "warn")


def test_log_rules(rows, caplog):
    with caplog.at_level(logging.INFO):
        op.log_rules(op.check_rules(rows, [op.rule_not_null("id"), op.rule_range("year", 0, 9999)]))
    assert "not_null(id): 2 failed" in caplog.text
    assert "range(year): OK" in caplog.text


def test_no_rules_is_an_error(rows):
    with pytest.raises(ValueError):
        op.check_rules(rows, [])


def test_mean_clamp_flag_audit(spark):
    df = spark.createDataFrame([(1, -2.0), (2, None), (3, 6.0)], "id int, v double")
    filled = op.fill_with_mean(df, "v", "was_null")
    assert [tuple(r) for r in filled.orderBy("id").collect()] == [
        (1, -2.0, False), (2, 2.0, True), (3, 6.0, False),
    ]
    clamped = op.clamp_negative(df, "v").select("id", "v").orderBy("id")
    assert [r.v for r in clamped.collect()] == [0.0, None, 6.0]
    flagged = op.with_flag(df, "high", F.col("v") > 5).orderBy("id")
    assert [r.high for r in flagged.collect()] == [False, False, True]
    assert op.with_audit_time(df).filter(F.col("loaded_at").isNotNull()).count() == 3


def test_clamping_keeps_the_type(spark):
    df = spark.sql("select cast(v as decimal(20,2)) as v from values ('12345678901234567.25'), ('-1'), (null) t(v)")
    clamped = op.clamp_negative(df, "v")
    assert clamped.schema == df.schema
    assert {r.v for r in clamped.collect()} == {Decimal("12345678901234567.25"), Decimal(0), None}


def test_a_reference_rule_counts_rows_not_values(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "k int")
    known = spark.createDataFrame([(2,), (2,), (None,)], "k int")
    found = op.check_rules(df, [op.rule_references("k", known, "k")]).first()
    assert (found.failed_rows, found.status) == (3, "warn")
    none = op.check_rules(df.limit(0), [op.rule_references("k", known, "k")]).first()
    assert (none.failed_rows, none.status) == (0, "ok")

"""Parsers and nested functions on hand-made edge texts."""

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from curate import functions as fn

INTS = {
    "74": 74, " 7 ": 7, "-3": -3, "+4.2": 4, "85.5": 85, "85.": 85, ".5": 0, "-.": 0,
    "\t8\n": 8, "8.9\t": 8, "2147483647": 2147483647, "-2147483648": -2147483648,
    "000000000000012": 12, "2147483647.99": 2147483647, "2147483648": None, "1999–2003": None,
    "N/A": None, "": None, "+": None, "1e3": None, "1,2": None, "2923706026": None,
    "99999999999999999999": None, "1.2.3": None, None: None,
}


def parsed(spark, texts, function):
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    return {r.t: r.v for r in rows.select("t", function(F.col("t")).alias("v")).collect()}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_to_int(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert parsed(spark, INTS, fn.to_int) == INTS
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_to_int_agrees_with_the_lenient_cast(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert parsed(spark, INTS, lambda c: c.cast("int")) == INTS
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize(
    ("function", "expected"),
    [
        (fn.to_decimal, {"8.75": Decimal("8.8"), "8.6": Decimal("8.6"), "100": None, "N/A": None}),
        (lambda c: fn.to_decimal(c, 10, 2), {"100": Decimal("100.00"), "x1": None}),
        (fn.to_double, {"1.5": 1.5, "1e3": 1000.0, "N/A": None, "-Infinity": float("-inf")}),
        (
            fn.to_date_strict,
            {
                "25 May 1977": datetime.date(1977, 5, 25), "5 May 1977": None,
                "25 December 1977": None, "25 May 1977 x": None, "31 Feb 1977": None, "N/A": None,
            },
        ),
        (fn.to_iso_date, {"2026-01-02": datetime.date(2026, 1, 2), "x": None}),
        (lambda c: fn.parse_unit(c, " min"), {"121 min": 121, "121": 121, "N/A": None}),
        (lambda c: fn.parse_unit(c, "%"), {"93%": 93, None: None}),
        (fn.parse_grouped_int, {"1,234,567": 1234567, "12": 12, "N/A": None}),
        (lambda c: fn.parse_money(c, "EUR "), {"EUR 1,200": 1200, "RUE 7": None}),
        (fn.parse_money, {"$460,998,507": 460998507, "0": 0, "$2,923,706,026": None}),
        (fn.parse_score, {"74/100": Decimal("74.0"), "8.1/10": Decimal("8.1"), "100/100": None, "0": Decimal("0.0")}),
        (fn.score_text, {"8.1/10": "8.1", "N/A": "N"}),
        (fn.strip_list_markup, {"['A', 'B']": "A, B", "A": "A"}),
        (fn.split_list, {"['A', 'B']": ["A", "B"], "[]": [], None: None}),
        (fn.launch_year, {"1999–2003": 1999, "1977": 1977, "N/A": None, "77": None}),
    ],
)
def test_parsers(spark, function, expected):
    assert parsed(spark, expected, function) == expected


def test_ms_to_minutes(spark):
    row = spark.range(1).select(fn.ms_to_minutes(F.lit(90000.0)).alias("v")).first()
    assert row.v == 1.5


ENTRIES = [
    (1, [("a", "1"), ("b", "2")]),
    (2, [("a", "first"), ("a", "second")]),
    (3, []),
    (4, None),
    (5, [("c", None)]),
]
AS_STRUCTS = "id int, e array<struct<Source:string,Value:string>>"
AS_MAPS = "id int, e array<map<string,string>>"


@pytest.fixture(params=["structs", "maps"])
def nested(request, spark):
    if request.param == "structs":
        return spark.createDataFrame(ENTRIES, AS_STRUCTS)
    rows = [
        (i, None if e is None else [{"Source": s, "Value": v} for s, v in e]) for i, e in ENTRIES
    ]
    return spark.createDataFrame(rows, AS_MAPS)


def test_pivot_entries_takes_the_first_match(nested):
    wide = fn.pivot_entries(nested, "e", {"a": "A", "b": "B"})
    assert wide.columns == ["id", "A", "B"]
    assert [tuple(r) for r in wide.orderBy("id").collect()] == [
        (1, "1", "2"), (2, "first", None), (3, None, None), (4, None, None), (5, None, None),
    ]


def test_distinct_entry_keys(nested):
    assert {r.Source for r in fn.distinct_entry_keys(nested, "e").collect()} == {"a", "b", "c"}


def test_array_size_histogram_keeps_null_apart_from_empty(nested):
    sizes = {r["size"]: r["count"] for r in fn.array_size_histogram(nested, "e").collect()}
    assert sizes == {2: 2, 0: 1, -1: 1, 1: 1}

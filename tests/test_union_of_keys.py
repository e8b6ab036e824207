"""Columns found from the records themselves."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from curate.sources import read_json_union, records_by_union, union_of_keys


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_columns_are_the_union_of_all_keys(spark):
    df = lines(
        spark, '{"Title":"A","Year":"1999"}', '{"Title":"B","Ratings":[{"Source":"s","Value":"1"}]}',
        '{"Poster":null,"Title":"C","Ratings":[{"Source":"t","Other":2}]}',
    )
    found = records_by_union(df)
    assert found.columns == ["Poster", "Ratings", "Title", "Year"]
    assert [r.Title for r in found.collect()] == ["A", "B", "C"]
    assert found.schema["Poster"].dataType == T.StringType()
    assert [r.Ratings and r.Ratings[0].asDict() for r in found.collect()] == [
        None, {"Other": None, "Source": "s", "Value": "1"}, {"Other": 2, "Source": "t", "Value": None},
    ]


def test_records_that_disagree_give_text_and_numbers_widen(spark):
    df = lines(spark, '{"a":1,"b":1,"c":true}', '{"a":2.5,"b":"x","c":{"d":1}}', '{"a":null,"b":[1,2]}')
    got = [tuple(r) for r in records_by_union(df).collect()]
    assert [float(a) if a is not None else None for a, _, _ in got] == [1.0, 2.5, None]
    assert [(b, c) for _, b, c in got] == [("1", "true"), ("x", '{"d":1}'), ("[1,2]", None)]


def test_odd_names_and_nested_names(spark):
    df = lines(spark, '{"a.b":1,"c d":{"x`y":[{"OBJECT<":2}]},"é":"z"}')
    found = records_by_union(df)
    assert found.columns == ["a.b", "c d", "é"]
    row = found.first()
    assert (row["a.b"], row["c d"]["x`y"][0]["OBJECT<"], row["é"]) == (1, 2, "z")


def test_text_that_is_no_object(spark):
    df = lines(spark, "[1]", "nope", "", None, "3", '{"a":1}')
    assert [r.a for r in records_by_union(df).collect()] == [None] * 5 + [1]
    assert records_by_union(lines(spark, "[1]", "nope")).columns == []
    assert union_of_keys(df.limit(0)).fields == []
    with pytest.raises(ValueError, match="case alone"):
        union_of_keys(lines(spark, '{"Year":1}', '{"year":1}'))


def test_files_and_a_schema_that_is_known(spark, tmp_path):
    lines(spark, '{"a":1}', '{"b":"x"}').write.text(str(tmp_path / "r"))
    found = read_json_union(spark, str(tmp_path / "r"))
    assert sorted(map(tuple, found.collect()), key=str) == [(1, None), (None, "x")]
    known = records_by_union(lines(spark, '{"a":1,"z":5}'), schema=found.schema)
    assert known.columns == ["a", "b"] and tuple(known.first()) == (1, None)

"""Histograms of two loads and the distance between them."""

from __future__ import annotations

import logging

import pytest

from curate import operators as op
from curate.plans import catalogue as cat
from curate.sources import jdbc

COLUMNS = {"kind": None, "price": 10.0}


def load(spark, *rows):
    return spark.createDataFrame(list(rows), "kind string, price double")


def test_histograms_add_up_and_count_null(spark):
    one, two = load(spark, ("a", 5.0), ("a", None)), load(spark, ("b", -1.0), (None, 19.0))
    whole = op.histograms(one.unionByName(two), COLUMNS)
    merged = op.merge_histograms(op.histograms(one, COLUMNS), op.histograms(two, COLUMNS))
    want = {
        ("kind", "a", 2), ("kind", "b", 1), ("kind", None, 1),
        ("price", "0", 1), ("price", "-1", 1), ("price", "1", 1), ("price", None, 1),
    }
    assert {tuple(r) for r in whole.collect()} == {tuple(r) for r in merged.collect()} == want


def test_distance_and_rules(spark):
    before = op.histograms(load(spark, ("a", 1.0), ("a", 2.0), ("b", 3.0), (None, 4.0)), COLUMNS)
    after = op.histograms(load(spark, ("a", 1.0), ("c", 11.0)), COLUMNS)
    assert {tuple(r) for r in op.drift(before, after).collect()} == {("kind", 0.5), ("price", 0.5)}
    assert {tuple(r) for r in op.drift(before, before).collect()} == {("kind", 0.0), ("price", 0.0)}
    found = op.drift_rules(before, after, {"kind": 0.5, "price": 0.4}).collect()
    assert {(r["column"], r.status) for r in found} == {("kind", "ok"), ("price", "warn")}
    nothing = op.histograms(load(spark).limit(0), COLUMNS)
    assert {tuple(r) for r in op.drift_rules(before, nothing, {"kind": 1.0}).collect()} == {
        ("drift", "kind", None, "warn")
    }


def test_load_probes_before_it_reads(spark, tmp_path):
    """The folder is absent, so a failure at the probe is the only one to see."""
    with pytest.raises(Exception, match="(?i)driver|class"):
        cat.load(spark, str(tmp_path / "absent"), "jdbc:none://x", "t", driver="no.such.Driver")


def test_a_table_read_by_one_task_is_a_warning(spark, caplog):
    with caplog.at_level(logging.WARNING, logger=jdbc.__name__), pytest.raises(Exception):  # noqa: B017
        jdbc.read_jdbc(spark, "jdbc:none://x", "t", driver="no.such.Driver")
    assert "one task reads" in caplog.text
    caplog.clear()
    with caplog.at_level(logging.WARNING, logger=jdbc.__name__), pytest.raises(Exception):  # noqa: B017
        jdbc.read_jdbc(spark, "jdbc:none://x", "t", driver="no.such.Driver", num_partitions=1)
    assert "one task reads" not in caplog.text

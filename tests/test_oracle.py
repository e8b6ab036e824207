"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from curate.registry import entries
from tests.check_oracle import compare, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(entries()))
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, entries()[name]) is None


def test_every_query_has_sql():
    assert set(entries()) <= set(queries())
    assert set(entries()) <= set(oracle_sql()) <= set(queries())


def test_smoke_query_has_the_output_contract(spark):
    from curate.plans.catalogue import OUTPUT_COLUMNS

    assert tuple(entry(spark).columns) == OUTPUT_COLUMNS

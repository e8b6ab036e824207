"""Columns of the caller that are named like columns inside the operators."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from curate.llm import line_dedup, mixing, packing, quality_rules, simhash

INSIDE = (
    "__id", "__th", "__row", "__null", "__removed", "__plan", "__epoch", "__range", "__start",
    "__n", "__group", "__turn", "__text", "__order", "__bin", "__pool", "tokens", "n", "whole", "rest",
    "blocks", "quota", "target", "units", "n_tokens", "fp", "root", "best", "kept", "rows", "idx",
    "pos", "length", "key", "piece", "start", "of_lang", "of_source", "a.b",
)
ADDED = ("block", "position", "epoch")


@pytest.fixture(scope="module")
def docs(spark):
    shared = " ".join(f"w{i}" for i in range(70))
    rows = [
        (i, f"{'own ' * 3}{i}\n{shared}\n" + " ".join(f"t{i}x{j}" for j in range(60 + i)), "en", f"s{i % 3}", 9)
        for i in range(12)
    ]
    rows += [(3, None, None, None, 0), (None, rows[4][1], "en", "s1", 9), rows[5]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.concat(F.lit(f"{n}="), F.coalesce("doc_id", F.lit(-1))).alias(n) for n in INSIDE + ADDED])


def unchanged(row, names) -> bool:
    own = -1 if row.doc_id is None else row.doc_id
    return all(row[n] == f"{n}={own}" for n in names)


@pytest.mark.parametrize(
    "operator", [quality_rules.filter_documents, simhash.keep_one_per_group, mixing.realise]
)
def test_rows_pass_whole(docs, operator):
    got = operator(docs)
    rows = got.collect()
    assert got.columns == docs.columns and rows
    assert all(unchanged(r, INSIDE + ADDED) for r in rows)


def test_line_dedup_replaces_its_own_column_only(docs):
    got = line_dedup.dedup_lines(docs, whole_runs=True)
    rows = got.collect()
    assert got.columns == [c for c in docs.columns if c != "__removed"] + ["__removed"]
    assert len(rows) == docs.count()
    assert all(unchanged(r, [n for n in INSIDE + ADDED if n != "__removed"]) for r in rows)
    assert sum(bool(r["__removed"]) for r in rows) >= 11


def test_schedule_replaces_added_columns_only(docs):
    got = mixing.schedule(docs.withColumn("n_tokens", F.lit(5).cast("long")))
    rows = got.collect()
    passed = [c for c in docs.columns if c not in ADDED]
    assert got.columns == passed + ["epoch", "block", "position"]
    assert all(unchanged(r, [n for n in INSIDE if n != "n_tokens"]) for r in rows)
    assert all(isinstance(r.block, int) and isinstance(r.epoch, int) for r in rows)


def test_operators_that_take_columns_ignore_others(docs):
    n = docs.count()
    assert simhash.near_duplicates(docs).count() == n
    assert quality_rules.quality_verdicts(docs).count() == n
    assert mixing.mix_documents(docs).select("doc_id").distinct().count() == 13
    assert packing.pack_documents(docs).select("doc_id").distinct().count() == 13

"""Benchmark decontamination against a search for all stretches."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from curate.llm import decontamination, registry

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text) -> list[str]:
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(rows, items, window=10) -> set[tuple]:
    stretches: dict[tuple, set[str]] = {}
    for name, text in items:
        words = words_of(text)
        k = min(window, len(words))
        for i in range(len(words) - k + 1 if k else 0):
            stretches.setdefault(tuple(words[i : i + k]), set()).add("" if name is None else str(name))
    out = []
    for key, text in rows:
        words, hit, names = words_of(text), set(), set()
        for k in range(1, window + 1):
            for i in range(len(words) - k + 1):
                if found := stretches.get(tuple(words[i : i + k])):
                    hit |= set(range(i, i + k))
                    names |= found
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((key, len(words), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=str)


def made(seed: int):
    rng = random.Random(seed)
    letters = ["a", "b", "C", "é", "7", "Zz"]
    items = [(i, " ".join(rng.choices(letters, k=rng.randint(0, 25)))) for i in range(30)]
    items += [(None, "a a a b b b a a a b b b"), (3, items[5][1]), (40, None), (41, "!?"), (42, items[6][1])]
    rows = []
    for i in range(80):
        words = rng.choices([*letters, "q", "r"], k=rng.randint(0, 60))
        if rng.random() < 0.6:
            words[rng.randint(0, len(words)) :] += (rng.choice(items)[1] or "").split()
        rows.append((i, rng.choice([" ", "-", ". "]).join(words)))
    rows += [(None, rows[0][1]), (5, rows[5][1]), (90, None), (91, "")]
    return rows, items


@pytest.mark.parametrize(("seed", "block_bytes", "segment_words"), [(1, 1 << 21, 5000), (2, 900, 5000), (3, 1200, 3)])
def test_hits_equal_a_search_for_all_stretches(spark, monkeypatch, seed, block_bytes, segment_words):
    rows, items = made(seed)
    whole = decontamination.item_segments
    monkeypatch.setattr(
        decontamination, "item_segments", lambda *a, **k: whole(*a, **k, segment_words=segment_words)
    )
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contamination(docs, tests, block_bytes=block_bytes).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows, items)


def test_query_equals_a_search_on_the_smallest_tables(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    got = registry.op13_decontamination(spark, sf).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows, items)


def test_coverage_sets_the_limit_of_short_items(spark):
    docs = spark.createDataFrame([(1, "x one two three y"), (2, "two three four")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "one two three four")], "item_id long, text string")
    hits = lambda c: {r.doc_id: r.n_hit for r in decontamination.scan_documents(docs, items, coverage=c).collect()}
    assert hits(1.0) == {1: 0, 2: 0}
    assert hits(0.75) == {1: 3, 2: 3}


def test_spans_are_cut_and_columns_pass(spark):
    schema = "doc_id long, text string, spans string, row int, __id string"
    long = "word " * 50_000
    rows = [(1, "Keep this. One, TWO three! And this", "s", 1, "i"), (2, None, None, None, None), (3, long, "s", 2, "j"), (3, long, "s", 2, "j")]
    items = spark.createDataFrame([(7, "one two three")], "item_id long, text string")
    got = decontamination.decontaminate(spark.createDataFrame(rows, schema), items)
    assert got.columns == ["doc_id", "text", "spans", "row", "__id"]
    assert sorted(map(str, got.collect())) == sorted(map(str, spark.createDataFrame(
        [(1, "Keep this. ! And this", "s", 1, "i"), *rows[1:]], schema).collect()))


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in decontamination.contamination(docs, items).collect()] == [0]
    assert decontamination.contamination(docs.limit(0), items).count() == 0
    assert decontamination.decontaminate(docs, items).collect() == docs.collect()

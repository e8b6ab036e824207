"""Periodic runs against a search over all periods."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from curate.llm import periodic_runs, registry


def plain_runs(x: list) -> list[tuple[int, int, int]]:
    n, out = len(x), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and x[j] == x[j + q]:
                j += 1
            run = x[i : j + q]
            if len(run) >= max(6, 4 * q) and all(
                any(run[k] != run[k + p] for k in range(len(run) - p)) for p in range(1, q)
            ):
                out.append((i, len(run), q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(key, text) -> tuple:
    words = (text or "").encode().split()
    n = len(words)
    if key is not None and n and (h := zlib.crc32(str(key).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    left = b" ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return (
        key, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest(),
    )


def periodic_texts(seed: int, many: int) -> list[str]:
    rng = random.Random(seed)
    texts = []
    for _ in range(many):
        words = [str(rng.randrange(rng.choice([2, 4, 50]))) for _ in range(rng.randint(0, 150))]
        for _ in range(rng.randint(0, 3)):
            if len(words) > 10:
                a = rng.randrange(len(words))
                p = rng.randint(1, max(1, (len(words) - a) // 3))
                for i in range(a + p, rng.randint(a, len(words))):
                    words[i] = words[i - p]
        texts.append(rng.choice([" ", "\t", "\n "]).join(words))
    return texts


def test_transform_is_exact():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, periodic_runs.PRIME, (3, 64)).astype(np.uint64)
    assert (periodic_runs._backward(periodic_runs._forward(rows)) == rows).all()
    x = rng.integers(0, 2, 400).astype(np.uint64)
    block, distance = periodic_runs.zero_mismatches(np.concatenate([x, np.arange(9, 9 + 64, dtype=np.uint64)]), np.arange(40), 8)
    want = {(b, d) for b in range(40) for d in range(8, 16) if 8 * b + 8 + d <= 400
            and (x[8 * b : 8 * b + 8] == x[8 * b + d : 8 * b + 8 + d]).all()}
    assert {(b, d) for b, d in zip(block.tolist(), distance.tolist(), strict=True)} >= want
    assert {(b, d) for b, d in zip(block.tolist(), distance.tolist(), strict=True) if 8 * b + 8 + d <= 400} == want


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_a_search_over_all_periods(seed):
    for text in periodic_texts(seed, 120):
        words = [int(w) for w in text.split()]
        assert periodic_runs.find_runs(np.array(words, dtype=np.int64)) == plain_runs(words)


def test_long_periods_and_constant_texts():
    x = np.concatenate([np.arange(500), np.arange(9000) % 2001 + 500, np.arange(10000, 10300)])
    assert periodic_runs.find_runs(x) == [(500, 9000, 2001)]
    assert periodic_runs.find_runs(np.zeros(5000, dtype=np.int64)) == [(0, 5000, 1)]
    assert periodic_runs.find_runs(np.zeros(5, dtype=np.int64)) == []
    with pytest.raises(ValueError):
        periodic_runs.find_runs(x, periods=3)


def test_query_equals_the_plain_version(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(periodic_texts(7, 150))]
    rows += [(None, "a a a a a a a b"), (151, None), (152, ""), (153, " \n"), (3, rows[3][1]), (3, rows[3][1])]
    rows += [(154, "tick tock " * 20_000 + "end")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(str, map(tuple, registry.op12_periodic_runs(spark, str(tmp_path)).collect())))
    small = [plain_row(*r) for r in rows[:-1]]
    left = hashlib.sha256(b"tick tock end").hexdigest()
    assert zlib.crc32(b"154") % 10
    small.append((154, 1, 0, 40_000, 2, 20_000_000, hashlib.sha256(b"0,40000,2\n").hexdigest(), left))
    assert got == sorted(map(str, small))


def test_query_on_the_smallest_tables(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in rows if len(r.text or "") < 4000]
    got = {r.doc_id: tuple(r) for r in registry.op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(rows)
    assert all(got[r.doc_id] == plain_row(r.doc_id, r.text) for r in short)


def test_collapse_keeps_other_texts_and_columns(spark):
    schema = "doc_id long, text string, row string, runs int, key string"
    rows = [(1, "a  b", "x", 1, "k"), (2, "go " * 9 + "stop", None, 2, None), (None, None, "z", None, "k")]
    got = periodic_runs.collapse(spark.createDataFrame(rows, schema))
    assert got.columns == ["doc_id", "text", "row", "runs", "key"]
    assert {r.text for r in got.collect()} == {"a  b", "go stop", None}
    empty = spark.createDataFrame([], schema)
    assert periodic_runs.collapse(empty).count() == periodic_runs.run_report(empty).count() == 0

"""Stages of the pipeline against brute force on small tables."""

from __future__ import annotations

import zlib
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from curate.llm import mixing, simhash
from curate.llm.tokenization import END_ID, encoder, vocabulary_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts):
    rows = [(i, t, "en", f"s{(i or 0) % 3}", len(t or "")) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def edited(rng, words, times):
    out = list(words)
    for at in rng.choice(len(words), times, replace=False):
        out[at] = f"new{rng.integers(10**9)}"
    return out


def plain_fingerprint(text):
    """Bit by bit, as the contract of op6_simhash says it."""
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(texts):
    """Smallest id of each component of all pairs at two bits or fewer, by brute force."""
    prints = {i: plain_fingerprint(t) for i, t in texts}
    root = {i: i for i in prints}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                low, high = sorted((top(a), top(b)))
                root[high] = low
    return {i: top(i) for i in prints}, prints


@pytest.fixture(scope="module")
def near_texts():
    rng = np.random.default_rng(3)
    texts = []
    for base in range(40):
        words = [f"w{rng.integers(3000)}" for _ in range(int(rng.integers(60, 400)))]
        texts.append((len(texts), " ".join(words)))
        for share in (0.003, 0.01, 0.018, 0.022, 0.03, 0.05):
            copy = edited(rng, words, max(1, int(share * len(words))))
            texts.append((len(texts), " ".join(copy)))
    texts += [(len(texts), "too short"), (len(texts) + 1, "Too  SHORT"), (len(texts) + 2, "too long")]
    return texts


def test_near_duplicates_equal_brute_force(spark, near_texts):
    roots, prints = plain_components(near_texts)
    docs = documents(spark, near_texts)
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(roots.values()))
    assert len(set(roots.values())) < len(near_texts)
    got = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: (prints[i], roots[i]) for i in roots}


def test_near_duplicates_of_odd_rows(spark):
    """Null and empty texts are linked, equal rows are one, columns stay."""
    rows = [(4, None), (2, ""), (3, " \n"), (7, "a b"), (7, "a b"), (None, "a b"), (9, "word " * 60_000)]
    docs = documents(spark, rows).withColumn("fp", F.lit("x")).withColumn("root", F.lit(1))
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 7, 9]
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), "").count() == 0


def test_fingerprints_on_the_smallest_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    roots, prints = plain_components([tuple(r) for r in docs.collect()])
    got = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: (prints[i], roots[i]) for i in roots}


def test_a_stage_deletes_what_the_one_before_stored(spark, near_texts, tmp_path):
    docs = documents(spark, near_texts[:50])
    corpus_pipeline.lines(spark, docs, "").write.parquet(str(tmp_path / "1"))
    folders = list(corpus_pipeline._LEFT)
    assert any(Path(f).exists() for f in folders)
    docs = spark.read.parquet(str(tmp_path / "1"))
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert not any(Path(f).exists() for f in folders)
    assert 0 < kept.count() <= 50


def test_mixing_follows_the_schedule_of_op1(spark):
    """Skewed sources: as many reads as op1's schedule has, in its order."""
    texts = [(i, " ".join(f"t{i}x{j}" for j in range(20))) for i in range(300)]
    rows = [(i, t, "en", "big" if i < 240 else f"s{i % 6}", len(t)) for i, t in texts]
    docs = spark.createDataFrame(rows, SCHEMA)
    plan = mixing.mix_documents(docs, mixing.Mix()).orderBy("block", "position").collect()
    got = corpus_pipeline.mix(spark, docs, "").collect()
    assert [r.doc_id for r in got] == [r.doc_id for r in plan]


def test_packing_places_every_piece(spark):
    """Every id of every text is in one place, and no sequence overflows or has a gap."""
    texts = [(i, " ".join(f"p{j}" for j in range(i * 7))) for i in range(60)] + [(60, None)]
    got = corpus_pipeline.pack(spark, documents(spark, texts), "").collect()
    e, end = encoder(vocabulary_path()), np.array([END_ID], "<u4").tobytes()
    expected = {}
    for doc, text in texts:
        ids = np.array(e.tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes() + end
        expected[doc] = ids
    seen, places = {doc: 0 for doc, _ in texts}, {}
    for r in got:
        part = expected[r.doc_id][4 * r.start : 4 * (r.start + r.length)]
        assert zlib.crc32(part) == r.ids_crc32
        seen[r.doc_id] += r.length
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert seen == {doc: len(ids) // 4 for doc, ids in expected.items()}
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024

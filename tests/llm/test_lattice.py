"""Lattice scores of whole documents against a plain version, and words of all lengths."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from curate.llm import lattice
from curate.llm.tokenization import vocabulary_path

SF = "/root/testdata/sf0.001"


def plain_words(text):
    return (text or "").encode().lower().split()


def plain_word_score(word: bytes, model: lattice.Lattice) -> float:
    """Sum over all ways to cut a word, place by place."""
    own = {t: w for t, w in zip(model.texts, model.weights[258:], strict=True)}
    mark = "▁".encode()
    ways = [model.mark] + [-math.inf] * len(word)
    for end in range(1, len(word) + 1):
        found = [ways[end - 1] + model.of_bytes[word[end - 1]]]
        for start in range(max(0, end - model.longest), end):
            part = word[start:end]
            if part in own:
                found.append(ways[start] + own[part])
            if start == 0 and mark + part in own:
                found.append(own[mark + part])
        ways[end] = np.logaddexp.reduce(found)
    return ways[-1] / math.log(10)


def plain_base(rows):
    held = [zlib.crc32(str(k).encode()) % 10 == 0 if k is not None else False for k, _ in rows]
    train = Counter(w for (_, t), h in zip(rows, held, strict=True) if not h for w in plain_words(t))
    texts = held.count(False)
    total, kinds = sum(train.values()) + texts, len(train) + (texts > 0)
    spread = total + 0.1 * (kinds + 1)
    out = []
    for (key, text), h in zip(rows, held, strict=True):
        words = plain_words(text)
        base = sum(math.log10((train[w] + 0.1) / spread) for w in words) + math.log10((texts + 0.1) / spread)
        known = sum(train[w] > 0 for w in words) + (texts > 0)
        out.append((key, h, len(words) + 1, known, total, base))
    return out


@pytest.fixture(scope="module")
def rows(spark):
    found = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = [tuple(r) for r in found]
    return [*found, (None, "x\tY\x0bz ż"), (10**6, None), (10**6 + 1, " \n "), found[3], found[3]]


@pytest.mark.parametrize("head", [200_000, 40])
def test_documents_equal_a_plain_version(spark, rows, head):
    """Whether words are looked up in the workers or by the join."""
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = lattice.score_documents(docs, head_words=head, rounds=1).collect()
    order = lambda r: (r[0] is None, r[0] or 0)
    found, want = sorted(got, key=order), sorted(plain_base(rows), key=order)
    assert [tuple(r)[:5] for r in found] == [w[:5] for w in want]
    assert np.allclose([r.base_score for r in found], [w[5] for w in want], rtol=1e-9)
    learned = Counter(
        w for k, t in rows if k is None or zlib.crc32(str(k).encode()) % 10 for w in plain_words(t)
    )
    texts, first = lattice.vocabulary(vocabulary_path(lattice.PIECES))
    model = lattice.Lattice(texts, first)
    uses = np.full(len(first), lattice.PRIOR)
    for numbers, data in lattice._grouped(list(learned)):
        counts = np.array(list(learned.values()), dtype=float)[numbers]
        uses += model.expected(data, counts)
    uses[256] += sum(1 for k, _ in rows if k is None or zlib.crc32(str(k).encode()) % 10)
    model.reweigh(np.log(uses / uses.sum()))
    by_key = {r.doc_id: r.score for r in found}
    for key, text in [*rows[:40:8], *rows[-5:-2]]:
        want_score = sum(plain_word_score(w, model) for w in plain_words(text)) + model.end / math.log(10)
        assert math.isclose(by_key[key], want_score, rel_tol=1e-6, abs_tol=1e-6)


def test_many_words_of_one_length_and_a_very_long_one():
    texts, first = lattice.vocabulary(vocabulary_path(lattice.PIECES))
    model = lattice.Lattice(texts, first)
    rng = np.random.default_rng(1)
    words = [bytes(rng.integers(97, 123, 700).astype(np.uint8)) for _ in range(5000)] + [b"ab" * 25_000]
    sizes = [data.size for _, data in lattice._grouped(words)]
    assert max(sizes) <= lattice.BATCH_BYTES and sum(sizes) == 5000 * 700 + 50_000
    assert [len(n) for n, _ in lattice._grouped([b"x" * (2 * lattice.BATCH_BYTES)])] == [1]
    assert np.isfinite(model.scores(np.frombuffer(words[-1], np.uint8).reshape(1, -1))).all()


def test_words_are_split_as_the_contract_says():
    import pyarrow as pa

    texts = ["a B\x0bc", None, "", "  ", "É é\x85x y", "\n\tq\r\n"]
    words, begins = lattice.text_words(pa.array(["skipped", *texts]).slice(1))
    per_text = [words.to_pylist()[a:b] for a, b in zip(begins[:-1], begins[1:], strict=True)]
    assert per_text == [["a", "b", "c"], [], [], [], ["É", "é\x85x y"], ["q"]]


@pytest.mark.parametrize("kind", ["string", "large_string"])
@pytest.mark.parametrize("first", ["Skipped, a B", None])
def test_slices_have_the_words_of_their_own_texts(kind, first):
    """A slice without nulls, of an array with and without one."""
    import pyarrow as pa

    texts = [first, "A b", "É Cc\n", "d", " E ffff"]
    for begin in range(1, 5):
        for end in range(begin + 1, 6):
            words, begins = lattice.text_words(pa.array(texts, kind).slice(begin, end - begin))
            got = [words.to_pylist()[a:b] for a, b in zip(begins[:-1], begins[1:], strict=True)]
            assert got == [["a", "b"], ["É", "cc"], ["d"], ["e", "ffff"]][begin - 1 : end - 1]


@pytest.mark.parametrize("head", [200_000, 5])
def test_documents_beyond_the_first_group_of_a_batch(spark, head):
    """Texts of one Arrow batch that are taken up in several groups, without any null."""
    size = lattice.GROUP_BYTES // 2
    rows = [(i, f"Own{i} " + f"Word{i % 3} and some " * (size // 20) + "tail\n" * i) for i in range(1, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted(lattice.score_documents(docs, head_words=head, rounds=0).collect())
    want = plain_base(rows)
    assert [tuple(r)[:5] for r in got] == [w[:5] for w in want]
    assert np.allclose([r.base_score for r in got], [w[5] for w in want], rtol=1e-9)

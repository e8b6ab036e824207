"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from curate.llm import registry, spelling


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(counts: dict[str, int], ratio: int = 10) -> set[tuple]:
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for word, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[word] = best if best and counts[best] >= ratio * counts[word] else None
    rows = set()
    for word in counts:
        root = word
        while form[root]:
            root = form[root]
        rows.add((word, form[word], root, counts[word], len(near[word]), counts[form[word]] if form[word] else None))
    return rows


def plain_counts(rows, slips: bool) -> dict[str, int]:
    counts: Counter = Counter()
    for key, text in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for word in re.findall("[A-Za-zÀ-ÿ]+", text):
            h = zlib.crc32(f"{key}:{word}".encode())
            if slips and key is not None and h % 31 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            if len(word) >= 7:
                counts[word] += 1
    return {w: n for w, n in counts.items() if n >= 2}


@pytest.mark.parametrize("letters", ["ab", "abc", "aé×z"])
def test_searches_find_all_words_one_edit_apart(letters):
    rng = random.Random(letters)
    for _ in range(15):
        words = sorted({"".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(80)})
        asked = sorted({"".join(rng.choices(letters + "y", k=rng.randint(2, 9))) for _ in range(40)})
        rng.shuffle(words)
        index, got = spelling.BidirectionalIndex(words), set()
        for first_half in (True, False):
            a, b = index.near(asked, first_half)
            got |= {(asked[i], words[j]) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
        assert got == {(q, w) for q in asked for w in words if one_edit(q, w)}


@pytest.mark.parametrize(("group", "split"), [(30_000, 10_000), (40, 10_000), (40, 7)])
def test_groups_equal_all_pairs_also_where_halves_are_split(spark, group, split):
    rng = random.Random(5)
    words = {"begin" + "".join(rng.choices("abc", k=rng.randint(2, 5))) for _ in range(150)}
    words |= {"".join(rng.choices("ab", k=rng.randint(7, 9))) + "ending" for _ in range(100)}
    counts = {w: rng.choice([2, 3, 25, 300, 4000]) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    pairs = {(r.word, r.near) for r in spelling.near_pairs(df, group, split).collect()}
    assert pairs == {(a, b) for a in counts for b in counts if one_edit(a, b)}
    got = {tuple(r) for r in spelling.group_variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == plain_groups(counts)


def test_query_equals_all_pairs(spark, tmp_path):
    rng = random.Random(9)
    base = ["elephant", "Elefants", "señorío", "longerword", "×÷sevenÿ", "shortish", "ab"]
    rows = [
        (i, " ".join(rng.choice(base) + rng.choice(["", ",", "-x", " 9"]) for _ in range(120))) for i in range(60)
    ]
    rows += [(None, "elephant elephant"), (61, None), (62, ""), (63, "abcdefghij" * 2000 + " " + "abcdefghij" * 2000), (1, rows[1][1])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in registry.op11_spelling(spark, str(tmp_path)).select(
        "word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == plain_groups(plain_counts(rows, True))
    assert any(r[1] for r in got)


def test_query_equals_all_pairs_on_the_smallest_tables(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    counts = plain_counts(rows, True)
    got = registry.op11_spelling(spark, "/root/testdata/sf0.001").collect()
    assert {r.word: r.n for r in got} == counts
    by_word = {r.word: r for r in got}
    for word in sorted(counts)[::40]:
        assert by_word[word].n_near == sum(one_edit(word, v) for v in counts)


def test_no_words_and_a_small_ratio(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, word string, n long")
    assert spelling.spelling_variants(empty).count() == 0
    with pytest.raises(ValueError):
        spelling.group_variants(empty.select("word", "n"), ratio=1)


def test_extra_columns_do_not_matter(spark):
    df = spark.createDataFrame(
        [(1, "mixtures mixtures", "x", 1), (2, "mixture mixture", None, 2)],
        "doc_id long, text string, word string, n long",
    )
    assert {(r.word, r.n_near) for r in spelling.spelling_variants(df).collect()} == {("mixtures", 1), ("mixture", 1)}

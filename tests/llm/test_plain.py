"""Mixing and the rule ensemble against plain versions."""

from __future__ import annotations

import hashlib
import math
import unicodedata
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from curate.llm import mixing, quality_rules, rule_ensemble


def plain_exponent(tokens: dict, mix: mixing.Mix) -> float:
    """Every grid point in turn: the largest with the entropy asked for, but no smaller
    than the first that holds the repetition limit."""
    most, least = max(tokens.values()), min(tokens.values())
    if len(tokens) < 2 or most == least:
        return 1.0

    def shares(p):
        parts = [(t / most) ** (p / mixing.GRID) for t in tokens.values()]
        return [x / sum(parts) for x in parts]

    def entropy(p):
        return -sum(s * math.log(s) for s in shares(p))

    asked = mix.target_entropy * math.log(len(tokens)) - 1e-9
    flat = max([p for p in range(mixing.GRID + 1) if entropy(p) >= asked], default=0)
    fits = [
        p for p in range(mixing.GRID + 1)
        if (least / most) ** (p / mixing.GRID - 1) <= mix.max_repeats + 1e-9
    ]
    return max(flat, min(fits)) / mixing.GRID


def plain_schedule(rows: list[tuple], mix: mixing.Mix) -> list[tuple]:
    """(body, epoch, block, position) for rows (id, source, n_tokens, body, hash of the row)."""
    tokens = Counter()
    for _, source, n, *_ in rows:
        tokens[source] += n
    alpha, most, total, plan = plain_exponent(tokens, mix), max(tokens.values()), 0, {}
    for source, t in tokens.items():
        units = int(math.floor((t / most) ** (alpha - 1) * mixing.UNIT + 0.5))
        whole, rest = units // mixing.UNIT, t * (units % mixing.UNIT) // mixing.UNIT
        plan[source] = (whole, rest)
        total += t * whole + rest
    blocks = max(1, -(-total // mix.block_tokens))
    placed = defaultdict(list)
    for source, (whole, rest) in plan.items():
        quota = max(1, (tokens[source] * whole + rest) // blocks)
        for epoch in range(whole + (rest > 0)):
            order = []
            for key, of, n, body, row in rows:
                if of == source:
                    name = ":".join(str(x) for x in (mix.seed, epoch, key, row) if x is not None)
                    digest = hashlib.md5(name.encode()).hexdigest()
                    order.append((int(digest[:10], 16), int(digest[10:20], 16), key, n, body))
            start = 0
            for _, inner, key, n, body in sorted(order, key=lambda o: o[0]):
                if epoch < whole or start < rest:
                    block = min((epoch * tokens[source] + start) // quota, blocks - 1)
                    placed[block].append((inner, body, epoch))
                start += n
    return sorted(
        (body, epoch, block, at)
        for block, inside in placed.items()
        for at, (_, body, epoch) in enumerate(sorted(inside))
    )


@pytest.mark.parametrize("target,repeats", [(0.95, 4.0), (1.0, 2.5), (0.8, 1.0)])
def test_schedule_equals_a_plain_version(spark, monkeypatch, target, repeats):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 7)
    monkeypatch.setattr(mixing, "GROUP_RANGES", 3)
    rows = [
        (None if i % 11 == 0 else i // 2, None if i % 10 == 9 else f"s{(i * i) % 10 % 4}", 1 + i % 13, i)
        for i in range(600)
    ]
    items = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long, body long")
    hashed = items.select("*", F.xxhash64("doc_id", "source", "n_tokens", F.struct("body")))
    mix = mixing.Mix(target_entropy=target, max_repeats=repeats, block_tokens=150)
    got = sorted(
        (r.body, r.epoch, r.block, r.position) for r in mixing.schedule(items, mix).collect()
    )
    assert got == plain_schedule([tuple(r) for r in hashed.collect()], mix)
    assert {g[0] for g in got} == set(range(600))


TEXTS = [
    None, "", " ", "One. Two! THREE| 4 five", "same line\nsame line\n\nsame line",
    "ÄÖÜ straße $$ ## 12.5%\tx" * 40, "a b c a b c a b c\nEnd.", "word " * 500,
]


def plain_features(text: str | None) -> dict[str, float]:
    body = text or ""
    words = [w for w in body.replace("\n", " ").replace("\t", " ").split(" ") if w]
    lines = [x for x in body.split("\n") if x.strip(" \t")]
    triples = Counter(zip(words, words[1:], words[2:], strict=False))
    again = {
        i + k for i in range(len(words) - 2) for k in range(3)
        if triples[tuple(words[i : i + 3])] > 1
    }
    n, long, n_lines = max(len(words), 1), max(len(body), 1), max(len(lines), 1)
    return {
        "words": len(words),
        "word_length": sum(map(len, words)) / n,
        "symbol_rate": sum(body.count(c) for c in "#*$%&|<>") / n,
        "dup_line_rate": (len(lines) - len(set(lines))) / n_lines,
        "repeat_rate": len(again) / n,
        "line_words": len(words) / n_lines,
        "upper_rate": sum(unicodedata.category(c) == "Lu" for c in body) / long,
        "mark_rate": body.count("!") / n,
        "bar_rate": body.count("|") / n,
        "digit_rate": sum(c in "0123456789" for c in body) / long,
        "distinct_rate": len(set(body.split(" "))) / (body.count(" ") + 1),
        "stop_rate": body.count(".") / n,
    }


def test_features_equal_a_plain_version(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for row in rule_ensemble.features(df).collect():
        want = plain_features(TEXTS[row.doc_id])
        assert {n: row[n] for n in rule_ensemble.FEATURES} == pytest.approx(want)


def test_compiled_score_equals_the_rules_one_by_one(spark):
    rows = [
        (i, " ".join(f"{'Tok' if i % 3 else 'x'}{j % (5 + i % 40)}" for j in range(20 + i % 90)), int(i % 3 > 0))
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    table = rule_ensemble.features(df).withColumn("label", F.col("label").cast("double")).cache()
    model = rule_ensemble.fit(table)
    assert model.weights

    def plain(row) -> float:
        total = model.intercept
        for rule, weight in model.weights:
            if all((row[b.feature] > b.value) == b.above for b in rule):
                total += weight
        return 1 / (1 + math.exp(-total))

    for row in table.withColumn("score", model.score()).collect():
        assert row.score == pytest.approx(plain(row), abs=1e-12)
    table.unpersist()


def test_small_groups_take_wider_limits(spark):
    """A document that stands out in its own source but not in its language: judged by
    its source only where that has ``min_group`` documents."""
    def text(n: int, length: int) -> str:
        return " ".join(f"{'w' * (length - 3)}{i:03d}" for i in range(n))

    rows = [(i, text(60 + i % 3, 6), "en", "small") for i in range(30)]
    rows += [(100 + i, text(60, 4 + i % 12), "en", "large") for i in range(60)]
    rows += [(999, text(60, 9), "en", "small")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")

    def kept(min_group: int) -> bool:
        verdicts = quality_rules.quality_verdicts(df, min_group=min_group)
        return verdicts.filter("doc_id = 999").first().kept

    assert kept(31) is False and kept(32) is True

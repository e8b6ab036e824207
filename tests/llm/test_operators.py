"""Edge cases of every operator on small tables, and plain versions to compare with."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from curate.llm import (
    lattice,
    line_dedup,
    mixing,
    neighbours,
    packing,
    quality_rules,
    rule_ensemble,
    simhash,
    token_files,
    url_rules,
)
from curate.llm.components import connected_components
from curate.llm.tokenization import encoder, vocabulary_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_words int"
LONG = " ".join(f"long{i} word" for i in range(3000))
PASSAGE = "\n".join(f"line {n} " + " ".join(f"p{n}x{i}" for i in range(28)) for n in range(3))
ROWS = [
    (1, None, "en", "a", 0, "x", 1),
    (2, "", None, None, 0, "x", 1),
    (3, " \t\n ", "en", "a", 0, "x", 1),
    (4, LONG, "en", "b", 0, "x", 1),
    (5, "intro one\n" + PASSAGE + "\nclose one", "en", "b", 0, "x", 1),
    (6, "other\n" + PASSAGE + "\n\ncoda", "en", "b", 0, "x", 1),
    (7, "same same same", "en", "a", 0, "x", 1),
    (7, "same same same", "en", "a", 0, "x", 1),
    (None, "no id here", "en", "a", 0, "x", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def test_every_operator_takes_an_empty_table(spark, no_docs, tmp_path):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    token_files.write_tokens(no_docs, str(tmp_path / "t"))
    results = [
        quality_rules.quality_verdicts(no_docs), line_dedup.dedup_lines(no_docs),
        simhash.near_duplicates(no_docs), simhash.keep_one_per_group(no_docs),
        mixing.mix_documents(no_docs), mixing.realise(no_docs), packing.pack_documents(no_docs),
        lattice.score_documents(no_docs), rule_ensemble.score_documents(no_docs, labels),
        url_rules.judge_pages(spark.createDataFrame([], "page_id long, url string, html string")),
        neighbours.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")),
    ]
    assert [r.count() for r in results] == [0] * len(results)


def test_quality_rules_keep_columns_and_follow_the_base_rule(docs):
    seen = {r.doc_id: r for r in quality_rules.quality_verdicts(docs).collect()}
    assert seen[2].n_words == 0 and seen[2].base_failed and not seen[2].kept
    assert seen[7].n_repeat_words == 0
    assert seen[5].n_words == 3 * 30 + 4 and not seen[5].base_failed
    kept = quality_rules.filter_documents(docs)
    assert kept.columns == docs.columns
    assert {4, 5, 6} == {r.doc_id for r in kept.collect()}


def test_repeat_words_count_the_first_window_too(spark):
    df = spark.createDataFrame([("a b c d a b c x",), ("q q q q q",)], "text string")
    got = [r.n_repeat_words for r in quality_rules.document_statistics(df).collect()]
    assert got == [6, 5]


def test_line_dedup_cuts_later_runs_only(docs):
    left = {(r.doc_id, r.text) for r in line_dedup.dedup_lines(docs).collect()}
    assert (6, "other\n\ncoda") in left
    assert (5, ROWS[4][1]) in left and (1, None) in left and (2, "") in left


def test_line_dedup_inside_one_document(spark):
    text = f"{PASSAGE}\nmiddle\n{PASSAGE}"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert line_dedup.dedup_lines(df).first().text == f"{PASSAGE}\nmiddle"


def test_simhash_matches_bit_by_bit(docs):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(ROWS)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].fp == 0 and by_id[3].component_id == 1
    assert by_id[7].fp == simhash.fingerprint("SAME same same")
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 5, 6, 7]


def test_simhash_links_reach_two_bits(spark):
    prints = spark.createDataFrame(
        [(1, 0), (2, 3), (3, 15), (4, -(1 << 63)), (5, 7 << 40)], "doc_id long, fp long"
    )
    got = {r.fp: r.component_id for r in simhash.components(prints).collect()}
    assert got == {0: 1, 3: 1, 15: 1, -(1 << 63): 1, 7 << 40: 5}


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(50)] + [(7, None)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.root for r in connected_components(df).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 150)}


def test_mixing_meets_weights_and_order(spark):
    rows = [(i, f"s{min(i % 10, 3)}", 5 + i % 7) for i in range(4000)] + [(None, None, 9)]
    items = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long")
    mix = mixing.Mix(target_entropy=1.0, max_repeats=3.0, block_tokens=2000)
    got = mixing.schedule(items, mix).collect()
    assert {r.doc_id for r in got} == {r[0] for r in rows}
    times = {}
    for r in got:
        times.setdefault(r.source, {}).setdefault(r.doc_id, []).append(r.epoch)
    assert max(len(e) for s in times.values() for e in s.values()) <= 3
    blocks = {}
    for r in got:
        blocks.setdefault(r.block, []).append(r.position)
    assert all(sorted(p) == list(range(len(p))) for p in blocks.values())


def test_mixing_respects_a_budget(spark):
    rows = [(i, "a" if i % 3 else "b", 10) for i in range(3000)]
    items = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long")
    mix = mixing.Mix(target_entropy=1.0, budget_tokens=6000)
    got = mixing.schedule(items, mix).groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()
    assert all(abs(r.n - 3000) <= 30 for r in got)


def test_mixing_spreads_rows_without_an_id(spark, monkeypatch):
    """Rows of one id lie in as many ranges as others do, and none is lost."""
    rows = [(None if i % 2 else 5, "a", 3 + i % 5, i) for i in range(20_000)]
    items = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long, body long")
    seen = []
    monkeypatch.setattr(mixing, "stored", lambda df, name: seen.append((name, df)) or df)
    got = mixing.schedule(items, mixing.Mix(block_tokens=20_000))
    assert sorted(r.body for r in got.select("body").collect()) == list(range(20_000))
    reads = next(df for name, df in seen if name == "reads")
    sizes = [r["count"] for r in reads.groupBy("__range").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 2 * mixing.RANGE_ROWS


def test_packing_deals_equal_rows_out(spark):
    same = spark.createDataFrame([(None, 300)] * 4000, "doc_id long, length long")
    dealt = packing._dealt(same, 4000, 0, 500).groupBy("__group").count().collect()
    assert len(dealt) == 8 and max(r["count"] for r in dealt) < 1000
    packed = packing.pack(same, group_rows=500).collect()
    assert len(packed) == 4000 and len({(r.sequence_id, r.offset) for r in packed}) == 4000
    assert 1334 <= len({r.sequence_id for r in packed}) <= 1334 + 8


def test_encoder_equals_the_library():
    e = encoder(vocabulary_path())
    texts = [
        "", "a  b", "  x", "x  ", " \n a.\nb c", "x\t y", "é² a.b c,\n\nd", "don't it's  ok.",
        "<|endoftext|> a", "a\n b", "　a b　 c", "12 3.5, 7\n8", "\na", "a \nb", "a\n",
        "x\u0085y z", LONG, PASSAGE,
    ]
    whole = [np.array(e.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert e.encode(texts) == whole


def test_token_files_round_trip_and_prune(spark, docs, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_tokens(docs, path)
    got = token_files.token_digests(token_files.read_tokens(spark, path)).orderBy("start").collect()
    end = np.array([2], "<u4").tobytes()
    coded = [c + end for c in encoder(vocabulary_path()).encode(
        [r[1] or "" for r in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))]
    )]
    starts = np.cumsum([0, *(len(c) // 4 for c in coded)])[:-1].tolist()
    assert [(r.start, r.n_tokens, r.ids_crc32) for r in got] == [
        (s, len(c) // 4, zlib.crc32(c)) for s, c in zip(starts, coded, strict=True)
    ]
    one = token_files.read_tokens(spark, path).filter(F.col("doc_id") == 5)
    assert one.count() == 1


def test_packing_is_gapless_and_certified(docs):
    got = packing.pack_documents(docs).collect()
    sequences: dict[int, list] = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert {r.doc_id for r in got} == {r[0] for r in ROWS}


def test_packing_exchanges_between_partitions(spark):
    rng = np.random.default_rng(1)
    rows = [(i, int(x)) for i, x in enumerate(rng.integers(1, 700, 3000))]
    df = spark.createDataFrame(rows, "doc_id long, length long")
    packed = packing.pack(df, group_rows=200).collect()
    assert sorted(r.doc_id for r in packed) == list(range(3000))
    lengths = np.array([r[1] for r in rows])
    assert len({r.sequence_id for r in packed}) <= packing.lower_bound(lengths, 1024) * 1.02
    fill: dict[int, int] = {}
    for r in packed:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 1024


def test_lower_bound_sees_large_items():
    assert packing.lower_bound(np.array([600] * 10), 1024) == 10
    assert packing.lower_bound(np.array([], dtype=int), 1024) == 0


def test_neighbours_take_copies_ties_and_bad_rows(spark):
    good = [(i, [float(np.cos(i)), float(np.sin(i)), 1.0]) for i in range(400)]
    copies = [(1000 + i, [1.0, 0.0, 0.0]) for i in range(200)]
    bad = [(450, None), (500, []), (550, [0.0, 0.0, 0.0]), (600, [1.0, float("nan"), 0.0])]
    df = spark.createDataFrame(good + copies + bad + copies[:3], "vec_id long, embedding array<float>")
    got: dict[int, list] = {}
    for r in neighbours.nearest(df).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {0, 50, 100, 150, 200, 250, 300, 350, 1000, 1050, 1100, 1150}
    assert [v for _, v, _ in sorted(got[1100])] == [1000, 1001, 1002, 1003, 1004]
    assert [v for _, v, _ in sorted(got[1000])] == [1001, 1002, 1003, 1004, 1005]
    ids, vectors = np.array([i for i, _ in good]), np.array([v for _, v in good], np.float32)
    for q in (0, 50, 350):
        score = vectors.astype(float) @ vectors[q].astype(float)
        best = [i for i in ids[np.argsort(-score, kind="stable")] if i != q][:5]
        assert len(set(best) & {v for _, v, _ in got[q]}) >= 4


def test_lattice_sums_all_cuts_and_weights_add_up():
    texts = [b"a", b"b", b"ab", "▁a".encode(), "▁ab".encode()]
    weights = np.log(np.full(258 + 5, 1 / 263))
    model = lattice.Lattice(texts, weights)

    def plain(word: bytes) -> float:
        """Probability of a word as a sum over all ways to spell it."""
        p = 1 / 263

        def tail(at: int) -> float:
            if at == len(word):
                return 1.0
            ways = p * tail(at + 1)  # byte piece
            ways += sum(p * tail(at + len(t)) for t in (b"a", b"b", b"ab") if word.startswith(t, at))
            return ways

        begun = sum(p * tail(len(t)) for t in (b"a", b"ab") if word.startswith(t))
        return p * tail(0) + begun

    for word in (b"a", b"abab", b"xb", b"ba"):
        data = np.frombuffer(word, np.uint8).reshape(1, -1)
        assert math.exp(model.scores(data)[0]) == pytest.approx(plain(word))
        used = model.expected(data, np.array([1.0]))
        assert used.min() >= 0 and used.sum() >= 1


def test_lattice_handles_odd_rows(docs):
    got = lattice.score_documents(docs).collect()
    assert len(got) == len(ROWS)
    tokens = {r.doc_id: r.n_tokens for r in got}
    assert tokens[1] == tokens[2] == tokens[3] == 1 and tokens[4] == 6001 and tokens[7] == 4
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    twins = [r.score for r in got if r.doc_id == 7]
    assert twins[0] == pytest.approx(twins[1])


def test_url_rules_follow_links_and_keep_explicit_allow(spark):
    link = '<head><link rel="canonical" href="{}"></head>'
    hop = '<meta http-equiv="refresh" content="0; url={}">'
    rows = [
        (1, "https://x.org/a", link.format("https://bad.net/z")),
        (2, "https://y.org/b", hop.format("https://x.org/a")),
        (3, "https://y.org/fr/c", hop.format("https://y.org/b")),
        (4, "https://free.org/q#top", None),
        (5, "HTTPS://WWW.Example.NET/en/p?x", ""),
        (6, None, "x"), (7, "no scheme", None), (8, "https://z.com/dir/p", link.format("../q")),
        (9, "https://y.org/b#part", None), (10, "http://badnet/", None),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_rules.judge_pages(df).collect()}
    assert got[1] == got[2] == got[9] == (None, "block")
    assert got[3] == ("org/fr/", "allow") and got[5] == ("example.net/en/", "allow")
    assert got[4] == got[6] == got[7] == got[8] == got[10] == (None, "allow")


def test_rule_ensemble_learns_and_scores_everything(spark):
    good = [(i, " ".join(f"w{i}{j}" for j in range(60))) for i in range(200)]
    poor = [(1000 + i, "spam!! " * 60) for i in range(200)]
    df = spark.createDataFrame([*good, *poor, (None, None), (9, "")], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, 1) for i, _ in good] + [(i, 0) for i, _ in poor] + [(None, 1)], "doc_id long, quality int"
    )
    got = rule_ensemble.score_documents(df, labels).collect()
    assert len(got) == 402 and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None]
    assert held and all(r.predicted == (1 if r.doc_id < 1000 else 0) for r in held if r.doc_id != 9)


def test_rule_ensemble_with_one_kind_of_label(spark, docs):
    labels = spark.createDataFrame([(4, 1), (5, 1), (6, 1)], "doc_id long, quality int")
    got = rule_ensemble.score_documents(docs, labels).collect()
    assert {r.score for r in got} <= {1.0, 0.5}

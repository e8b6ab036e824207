"""The line stage of the pipeline against brute force on runs of uneven lines."""

from __future__ import annotations

import numpy as np

import corpus_pipeline
from tests.llm.test_pipeline import documents


def lines_left(texts, min_words=50):
    """Texts without the lines of any span of 50 words that occurred earlier; spans that
    overlap or touch are one, with the blank lines between."""
    spans, later, place = {}, {}, {}
    for doc, text in texts:
        rows = [(p, line) for p, line in enumerate(text.split("\n")) if line.split()]
        place[doc] = [p for p, _ in rows]
        for a in range(len(rows)):
            for b in range(a + 1, len(rows) + 1):
                if sum(len(line.split()) for _, line in rows[a:b]) >= min_words:
                    content = tuple(line for _, line in rows[a:b])
                    spans.setdefault(content, []).append((doc, a, b))
    gone = set()
    for places in spans.values():
        for doc, a, b in sorted(places)[1:]:
            later.setdefault(doc, []).append((a, b))
    for doc, found in later.items():
        start = end = None
        for a, b in [*sorted(found), (10**9, 0)]:
            if end is not None and a > end:
                gone |= {(doc, p) for p in range(place[doc][start], place[doc][end - 1] + 1)}
                start = end = None
            start, end = a if start is None else start, max(b, end or 0)
    return {
        doc: "\n".join(x for p, x in enumerate(text.split("\n")) if (doc, p) not in gone)
        for doc, text in texts
    }


def test_line_dedup_takes_whole_runs(spark):
    """Uneven lines: runs end in lines that begin no window of 50 words."""
    rng = np.random.default_rng(5)
    pool = [
        " ".join(f"l{n}w{i}" for i in range(int(rng.choice([0, 1, 3, 9, 20, 49, 60])))) for n in range(60)
    ]
    texts = []
    for doc in range(30):
        parts = [f"only in {doc}"]
        for _ in range(3):
            a = int(rng.integers(0, 55))
            parts += [*pool[a : a + int(rng.integers(1, 9))], f"mark {doc} {rng.integers(10**9)}"]
        texts.append((doc, "\n".join(parts)))
    texts += [(30, f"{'a ' * 60}\n{'b ' * 20}"), (31, f"x\n{'a ' * 60}\n{'b ' * 20}\ny"), (32, f"{'a ' * 60}\nz")]
    kept = corpus_pipeline.lines(spark, documents(spark, texts), "").collect()
    assert {r.doc_id: r.text for r in kept} == lines_left(texts)

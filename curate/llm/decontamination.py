"""Benchmark decontamination with a generalised suffix automaton of the test items.

Texts and items are normalised to the same words. An item of n words has a limit of
``min(window, ceil(coverage * n))`` words: a stretch of that many of its words in a row,
found in a document, is too much, be it by length or by the share of the item. All items
stand in one suffix automaton. A document streams through it word by word; the automaton
tracks the longest match that ends at each word, whatever item it comes from, and where
that match reaches a limit the words are hit and the items noted.

Items are cut into overlapping segments and dealt out into blocks of about
``BLOCK_BYTES``; each block has an automaton of its own, so what a worker holds is
bounded however large the benchmark is. All documents pass each block, and the hits of a
document are united after that. Test items are a stated query set, not one half of the
corpus, so this is no join of all pairs.

Edge cases: null and empty texts have no words and no hits; items without words are left
out; a null item id counts as an item named by an empty string, equal ids as one item;
very long texts are streamed, the words of one text in memory at a time; rows with equal
id and text each get the same result; an empty table on either side gives no hits; other
columns pass through ``decontaminate`` and do not matter elsewhere.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curate.llm.common import ascii_lower, keyed, stored
from curate.llm.tokenization import small_batches

WINDOW = 10
COVERAGE = 1.0
BLOCK_BYTES = 2 << 20
SEGMENT_WORDS = 5_000

#: What separates words once A-Z are lower-cased: all ASCII but digits and a-z.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_BYTES = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)
_CASED_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_SPANS = "array<struct<first:int,last:int>>"


def text_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_WORD_BYTES).split()


class SuffixAutomaton:
    """All stretches of words of all items, with the limits they reach.

    ``items`` are (name, words, limit). Transitions lie in one table under
    ``state * width + word``; ``link`` leads to the longest shorter suffix that
    occurs elsewhere, ``length`` is the longest stretch of a state.
    """

    def __init__(self, items: list[tuple[str, list[bytes], int]]):
        self.numbers: dict[bytes, int] = {}
        for _, words, _ in items:
            for word in words:
                self.numbers.setdefault(word, len(self.numbers))
        self.width = max(1, len(self.numbers))
        self.step: dict[int, int] = {}
        self.link, self.length = [-1], [0]
        self._out: list[list[int]] = [[]]
        coded = [[self.numbers[w] for w in words] for _, words, _ in items]
        for codes in coded:
            last = 0
            for code in codes:
                last = self._add(last, code)
        del self._out
        self._mark(items, coded)

    def _new(self, length: int, link: int) -> int:
        self.length.append(length)
        self.link.append(link)
        self._out.append([])
        return len(self.link) - 1

    def _put(self, state: int, code: int, to: int) -> None:
        at = state * self.width + code
        if at not in self.step:
            self._out[state].append(code)
        self.step[at] = to

    def _split(self, state: int, code: int, to: int) -> int:
        """The state of the stretches of ``state`` followed by ``code``, which ``to`` may
        share with longer ones; then it is divided."""
        if self.length[to] == self.length[state] + 1:
            return to
        twin = self._new(self.length[state] + 1, self.link[to])
        for c in self._out[to]:
            self._put(twin, c, self.step[to * self.width + c])
        self.link[to] = twin
        while state >= 0 and self.step.get(state * self.width + code) == to:
            self.step[state * self.width + code] = twin
            state = self.link[state]
        return twin

    def _add(self, last: int, code: int) -> int:
        to = self.step.get(last * self.width + code)
        if to is not None:
            return self._split(last, code, to)
        new = self._new(self.length[last] + 1, 0)
        at = last
        while at >= 0 and (to := self.step.get(at * self.width + code)) is None:
            self._put(at, code, new)
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._split(at, code, to)
        return new

    def _mark(self, items: list[tuple[str, list[bytes], int]], coded: list[list[int]]) -> None:
        """At each state, the limits that its stretches reach: {limit: names}."""
        self.own: dict[int, dict[int, set[str]]] = {}
        for (name, _, limit), codes in zip(items, coded, strict=True):
            at = 0
            for position, code in enumerate(codes, 1):
                at = self.step[at * self.width + code]
                while self.length[self.link[at]] >= limit:
                    at = self.link[at]
                if position >= limit:
                    self.own.setdefault(at, {}).setdefault(limit, set()).add(name)
        never = 1 << 60
        #: The shortest match that reaches a limit at a state or on its suffixes.
        self.least = [never] * len(self.link)
        for at in np.argsort(np.array(self.length), kind="stable").tolist()[1:]:
            self.least[at] = min([self.least[self.link[at]], *self.own.get(at, ())])

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Disjoint spans of hit words, by first and last word, and the names of items."""
        step, link, length, least, width = self.step.get, self.link, self.length, self.least, self.width
        found: list[tuple[int, int, int]] = []
        at = match = 0
        for place, code in enumerate(map(self.numbers.get, words)):
            if code is None:
                at = match = 0
                continue
            to = step(at * width + code)
            if to is None:
                while to is None:  # the root knows every code
                    at = link[at]
                    to = step(at * width + code)
                match = length[at]
            at = to
            match += 1
            if match >= least[at]:
                found.append((place, at, match))
        spans: list[tuple[int, int]] = []
        names: set[str] = set()
        done: set[tuple[int, int]] = set()
        for place, at, match in found:
            longest = 0
            state = at
            while state > 0 and least[state] < 1 << 60:
                for limit, of in self.own.get(state, {}).items():
                    if limit <= match:
                        longest = max(longest, limit)
                        if (state, limit) not in done:
                            done.add((state, limit))
                            names |= of
                state = link[state]
            first = place - longest + 1
            while spans and spans[-1][1] >= first - 1:
                first = min(first, spans.pop()[0])
            spans.append((first, place))
        return spans, names


def item_segments(
    items: DataFrame, key: str = "item_id", text: str = "text",
    window: int = WINDOW, coverage: float = COVERAGE, segment_words: int = SEGMENT_WORDS,
) -> DataFrame:
    """(name, words, limit): overlapping pieces of all items, which together hold every
    stretch of ``limit`` words of an item."""
    words = F.array_remove(F.split(ascii_lower(F.coalesce(F.col(text), F.lit(""))), GAP), "")
    n = F.size("words")
    limit = F.least(F.lit(window), F.ceil(n * F.lit(coverage))).cast("int")
    starts = F.sequence(F.lit(0), F.greatest(n - F.col("limit"), F.lit(0)), F.lit(segment_words))
    return (
        items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("name"), words.alias("words"))
        .filter(n > 0)
        .withColumn("limit", F.greatest(limit, F.lit(1)))
        .withColumn("start", F.explode(starts))
        .select(
            "name",
            F.slice("words", F.col("start") + 1, F.col("limit") + (segment_words - 1)).alias("words"),
            "limit",
        )
    )


_AUTOMATA: dict[str, SuffixAutomaton] = {}


def _automaton(broadcast) -> SuffixAutomaton:
    """The automaton of a block, built once per worker; only the last one stays."""
    name, items = broadcast.value
    if name not in _AUTOMATA:
        _AUTOMATA.clear()
        _AUTOMATA[name] = SuffixAutomaton(items)
    return _AUTOMATA[name]


def _scan(batches: Iterator[pa.RecordBatch], block) -> Iterator[pa.RecordBatch]:
    automaton = _automaton(block)
    spans_type = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
    for batch in small_batches(batches):
        numbers, spans, names = [], [], []
        for text in batch.column("text").to_pylist():
            words = text_words(text)
            hit, of = automaton.hits(words)
            numbers.append(len(words))
            spans.append([{"first": a, "last": b} for a, b in hit])
            names.append(sorted(of))
        rest = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(n) for n in rest], pa.array(numbers, pa.int64()),
                pa.array(spans, spans_type), pa.array(names, pa.list_(pa.string())),
            ],
            names=[*rest, "n_words", "spans", "items"],
        )


def _blocks(segments: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, list[bytes], int]]]:
    """Segments in blocks of about ``block_bytes`` bytes, or of one larger segment."""
    size = F.octet_length(F.array_join("words", " ")) + F.octet_length("name") + 16
    segments = stored(segments.withColumn("size", size.cast("long")), "segments")
    total = segments.agg(F.sum("size")).first()[0] or 0
    count = max(1, math.ceil(total / block_bytes))
    dealt = segments.withColumn("block", F.pmod(F.xxhash64("name", "words"), F.lit(count)))
    for number in range(count):
        mine = dealt.filter(F.col("block") == number).select("name", "words", "limit").toArrow().to_pydict()
        yield [
            (name, [w.encode("utf-8", "surrogatepass") for w in words], limit)
            for name, words, limit in zip(mine["name"], mine["words"], mine["limit"], strict=True)
        ]


def _hit(spans: str) -> Column:
    """Words inside the spans, which may overlap."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("last"))
    return F.aggregate(
        F.array_sort(spans), start,
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["last"] - F.greatest(s["first"] - 1, a["last"]))).alias("n"),
            F.greatest(a["last"], s["last"]).alias("last"),
        ),
        lambda a: a["n"],
    )


def scan_documents(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
    window: int = WINDOW, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row for each row of ``docs``: (key, __id, __th, n_words, spans, n_hit, items).

    ``spans`` are the hit stretches by first and last word, counted from zero, ``items``
    the names of the items with occurring stretches, sorted.
    """
    context = docs.sparkSession.sparkContext
    slim = keyed(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "key")
    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, __id {kind}, __th long, n_words long, spans {_SPANS}, items array<string>"
    scans = []
    for block in _blocks(item_segments(items, window=window, coverage=coverage), block_bytes):
        shared = context.broadcast((uuid.uuid4().hex, block))
        scans.append(slim.mapInArrow(partial(_scan, block=shared), schema))
    if len(scans) == 1:
        found = scans[0]
    else:
        every = stored(scans[0], "scan")
        for scan in scans[1:]:
            every = every.unionByName(stored(scan, "scan"))
        found = (
            every.groupBy("__id", "__th")
            .agg(
                F.max("key").alias("key"), F.max("n_words").alias("n_words"),
                F.flatten(F.collect_set("spans")).alias("spans"),
                F.flatten(F.collect_set("items")).alias("items"),
                (F.count("*") / len(scans)).cast("int").alias("rows"),
            )
            .withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows"))))
        )
    return found.select(
        F.col("key").alias(key), "__id", "__th", "n_words", "spans", _hit("spans").alias("n_hit"),
        F.array_sort(F.array_distinct("items")).alias("items"),
    )


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, contaminated) for each row of ``docs``."""
    return scan_documents(docs, items, key, **options).select(
        key, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for i, spans in enumerate(batch.column("spans").to_pylist()):
            if not spans:
                continue
            places = [m.span() for m in _CASED_WORD.finditer(texts[i])]
            left, at = [], 0
            for span in sorted(spans, key=lambda s: (s["first"], s["last"])):
                left.append(texts[i][at : max(at, places[span["first"]][0])])
                at = max(at, places[span["last"]][1])
            texts[i] = "".join([*left, texts[i][at:]])
        columns = [batch.column("row"), pa.array(texts, batch.schema.field("text").type)]
        yield pa.RecordBatch.from_arrays(columns, names=["row", "text"])


def decontaminate(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """The documents with all hit stretches cut out of their texts; all rows stay."""
    found = stored(scan_documents(docs, items, key, text, **options), "hits")
    spans = found.filter(F.size("spans") > 0).groupBy("__id", "__th").agg(F.first("spans").alias("spans"))
    # A caller's columns travel in one struct, so no name of theirs can clash.
    boxed = docs.select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.struct(*docs.columns).alias("row")
    )
    joined = keyed(boxed, "key").join(spans, ["__id", "__th"], "left").select("row", "text", "spans")
    cut = joined.mapInArrow(_cut, joined.select("row", "text").schema)
    return cut.select(
        *[(F.col("text") if c == text else F.col("row")[c]).alias(c) for c in docs.columns]
    )


#: The same in SQL for DuckDB, by a join of all stretches.
ORACLE_SQL = r"""
with d as (
  select row_number() over () as r, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
  from documents
), i as (
  select coalesce(item_id::varchar, '') as name, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
  from benchmark
), iw as (
  select distinct name, least(10, len(w)) as k, w[p : p + least(10, len(w)) - 1] as g
  from i, unnest(range(1, len(w) - least(10, len(w)) + 2)) as u(p) where len(w) > 0
), dw as (
  select r, p, k, w[p : p + k - 1] as g
  from d, (select distinct k from iw), unnest(range(1, len(w) - k + 2)) as u(p)
), h as (
  select r, p, k, name from dw join iw using (k, g)
), n as (
  select r, count(distinct place) as n_hit from h, unnest(range(p, p + k)) as u(place) group by r
), m as (
  select r, count(*) as n_items, string_agg(name, ',' order by name) as names
  from (select distinct r, name from h) group by r
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(names, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from d left join n using (r) left join m using (r)
"""

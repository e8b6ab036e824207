"""Line dedup by winnowing: later copies of repeated runs of lines are deleted.

A *window* starts at a line and takes whole lines until it has ``min_words`` words.
Of each window the line with the smallest hash (the first, if several) is selected as
its fingerprint. Equal windows select equal fingerprints, so every run of lines that
repeats and has ``min_words`` words or more is sure to share a fingerprint with its
earlier copy. Windows whose fingerprint occurs once, or never with the same window
around it, are done. From every other fingerprint the match is extended both ways to the
windows that selected it, which must agree line by line; windows that overlap or touch
join into one run. A run is
deleted if it occurred earlier: in a document with a smaller id (nulls last, equal ids
by a hash of the text), or further up in the same document.

The result does not depend on how data is split: a line goes if and only if it lies in
a window, or with ``whole_runs`` in a span, that occurred earlier. No pair of occurrences is ever formed; every occurrence
is matched with the first one, by a join against a table with one row per window.

Lines at the end of a run, from each of which fewer than ``min_words`` words are left to
the run's end, begin no window of the run. With ``whole_runs`` a window is also taken
together with the lines after it, one by one, as long as those after its first line have
fewer than ``min_words`` words. These longer spans are matched in the same way, so all
lines of a run of ``min_words`` words that occurred earlier, wherever, go.

Edge cases: null text stays null and empty text stays empty; lines without a word take
no part, and go only where they lie inside a deleted run; a very long text is held by one
task as the array of its lines; rows with the same id and text
count as one document; an empty table gives an empty result; other columns pass through,
but for one named ``__removed``, which is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curate.llm.common import discard, keyed, packed, stored, word_array

MIN_WORDS = 50

_DOC = ["__null", "__id", "__th"]


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def line_windows(
    docs: DataFrame, key: str, text: str, min_words: int, whole_runs: bool = False
) -> DataFrame:
    """Every window: its document, first line, length in lines, span of positions,
    fingerprint hash and position, and the hashes of its lines; if asked for, in
    ``tail`` the position and hash of the lines after it that may end a run."""
    rows = F.filter(
        F.transform(
            _lines(F.col(text)),
            lambda line, i: F.struct(
                i.alias("pos"),
                F.xxhash64(line).alias("hash"),
                F.size(word_array(line)).alias("words"),
            ),
        ),
        lambda s: s["words"] > 0,
    )
    per_doc = (
        keyed(docs, key, text)
        .filter(F.col(text).isNotNull())
        .select(F.col(key).isNull().alias("__null"), "__id", "__th", rows.alias("rows"))
        .groupBy(*_DOC)
        .agg(F.first("rows").alias("rows"))
    )
    lines = per_doc.select(*_DOC, F.posexplode("rows").alias("idx", "row")).select(
        *_DOC, "idx", "row.*"
    )
    before = Window.partitionBy(*_DOC).orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    placed = lines.withColumn("start", F.coalesce(F.sum("words").over(before), F.lit(0)))
    # Lines of a window are those that begin before it has min_words words.
    window = Window.partitionBy(*_DOC).orderBy("start").rangeBetween(0, min_words - 1)
    tail = []
    if whole_runs:
        # Lines that end less than min_words words after the first line does.
        placed = placed.withColumn("end", F.col("start") + F.col("words"))
        after = Window.partitionBy(*_DOC).orderBy("end").rangeBetween(1, min_words - 1)
        tail = [F.collect_list(F.struct("idx", "pos", "hash")).over(after).alias("after")]
    windows = (
        placed.select(
            *_DOC,
            "idx",
            F.col("pos").alias("first_pos"),
            F.max("pos").over(window).alias("last_pos"),
            F.sum("words").over(window).alias("n_words"),
            F.collect_list("hash").over(window).alias("hashes"),
            F.min(F.struct("hash", "idx")).over(window).alias("selected"),
            *tail,
        )
        .filter(F.col("n_words") >= min_words)
        .select(
            *_DOC,
            "idx",
            F.size("hashes").alias("n_lines"),
            "first_pos",
            "last_pos",
            "hashes",
            F.col("selected.hash").alias("fp"),
            F.col("selected.idx").alias("fp_idx"),
            *(["after"] if whole_runs else []),
        )
    )
    if not whole_runs:
        return windows
    beyond = F.filter("after", lambda s: s["idx"] >= F.col("idx") + F.col("n_lines"))
    return windows.withColumn("tail", beyond).drop("after")


def _fingerprints(windows: DataFrame) -> DataFrame:
    """Fingerprints that occur at two places or more with the same window around them, one
    row each: their hash, and that of the window.

    Equal windows have their fingerprints at the same line, so their least and greatest
    place differ where one repeats. A line that is common alone joins nothing. The extra
    grouping column makes both sides of the join that follows a plain shuffle, which the
    adaptive planner can split where one passage is very common.
    """
    place = F.struct(*_DOC, F.col("fp_idx"))
    return (
        windows.groupBy("fp", "whole", F.hash("fp").alias("h"))
        .agg(F.min(place).alias("low"), F.max(place).alias("high"))
        .filter(F.col("low") != F.col("high"))
        .select("fp", "whole")
    )


def _with_tails(windows: DataFrame) -> DataFrame:
    """The windows, and each again with one, two and more lines of its tail."""
    taken = windows.withColumn("k", F.explode(F.sequence(F.lit(0), F.size("tail"))))
    part = F.slice("tail", F.lit(1), F.col("k"))
    return taken.select(
        *_DOC, "idx",
        (F.col("n_lines") + F.col("k")).alias("n_lines"),
        "first_pos",
        F.when(F.col("k") > 0, F.element_at(part, -1)["pos"]).otherwise(F.col("last_pos")).alias("last_pos"),
        F.concat("hashes", F.transform(part, lambda s: s["hash"])).alias("hashes"),
    )


def repeated_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
    whole_runs: bool = False,
) -> DataFrame:
    """Later copies of repeated runs: (__null, __id, __th, first_pos, last_pos), as
    positions of lines counted from zero."""
    windows = line_windows(docs, key, text, min_words, whole_runs)
    windows = stored(windows.withColumn("whole", F.xxhash64("hashes")), "windows")
    matched = windows.join(_fingerprints(windows), ["fp", "whole"], "left_semi")
    if whole_runs:
        matched = _with_tails(matched)
    content = stored(
        matched.select(
            *_DOC, "idx", "n_lines", "first_pos", "last_pos",
            F.xxhash64("hashes").alias("c1"), F.xxhash64(F.lit(1), "hashes", F.lit(2)).alias("c2"),
        ),
        "matches",
    )
    discard(windows)
    here = F.struct(*_DOC, F.col("idx"))
    # The extra grouping column makes both sides of the join a plain shuffle, which
    # the adaptive planner can split where one passage is very common.
    first = (
        content.groupBy("c1", "c2", F.hash("c1").alias("h"))
        .agg(F.min(here).alias("first"), F.max(here).alias("last"))
        .filter(F.col("first") != F.col("last"))
        .select("c1", "c2", "first")
    )
    later = content.join(first, ["c1", "c2"]).filter(here != F.col("first"))
    in_order = Window.partitionBy(*_DOC).orderBy("idx")
    reached = F.max(F.col("idx") + F.col("n_lines")).over(
        in_order.rowsBetween(Window.unboundedPreceding, -1)
    )
    runs = later.select(
        *_DOC, "idx", "first_pos", "last_pos",
        F.coalesce(F.col("idx") > reached, F.lit(True)).cast("int").alias("opens"),
    ).withColumn("run", F.sum("opens").over(in_order))
    return runs.groupBy(*_DOC, "run").agg(
        F.min("first_pos").alias("first_pos"), F.max("last_pos").alias("last_pos")
    ).drop("run")


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
    whole_runs: bool = False,
) -> DataFrame:
    """The documents with later copies of repeated runs cut out of their text.

    Adds ``__removed``, the deleted spans as an array of (first_pos, last_pos).
    Documents are all kept, also those of which nothing is left but an empty text.
    """
    spans = (
        repeated_runs(docs, key, text, min_words, whole_runs)
        .groupBy("__id", "__th")
        .agg(F.sort_array(F.collect_list(F.struct("first_pos", "last_pos"))).alias("__removed"))
    )
    lines = F.filter(
        _lines(F.col(text)),
        lambda line, i: ~F.exists("__removed", lambda s: i.between(s["first_pos"], s["last_pos"])),
    )
    left = F.when(F.col("__removed").isNull(), F.col(text)).otherwise(F.array_join(lines, "\n"))
    passed = [
        F.col(text) if n == text else F.col(f"__row.`{n}`").alias(n)
        for n in docs.columns if n != "__removed"
    ]
    return (
        packed(docs, key, text)
        .join(spans, ["__id", "__th"], "left")
        .withColumn(text, left)
        .select(*passed, "__removed")
    )


#: The same in SQL for DuckDB, for whole runs: every window of lines, and every span that
#: goes on after one while the lines after its first have fewer than 50 words.
ORACLE_SQL = r"""
with d as (
  select row_number() over () as r, doc_id, text, string_split(text, chr(10)) as ls from documents
), l as (
  select r, doc_id, text, i - 1 as pos, ls[i] as line,
    len(list_filter(regexp_split_to_array(ls[i], '[\x20\x09-\x0D]+'), lambda x: x <> '')) as words
  from d, unnest(range(1, len(ls) + 1)) as u(i)
), p as (
  select *, row_number() over o as idx, sum(words) over o - words as start
  from l where words > 0 window o as (partition by r order by pos)
), w as (
  select a.r, a.doc_id, a.text, a.idx, a.pos, b.idx as last, b.pos as last_pos,
    b.start + b.words - a.start as n, b.start - a.start as n_before,
    b.start + b.words - a.start - a.words as n_after
  from p a join p b on a.r = b.r and b.idx >= a.idx
    and b.start - a.start < greatest(50, a.words + 50)
), c as (
  select w.r, w.doc_id, w.text, w.idx, w.pos, w.last, w.last_pos,
    list(p.line order by p.idx) as content
  from w join p on p.r = w.r and p.idx between w.idx and w.last
  where w.n >= 50 and (w.n_before < 50 or w.n_after < 50)
  group by all
), f as (
  select *, row_number() over (partition by content order by doc_id nulls last, text, idx) as nth
  from c
), later as (
  select *, max(last) over (partition by r order by idx, last
    rows between unbounded preceding and 1 preceding) as reached
  from f where nth > 1
), runs as (
  select *, sum((reached is null or idx > reached + 1)::integer)
    over (partition by r order by idx, last rows unbounded preceding) as run
  from later
), spans as (
  select r, run, min(pos) as a, max(last_pos) as b from runs group by r, run
), gone as (
  select distinct r, unnest(range(a, b + 1)) as pos from spans
), kept as (
  select l.r, string_agg(line, chr(10) order by l.pos) as t, count(*) as n
  from l where not exists (select 1 from gone g where g.r = l.r and g.pos = l.pos) group by l.r
), n as (
  select r, count(*) as removed from gone group by r
)
select d.doc_id, case when d.text is null then null else coalesce(kept.t, '') end as text,
  coalesce(len(d.ls), 0)::bigint as n_lines, coalesce(n.removed, 0)::bigint as n_removed
from d left join kept using (r) left join n using (r)
"""

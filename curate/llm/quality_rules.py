"""Quality rules whose limits are learned per language and source.

Every document gets five integer statistics. Their distributions per language and
source are kept as mergeable quantile sketches: counts over log-linear buckets (32
for each power of two), which add up exactly whatever the order, so the same rows
always give the same limits. A limit is a quartile plus a multiple of the
interquartile range, so it follows the data and, unlike a fixed share, rejects
nothing where nothing stands out. Groups with few documents use the sketches merged
over their language, and if that is small too, over everything.

Edge cases: a null or blank text has no words and fails the base rule; null language
or source is a group of its own; an empty table gives an empty result; repeated rows
are judged alike; columns of other names are left alone by ``filter_documents``. A very
long text is held by one task as the array of its words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curate.llm.common import stored, word_array
from curate.operators.skew import fits_broadcast

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
FENCE = 6
#: Fewest documents whose own quartiles are taken for a limit.
MIN_GROUP = 200


@dataclass(frozen=True)
class Metric:
    """Thousandths of ``part`` in ``whole``; ``floor`` is the least spread assumed."""

    part: str
    whole: str
    floor: int

    def value(self) -> Column:
        return F.expr(f"(1000 * {self.part}) div greatest({self.whole}, 1)")


METRICS = {
    "word_length": Metric("word_chars", "n_words", 100),
    "symbols": Metric("n_symbols", "n_words", 20),
    "dup_lines": Metric("n_dup_lines", "n_lines", 100),
    "repeats": Metric("n_repeat_words", "n_words", 80),
}


def document_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines``, ``n_dup_lines``,
    ``n_repeat_words`` and ``base_failed``, all from the whole text.

    Columns are added in steps so that words are split once; an input column of one
    of these names is replaced.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    bare = body
    for sign in SYMBOLS:
        bare = F.replace(bare, F.lit(sign), F.lit(""))
    zero = F.lit(0).cast("long")
    step = docs.withColumns(
        {
            "__words": word_array(F.col(text)),
            "__lines": F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
            "n_symbols": (F.length(body) - F.length(bare)).cast("long"),
        }
    )
    step = step.withColumns(
        {
            "n_words": F.size("__words").cast("long"),
            "word_chars": F.length(F.array_join("__words", "")).cast("long"),
            "n_lines": F.size("__lines").cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "__shingles": F.when(
                F.size("__words") >= 3,
                F.transform(
                    F.slice("__words", 1, F.size("__words") - 2),
                    lambda w, i: F.xxhash64(
                        w, F.get(F.col("__words"), i + 1), F.get(F.col("__words"), i + 2)
                    ),
                ),
            ),
        }
    ).drop("__lines")
    step = step.withColumn(
        "__again",
        F.when(
            F.size(F.array_distinct("__shingles")) < F.size("__shingles"),
            F.transform(F.col("__shingles"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))),
        ),
    ).drop("__shingles", "__words")
    step = step.withColumn("__order", F.sort_array("__again")).drop("__again")
    same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
    step = step.withColumn(
        "__at",
        F.sort_array(
            F.transform(
                F.filter(
                    "__order",
                    lambda s, j: same(F.get(F.col("__order"), j - 1), s)
                    | same(F.get(F.col("__order"), j + 1), s),
                ),
                lambda s: s["i"],
            )
        ),
    ).drop("__order")
    covered = F.aggregate(
        "__at",
        F.struct(zero.alias("n"), F.lit(-3).alias("last")),
        lambda acc, i: F.struct(
            (acc["n"] + F.least(F.lit(3), i - acc["last"])).cast("long").alias("n"),
            i.alias("last"),
        ),
        lambda acc: acc["n"],
    )
    step = step.withColumn("n_repeat_words", F.coalesce(covered, zero)).drop("__at")
    few = F.col("n_words") < MIN_WORDS
    repeats = 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    return step.withColumn("base_failed", few | repeats)


def _bucket(value: Column) -> Column:
    """Lower edge of the bucket of a whole number: exact below 64, then 1/32 apart."""
    drop = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketches(stats: DataFrame, groups: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """Bucket counts per language, source and metric of the documents that pass the
    base rule: (lang, source, metric, bucket, n). Sketches merge by adding ``n``."""
    values = [
        F.struct(F.lit(name).alias("metric"), _bucket(m.value()).alias("bucket"))
        for name, m in METRICS.items()
    ]
    return (
        stats.filter(~F.col("base_failed"))
        .select(F.col(groups[0]).alias("lang"), F.col(groups[1]).alias("source"),
                F.explode(F.array(*values)).alias("v"))
        .groupBy("lang", "source", "v.metric", "v.bucket")
        .agg(F.count("*").alias("n"))
    )


def _fences(counts: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """One row per group with its document count and a low and high limit per metric."""
    in_order = Window.partitionBy(*keys, "metric").orderBy("bucket")
    whole = Window.partitionBy(*keys, "metric")
    summed = counts.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
    ranked = summed.select(
        *keys, "metric", "bucket",
        F.sum("n").over(in_order).alias("upto"), F.sum("n").over(whole).alias("total"),
    )
    at = lambda q: F.min(F.when(100 * F.col("upto") >= q * F.col("total"), F.col("bucket")))
    quartiles = ranked.groupBy(*keys, "metric").agg(
        F.max("total").alias("total"), at(25).alias("low"), at(75).alias("high")
    )
    floor = F.element_at(
        F.create_map(*[F.lit(x) for name, m in METRICS.items() for x in (name, m.floor)]),
        F.col("metric"),
    )
    reach = FENCE * F.greatest(F.col("high") - F.col("low"), floor)
    limits = quartiles.select(
        *keys, "metric", "total", (F.col("low") - reach).alias("low"),
        (F.col("high") + reach).alias("high"),
    )
    columns = [F.max("total").alias(f"{prefix}n")]
    for name in METRICS:
        mine = F.col("metric") == name
        columns += [
            F.max(F.when(mine, F.col(side))).alias(f"{prefix}{side}_{name}")
            for side in ("low", "high")
        ]
    return limits.groupBy(*keys).agg(*columns)


def thresholds(counts: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """Limits in force for each (lang, source): own, else language-wide, else global, of
    the first that has ``min_group`` documents."""
    own = _fences(counts, ["lang", "source"], "own_")
    by_lang = _fences(counts, ["lang"], "lang_").withColumnRenamed("lang", "of_lang")
    joined = own.join(by_lang, F.col("lang").eqNullSafe(F.col("of_lang")), "left")
    names = [f"{side}_{name}" for name in METRICS for side in ("low", "high")]
    overall = _fences(counts.withColumn("every", F.lit(1)), ["every"], "").first()
    everywhere = overall.asDict() if overall else {}
    return joined.select(
        F.col("lang").alias("of_lang"),
        F.col("source").alias("of_source"),
        *[
            F.when(F.col("own_n") >= min_group, F.col(f"own_{n}"))
            .when(F.col("lang_n") >= min_group, F.col(f"lang_{n}"))
            .otherwise(F.lit(everywhere.get(n)).cast("long"))
            .alias(f"__{n}")
            for n in names
        ],
    )


def judged(
    stats: DataFrame, groups: tuple[str, str] = ("lang", "source"), min_group: int = MIN_GROUP
) -> DataFrame:
    """Add ``kept`` to a table of ``document_statistics`` that is cheap to read twice.

    Limits are joined; they are broadcast only if measured small, else both sides are
    dealt out by language and source, where the adaptive planner splits hot groups.
    """
    limits = stored(thresholds(stored(sketches(stats, groups), "sketches"), min_group), "limits")
    if fits_broadcast(limits):
        limits = F.broadcast(limits)
    inside = F.lit(True)
    for name, m in METRICS.items():
        value = _bucket(m.value())
        inside = inside & (value >= F.col(f"__low_{name}")) & (value <= F.col(f"__high_{name}"))
    match = F.col(groups[0]).eqNullSafe(F.col("of_lang")) & F.col(groups[1]).eqNullSafe(
        F.col("of_source")
    )
    return (
        stats.join(limits, match, "left")
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))
        .drop(*limits.columns)
    )


def quality_verdicts(docs: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """Statistics and verdict of every document, without its text."""
    narrow = docs.select("doc_id", "text", "lang", "source")
    return judged(stored(document_statistics(narrow).drop("text"), "statistics"), min_group=min_group)


def filter_documents(docs: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """The documents that are kept, with the columns they came with."""
    names = docs.columns
    row = F.struct(*[F.col(f"`{n}`") for n in names]).alias("__row")
    packed = docs.select("text", "lang", "source", row)
    stats = stored(document_statistics(packed).drop("text"), "statistics")
    return judged(stats, min_group=min_group).filter("kept").select(*[F.col(f"__row.`{n}`") for n in names])


#: The same in SQL for DuckDB: base statistics, sketches, limits and verdicts.
ORACLE_SQL = r"""
with d as (
  select row_number() over () as r, doc_id, lang, source, coalesce(text, '') as t from documents
), w as (
  select *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
  from d
), sh as (
  select r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as s
  from w, unnest(range(1, len(ws) - 1)) as u(i)
), again as (
  select r, unnest([i, i + 1, i + 2]) as p
  from (select r, i, count(*) over (partition by r, s) as c from sh) where c > 1
), rep as (
  select r, count(distinct p) as n from again group by r
), b as (
  select w.r, doc_id, lang, source, len(ws)::bigint as n_words,
    length(array_to_string(ws, ''))::bigint as word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    len(ls)::bigint as n_lines, (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
    coalesce(rep.n, 0)::bigint as n_repeat_words
  from w left join rep using (r)
), f as (
  select *, (n_words < 50 or 100 * n_repeat_words > 50 * n_words) as base_failed from b
), v as (
  select r, lang, source, base_failed, unnest([
    {'metric': 'word_length', 'v': 1000 * word_chars // greatest(n_words, 1), 'floor': 100},
    {'metric': 'symbols', 'v': 1000 * n_symbols // greatest(n_words, 1), 'floor': 20},
    {'metric': 'dup_lines', 'v': 1000 * n_dup_lines // greatest(n_lines, 1), 'floor': 100},
    {'metric': 'repeats', 'v': 1000 * n_repeat_words // greatest(n_words, 1), 'floor': 80}],
    recursive := true)
  from f
), q as (
  select *, ((v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0)) as bucket
  from v
), g as (
  select unnest([{'lv': 1, 'l': lang, 's': source}, {'lv': 2, 'l': lang, 's': null},
    {'lv': 3, 'l': null, 's': null}], recursive := true), metric, floor, bucket
  from q where not base_failed
), c as (
  select lv, l, s, metric, floor, bucket, count(*) as n from g group by all
), cu as (
  select *, sum(n) over (partition by lv, l, s, metric order by bucket) as upto,
    sum(n) over (partition by lv, l, s, metric) as total from c
), k as (
  select lv, l, s, metric, floor, max(total) as total,
    min(case when 100 * upto >= 25 * total then bucket end) as lo,
    min(case when 100 * upto >= 75 * total then bucket end) as hi
  from cu group by all
), li as (
  select lv, l, s, metric, total, lo - 6 * greatest(hi - lo, floor) as lo,
    hi + 6 * greatest(hi - lo, floor) as hi from k
), ver as (
  select q.r, bool_and(case
      when a.total is null then true
      when a.total >= 200 then q.bucket between a.lo and a.hi
      when b2.total >= 200 then q.bucket between b2.lo and b2.hi
      else q.bucket between c2.lo and c2.hi end) as ok
  from q
  left join li a on a.lv = 1 and a.l is not distinct from q.lang
    and a.s is not distinct from q.source and a.metric = q.metric
  left join li b2 on b2.lv = 2 and b2.l is not distinct from q.lang and b2.metric = q.metric
  left join li c2 on c2.lv = 3 and c2.metric = q.metric
  group by q.r
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (not base_failed and ok) as kept
from f join ver using (r)
"""

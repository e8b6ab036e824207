"""Temperature mixing of sources, realised as a schedule of blocks.

Weights are token shares raised to an exponent between 0 (all sources equal) and 1 (as
they are) and normalised. The exponent is bisected on a grid of 1/1024: the largest that
reaches the target entropy, but not below the smallest that holds the repetition limit.
Five levels of the bisection are evaluated in one job, over one row per source.

The weights are then realised. Each source is read in passes, each pass in a random
order of its own (a hash of row and pass), the last one only as far as the budget goes.
The stream of each source is cut into the same number of blocks, each with its share of
the tokens, and rows are put into a random order within their block. Running sums over a
source are taken in three steps, over groups of ranges of the random key, over the ranges
of a group and within a range, so that no task holds a source; the number of ranges
follows the number of rows.

Without a budget it is the least at which every source is read once in full, so no
document is lost. All amounts are integers: repetition is rounded to 1/10,000.

Edge cases: a null text counts one token (its end), so that every row takes part; a null
source is a source; rows of equal id and text are scheduled one by one; an empty table
gives an empty schedule; other columns pass through whatever their names, but for those a
result adds, which are replaced. A very long text is counted in one task; one of more
tokens than a block lies whole in the block where it begins.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curate.llm.common import delete_folder, owned, packed, stored, unpacked, word_array

TARGET_ENTROPY = 0.95
MAX_REPEATS = 4.0
BLOCK_TOKENS = 100_000
GRID = 1024
STEP = 32
UNIT = 10_000
RANGE_ROWS = 2_000
GROUP_RANGES = 4_096


@dataclass(frozen=True)
class Mix:
    """``target_entropy`` is a share of the largest entropy possible, ``max_repeats`` the
    most passes over any source, ``budget_tokens`` the size of the mixture."""

    target_entropy: float = TARGET_ENTROPY
    max_repeats: float = MAX_REPEATS
    budget_tokens: int | None = None
    block_tokens: int = BLOCK_TOKENS
    seed: int = 0


def _largest_true(holds, low: int, high: int) -> int:
    """Largest grid point in [low, high] for which a falling test holds; ``low`` does."""
    while low < high:
        step = max(1, (high - low) // STEP)
        points = list(range(low + step, high + 1, step))
        results = holds(points)
        good = [p for p, ok in zip(points, results, strict=True) if ok]
        bad = [p for p, ok in zip(points, results, strict=True) if not ok]
        low = max([low, *good])
        high = min([high, *(p - 1 for p in bad)])
    return low


def exponent(sources: DataFrame, mix: Mix) -> float:
    """The exponent for a table with one row per source and its ``tokens``."""
    seen = sources.agg(
        F.count("*").alias("n"), F.max("tokens").alias("most"), F.min("tokens").alias("least"),
        F.sum("tokens").alias("all"),
    ).first()
    if seen["n"] < 2 or seen["least"] == seen["most"]:
        return 1.0
    size = F.log(F.col("tokens") / F.lit(float(seen["most"])))

    def totals(points: list[int]) -> list[tuple[float, float]]:
        asked = []
        for p in points:
            part = F.exp(size * F.lit(p / GRID))
            asked += [F.sum(part), F.sum(part * size * F.lit(p / GRID))]
        row = sources.agg(*[c.alias(f"c{i}") for i, c in enumerate(asked)]).first()
        return [(row[2 * i], row[2 * i + 1]) for i in range(len(points))]

    def entropic(points: list[int]) -> list[bool]:
        least = mix.target_entropy * math.log(seen["n"])
        return [math.log(z) - t / z >= least - 1e-9 for z, t in totals(points)]

    def repeats(p: int, z: float) -> float:
        """Passes over the smallest source, which has the most."""
        relative = (seen["least"] / seen["most"]) ** (p / GRID - 1)
        if mix.budget_tokens is None:
            return relative
        return mix.budget_tokens / seen["most"] / z * relative

    def too_often(points: list[int]) -> list[bool]:
        return [
            repeats(p, z) > mix.max_repeats + 1e-9
            for p, (z, _) in zip(points, totals(points), strict=True)
        ]

    flat = _largest_true(entropic, 0, GRID)
    if not too_often([flat])[0]:
        return flat / GRID
    return min(GRID, _largest_true(too_often, flat, GRID) + 1) / GRID


def source_plan(sources: DataFrame, mix: Mix) -> DataFrame:
    """Add to (source, tokens, n) its passes: ``whole`` ones and ``rest`` tokens of one
    more; ``target`` tokens in all and ``quota`` of them in each of the blocks."""
    alpha = exponent(sources, mix)
    seen = sources.agg(F.max("tokens").alias("most")).first()
    most = float(seen["most"] or 1)
    share = F.pow(F.col("tokens") / F.lit(most), F.lit(alpha - 1))
    if mix.budget_tokens is None:
        often = share
    else:
        z = sources.agg(F.sum(F.pow(F.col("tokens") / F.lit(most), F.lit(alpha)))).first()[0] or 1.0
        often = share * F.lit(mix.budget_tokens / most / z)
    units = F.round(often * UNIT).cast("long")
    plan = sources.withColumn("units", units).select(
        "source", "tokens", "n",
        F.expr(f"units div {UNIT}").alias("whole"),
        F.expr(f"tokens * (units % {UNIT}) div {UNIT}").alias("rest"),
    )
    plan = plan.withColumn("target", F.col("tokens") * F.col("whole") + F.col("rest"))
    total = plan.agg(F.sum("target")).first()[0] or 0
    blocks = max(1, -(-int(total) // mix.block_tokens))
    return plan.withColumns(
        {
            "blocks": F.lit(blocks).cast("long"),
            "quota": F.greatest(F.expr(f"target div {blocks}"), F.lit(1).cast("long")),
        }
    )


def _hex(digest: Column, at: int, digits: int = 10) -> Column:
    """Hexadecimal digits of a digest as a number, below 2**40 for ten of them."""
    return F.conv(F.substring(digest, at, digits), 16, 10).cast("long")


def _before(amount: str, part: list[str], *order: str) -> Column:
    """The sum of what comes earlier in the same part."""
    earlier = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(amount).over(earlier), F.lit(0))


def _joined(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join on columns that may be null."""
    named = right.withColumnsRenamed({c: f"__of{c}" for c in on})
    match = F.lit(True)
    for c in on:
        match = match & F.col(c).eqNullSafe(F.col(f"__of{c}"))
    return left.join(named, match).drop(*[f"__of{c}" for c in on])


ADDED = ("epoch", "block", "position")


def schedule(items: DataFrame, mix: Mix = Mix(), key: str = "doc_id") -> DataFrame:
    """Schedule a table with ``key``, ``source`` and ``n_tokens`` (1 or more each).

    Adds ``epoch`` (the pass), ``block`` and ``position`` in the block, both from zero,
    one row for each time a row is read. Other columns pass through; those that are named
    like an added one are replaced.
    """
    names = [c for c in items.columns if c.lower() not in ADDED]
    own = [key, "source", "n_tokens"]
    others = [F.col(f"`{c}`") for c in names if c not in own]
    row = [F.struct(*others).alias("__row")] if others else []
    items = stored(items.select(*own, *row), "items")
    sources = stored(
        items.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n")),
        "sources",
    )
    plan = stored(source_plan(sources, mix), "plan").select(
        "source", F.struct("tokens", "n", "whole", "rest", "blocks", "quota").alias("__plan")
    )
    # A hot source is split by the adaptive planner; the plan has one row per source.
    planned = _joined(items, plan, ["source"])
    last = F.col("__plan.whole") - F.when(F.col("__plan.rest") > 0, 0).otherwise(1)
    reads = planned.filter(last >= 0).withColumn(
        "__epoch", F.explode(F.sequence(F.lit(0).cast("long"), last))
    )
    # The whole row, so that rows without an id, or with one id, spread like any others.
    whole_row = F.xxhash64(*[F.col(c) for c in items.columns])
    name = F.concat_ws(":", F.lit(str(mix.seed)), F.col("__epoch"), F.col(key), whole_row)
    ranges = F.ceil(F.col("__plan.n") / RANGE_ROWS).cast("long")
    reads = reads.withColumn("__digest", F.md5(name.cast("binary"))).withColumns(
        {
            "__turn": _hex(F.col("__digest"), 1),
            "__in_block": _hex(F.col("__digest"), 11),
            # The first 36 bits of the turn, as those of a large source times its ranges
            # must stay below 2**63.
            "__range": F.shiftright(_hex(F.col("__digest"), 1, 9) * ranges, 36),
        }
    ).drop("__digest")
    reads = stored(reads, "reads")
    a_pass, a_range = ["source", "__epoch"], ["source", "__epoch", "__range"]
    sums = stored(reads.groupBy(*a_range).agg(F.sum("n_tokens").alias("__n")), "sums")
    sums = sums.withColumn("__group", F.expr(f"__range div {GROUP_RANGES}"))
    groups = sums.groupBy(*a_pass, "__group").agg(F.sum("__n").alias("__n")).select(
        *a_pass, "__group", _before("__n", a_pass, "__group").alias("__group_start")
    )
    in_group = sums.withColumn("__in_group", _before("__n", [*a_pass, "__group"], "__range"))
    starts = _joined(in_group, groups, [*a_pass, "__group"]).select(
        *a_range, (F.col("__group_start") + F.col("__in_group")).alias("__range_start")
    )
    placed = (
        _joined(reads, starts, a_range)
        .withColumn(
            "__start", F.col("__range_start") + _before("n_tokens", a_range, "__turn", key, "n_tokens")
        )
        .filter((F.col("__epoch") < F.col("__plan.whole")) | (F.col("__start") < F.col("__plan.rest")))
    )
    blocked = placed.withColumn(
        "__block",
        F.expr("least((__epoch * __plan.tokens + __start) div __plan.quota, __plan.blocks - 1)"),
    )
    in_block = Window.partitionBy("__block").orderBy("__in_block", key, "source", "__epoch", "n_tokens")
    return blocked.withColumn("__position", (F.row_number().over(in_block) - 1).cast("long")).select(
        *[F.col(c) if c in own else F.col(f"__row.`{c}`").alias(c) for c in names],
        *[F.col(f"__{c}").alias(c) for c in ADDED],
    )


def counted(docs: DataFrame, text: str = "text") -> Column:
    """Tokens of a text for mixing: its words and one end."""
    return (F.size(word_array(F.col(text))) + 1).cast("long").alias("n_tokens")


def _items(named: DataFrame, key: str, text: str) -> DataFrame:
    """What is scheduled: each document by its key, source, size and the hash of its text."""
    return named.select(key, "__row.source", counted(named, text), "__th")


def mix_documents(
    docs: DataFrame, mix: Mix = Mix(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Schedule of documents: (key, source, n_tokens, epoch, block, position)."""
    return schedule(_items(packed(docs, key, text), key, text), mix, key).drop("__th")


def realise(docs: DataFrame, mix: Mix = Mix(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents themselves, each as often as the schedule of ``mix_documents`` reads
    it, in the order of block and position.

    Rows with equal id and text are one document here, with the reads of all of them.
    """
    named = packed(docs, key, text)
    name = F.coalesce(F.col(key), F.lit(0).cast(docs.schema[key].dataType)).alias("__id")
    with owned() as folders:
        planned = schedule(_items(named, key, text), mix, key)
        places = stored(planned.select(name, "__th", "block", "position"), "places")
    for folder in folders:
        if folder != places.stored_in:  # what the schedule was made of
            delete_folder(docs.sparkSession, folder)
    rows = named.select("__row", "__id", "__th").dropDuplicates(["__id", "__th"])
    return unpacked(rows.join(places, ["__id", "__th"]).orderBy("block", "position"), docs.columns)

"""Spelling variants: words one edit apart, found in a bidirectional FM-index.

The words of a group stand in one text, each after a delimiter. The index has the
Burrows-Wheeler transform of that text and of its reverse, each in a wavelet matrix; a
pattern is a pair of equally long intervals of suffix ranks, one in either, which can be
extended to the left or to the right. If two words differ by one inserted, deleted or
replaced character, then the first or the second half of the one stands unchanged in the
other, at its begin or at its end. So two searches are enough: match the first half
exactly, to the left, as far as the delimiter, and extend to the right across the second
half and the delimiter with one error; and the mirror image of this.

Words are dealt out by their halves, so that a search meets all its partners: a word is
indexed under each prefix that can be the first half of a word one character shorter,
equally long or longer, and under each such suffix; it is searched under its own two
halves. Many halves share a group of about ``GROUP_WORDS`` words. A half that more than
``SPLIT_WORDS`` words share is split over several groups by a hash of the indexed word,
and searched in all of them, so no group is unbounded and no pair is lost.

Edge cases: null and empty texts have no words; texts of any length are read in full, in
memory one at a time; ties of counts go to the smaller word in code-point order; a word
without a near word has a null form and is its own root; rows with equal id and text
count twice; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curate.llm.common import stored

MIN_CHARACTERS = 7
MIN_COUNT = 2
RATIO = 10
GROUP_WORDS = 30_000
SPLIT_WORDS = 10_000
FLUSH_WORDS = 200_000
#: Searches that are carried on together, which bounds memory.
LANES = 4_000

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SLIP = 31


def slipped(key: int | None, word: str) -> str:
    """A word with the slip of the pen that ``op11_spelling`` makes in some documents."""
    if key is None:
        return word
    h = zlib.crc32(f"{key}:{word}".encode())
    if h % SLIP:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def _count(
    batches: Iterator[pa.RecordBatch], rewrite: Callable | None, characters: int
) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def out() -> pa.RecordBatch:
        columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
        counts.clear()
        return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    for batch in batches:
        for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
            lowered = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
            for word, n in Counter(RUN.findall(lowered)).items():
                if len(word) < characters:
                    continue
                word = rewrite(key, word) if rewrite else word
                if len(word) >= characters:
                    counts[word] += n
            if len(counts) > FLUSH_WORDS:
                yield out()
    if counts:
        yield out()


def word_counts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", characters: int = MIN_CHARACTERS,
    least: int = MIN_COUNT, rewrite: Callable | None = None,
) -> DataFrame:
    """(word, n): runs of letters of ``characters`` or more, counted over all texts.

    ``rewrite(key, word)`` may shorten the words of a document.
    """
    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return (
        slim.mapInArrow(partial(_count, rewrite=rewrite, characters=characters), "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= least)
    )


class WaveletMatrix:
    """Numbers of ``levels`` bits, with the count of each number, and of smaller ones, in
    any interval."""

    def __init__(self, numbers: np.ndarray, levels: int):
        self.levels, self.n = levels, len(numbers)
        self.zeros, self.split = [], []
        now = numbers
        for level in range(levels - 1, -1, -1):
            bit = (now >> level) & 1
            self.zeros.append(np.concatenate([[0], np.cumsum(bit == 0)]).astype(np.int32))
            self.split.append(int(self.zeros[-1][-1]))
            now = np.concatenate([now[bit == 0], now[bit == 1]])
        self.first = np.searchsorted(np.sort(numbers), np.arange(1 << levels))
        origin = np.zeros(1 << levels, dtype=np.int64)
        self.origin, *_ = self._down(np.arange(1 << levels), origin, origin)

    def _down(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        smaller = np.zeros(len(symbol), dtype=np.int64)
        for i in range(self.levels):
            one = ((symbol >> (self.levels - 1 - i)) & 1).astype(bool)
            zero_low, zero_high = self.zeros[i][low], self.zeros[i][high]
            smaller += np.where(one, zero_high - zero_low, 0)
            low = np.where(one, self.split[i] + low - zero_low, zero_low)
            high = np.where(one, self.split[i] + high - zero_high, zero_high)
        return low, high, smaller

    def step(self, symbol: np.ndarray, low: np.ndarray, size: np.ndarray):
        """Intervals after one more ``symbol``: their begin and size, and how many smaller
        symbols the old ones hold."""
        at, end, smaller = self._down(symbol, low, low + size)
        return self.first[symbol] + at - self.origin[symbol], end - at, smaller

    def children(self, low: np.ndarray, size: np.ndarray):
        """(interval, symbol, begin, size, smaller) for each symbol in each interval."""
        lane, high = np.arange(len(low)), low + size
        symbol, smaller = np.zeros(len(low), dtype=np.int64), np.zeros(len(low), dtype=np.int64)
        for i in range(self.levels):
            zero_low, zero_high = self.zeros[i][low].astype(np.int64), self.zeros[i][high].astype(np.int64)
            one_low, one_high = self.split[i] + low - zero_low, self.split[i] + high - zero_high
            left, right = zero_high > zero_low, one_high > one_low
            smaller = np.concatenate([smaller[left], (smaller + zero_high - zero_low)[right]])
            symbol = np.concatenate([2 * symbol[left], 2 * symbol[right] + 1])
            lane = np.concatenate([lane[left], lane[right]])
            low = np.concatenate([zero_low[left], one_low[right]])
            high = np.concatenate([zero_high[left], one_high[right]])
        return lane, symbol, self.first[symbol] + low - self.origin[symbol], high - low, smaller


def rotation_order(text: np.ndarray) -> np.ndarray:
    """Begins of all rotations in order, by doubling; no two rotations may be equal."""
    rank, reach = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
    while True:
        key = rank * len(text) + np.roll(rank, -reach)
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.empty_like(rank)
        fresh[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if fresh[order[-1]] == len(text) - 1:
            return order
        rank, reach = fresh, 2 * reach


LEFT, RIGHT = 0, 1


class BidirectionalIndex:
    """Both directions of the text ``#word#word...``, read as a ring.

    A pattern has an interval in the index of either direction; both are equally long.
    """

    def __init__(self, words: list[str]):
        letters = sorted(set("".join(words)))
        self.codes = {c: i + 1 for i, c in enumerate(letters)}  # 0 is the delimiter
        self.words = words
        lengths = np.array([len(w) + 1 for w in words])
        self.begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        text = np.zeros(int(lengths.sum()), dtype=np.int64)
        inside = np.ones(len(text), dtype=bool)
        inside[self.begins] = False
        known = np.array([ord(c) for c in letters], dtype=np.int64)
        text[inside] = np.searchsorted(known, points) + 1
        levels = max(1, len(letters).bit_length())
        self.order = rotation_order(text)
        back = text[::-1]
        order = rotation_order(back)
        self.matrices = (
            WaveletMatrix(text[self.order - 1], levels), WaveletMatrix(back[order - 1], levels)
        )

    def coded(self, word: str) -> list[int]:
        """Numbers of the letters; -1 for one that no indexed word has."""
        return [self.codes.get(c, -1) for c in word]

    def extend(self, way: int, symbol: np.ndarray, low: np.ndarray, size: np.ndarray):
        """``low`` has a row for each direction. An unknown symbol leaves nothing."""
        at, left, smaller = self.matrices[way].step(np.maximum(symbol, 0), low[way], size)
        out = np.empty_like(low)
        out[way], out[1 - way] = at, low[1 - way] + smaller
        return out, np.where(symbol >= 0, left, 0)

    def near(self, words: list[str], first_half: bool) -> tuple[np.ndarray, np.ndarray]:
        """(number of searched word, number of indexed word) of all pairs one edit apart
        that share the first or the second half of the searched word. A pair may come twice."""
        found = [self._near(words[i : i + LANES], first_half, i) for i in range(0, len(words), LANES)]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])

    def _near(self, words: list[str], first_half: bool, offset: int) -> tuple[np.ndarray, np.ndarray]:
        exact, rest = [], []
        for word in words:
            codes = self.coded(word)
            head, tail = codes[: len(codes) // 2], codes[len(codes) // 2 :]
            exact.append([*head[::-1], 0] if first_half else [*tail, 0])
            rest.append([*tail, 0] if first_half else [*head[::-1], 0])
        across = RIGHT if first_half else LEFT
        sure, _ = _table(exact)
        pattern, length = _table(rest)
        lane = np.arange(len(words))
        low = np.zeros((2, len(words)), dtype=np.int64)
        size = np.full(len(words), self.matrices[0].n)
        for t in range(sure.shape[1]):
            more = sure[lane, t] != _END
            moved, left = self.extend(1 - across, sure[lane[more], t], low[:, more], size[more])
            low[:, more], size[more] = moved, left
            alive = size > 0
            lane, low, size = lane[alive], low[:, alive], size[alive]
        # Searches without an error so far stand at the same place t; those with one
        # error each have a place of their own.
        one = _Lanes.none()
        done_lane, done_low = [], []
        for t in range(pattern.shape[1] + 1):
            more = t < length[lane]
            lane, low, size = lane[more], low[:, more], size[more]
            new = [one]
            if len(lane):
                wanted, after = pattern[lane, t], pattern[lane, np.minimum(t + 1, pattern.shape[1] - 1)]
                skip = (wanted != 0) & (after != wanted)
                new.append(_Lanes(lane[skip], np.full(skip.sum(), t + 1), low[:, skip], size[skip]))
                of, symbol, at, many, smaller = self.matrices[across].children(low[across], size)
                moved = np.empty((2, len(of)), dtype=np.int64)
                moved[across], moved[1 - across] = at, low[1 - across][of] + smaller
                other = (symbol != wanted[of]) & (symbol != 0)
                new.append(_Lanes(lane[of[other]], np.full(other.sum(), t), moved[:, other], many[other]))
                other &= wanted[of] != 0
                new.append(_Lanes(lane[of[other]], np.full(other.sum(), t + 1), moved[:, other], many[other]))
                same = symbol == wanted[of]
                lane, low, size = lane[of[same]], moved[:, same], many[same]
            one = _Lanes.joined(new)
            one, (ended, at) = self._exactly(one, pattern, length, across)
            done_lane.append(ended)
            done_low.append(at)
        while len(one.lane):
            one, (ended, at) = self._exactly(one, pattern, length, across)
            done_lane.append(ended)
            done_low.append(at)
        place = self.order[np.concatenate(done_low)]
        return np.concatenate(done_lane) + offset, np.searchsorted(self.begins, place)

    def _exactly(self, one: _Lanes, pattern: np.ndarray, length: np.ndarray, across: int):
        """Carries searches with one error on by one symbol; gives out those that end."""
        low, size = self.extend(across, pattern[one.lane, one.place], one.low, one.size)
        alive = size > 0
        lane, place, low, size = one.lane[alive], one.place[alive] + 1, low[:, alive], size[alive]
        ended = place == length[lane]
        more = ~ended
        return _Lanes(lane[more], place[more], low[:, more], size[more]), (lane[ended], low[LEFT][ended])


_END = -2


def _table(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of unequal length as one array, with their lengths."""
    length = np.array([len(r) for r in rows], dtype=np.int64)
    table = np.full((len(rows), int(length.max(initial=1))), _END, dtype=np.int64)
    for i, row in enumerate(rows):
        table[i, : len(row)] = row
    return table, length


class _Lanes:
    """Searches with one error: word, place in its pattern, intervals."""

    def __init__(self, lane: np.ndarray, place: np.ndarray, low: np.ndarray, size: np.ndarray):
        self.lane, self.place, self.low, self.size = lane, place, low, size

    @staticmethod
    def none() -> _Lanes:
        nothing = np.zeros(0, dtype=np.int64)
        return _Lanes(nothing, nothing, np.zeros((2, 0), dtype=np.int64), nothing)

    @staticmethod
    def joined(parts: list[_Lanes]) -> _Lanes:
        return _Lanes(
            np.concatenate([p.lane for p in parts]), np.concatenate([p.place for p in parts]),
            np.concatenate([p.low for p in parts], axis=1), np.concatenate([p.size for p in parts]),
        )


def _search(rows: pd.DataFrame) -> pd.DataFrame:
    """Near pairs of one group: its indexed words against its searched words."""
    indexed = rows[rows["indexed"]].drop_duplicates("word")
    asked = rows[~rows["indexed"]].drop_duplicates("word")
    out = pd.DataFrame({"word": [], "n": [], "near": [], "near_n": []}).astype(
        {"word": str, "n": "int64", "near": str, "near_n": "int64"}
    )
    if indexed.empty or asked.empty:
        return out
    index = BidirectionalIndex(indexed["word"].tolist())
    a, b = index.near(asked["word"].tolist(), bool(rows["first_half"].iat[0]))
    return pd.DataFrame(
        {
            "word": asked["word"].to_numpy()[a], "n": asked["n"].to_numpy()[a],
            "near": indexed["word"].to_numpy()[b], "near_n": indexed["n"].to_numpy()[b],
        }
    )


def _halves(first_half: bool, lengths: list[Column]) -> Column:
    word = F.col("word")
    parts = [
        F.substring(word, F.lit(1), n) if first_half else F.substring(word, F.length(word) - n + 1, n)
        for n in lengths
    ]
    return F.array_distinct(F.array(*parts))


def near_pairs(words: DataFrame, group_words: int = GROUP_WORDS, split_words: int = SPLIT_WORDS) -> DataFrame:
    """(word, n, near, near_n) of all words one edit apart, in both directions, from a table
    (word, n) with one row for each word. A pair may come twice."""
    half = {
        True: lambda n: F.floor(n / 2).cast("int"),
        False: lambda n: F.ceil(n / 2).cast("int"),
    }
    length = F.length("word")
    sides = []
    for first_half, of in half.items():
        for indexed in (True, False):
            lengths = [of(length - 1), of(length), of(length + 1)] if indexed else [of(length)]
            sides.append(
                words.select(
                    "word", "n", F.lit(first_half).alias("first_half"), F.lit(indexed).alias("indexed"),
                    F.explode(_halves(first_half, lengths)).alias("half"),
                )
            )
    rows = sides[0].unionByName(sides[1]).unionByName(sides[2]).unionByName(sides[3])
    total = words.count()
    groups = max(1, math.ceil(2 * total / group_words))
    # More than split_words words each: there are fewer than 4 * total / split_words of them.
    hot = (
        rows.filter("indexed")
        .groupBy("first_half", "half")
        .agg(F.count("*").alias("many"))
        .filter(F.col("many") > split_words)
        .select("first_half", "half", F.ceil(F.col("many") / split_words).cast("int").alias("parts"))
    )
    hot = stored(hot, "hot")
    parts = F.coalesce("parts", F.lit(1))
    own = F.array(F.pmod(F.xxhash64("word"), parts).cast("int"))
    every = F.sequence(F.lit(0), parts - 1)
    dealt = (
        rows.join(hot, ["first_half", "half"], "left")
        .withColumn("part", F.explode(F.when(F.col("indexed"), own).otherwise(every)))
        .withColumn("group", F.pmod(F.xxhash64("half", "part"), F.lit(groups)))
        .select("first_half", "group", "indexed", "word", "n")
    )
    return dealt.groupBy("first_half", "group").applyInPandas(
        _search, "word string, n long, near string, near_n long"
    )


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for a table (word, n), one row for each word.

    The form of a word is its most frequent near word, if that is ``ratio`` times as
    frequent; roots are found by following forms, twice as far in each round.
    """
    if ratio < 2:
        raise ValueError("forms must grow, or following them need not end")
    words = stored(words, "words")
    near = (
        near_pairs(words)
        .groupBy("word")
        .agg(F.collect_set(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("near"))
        .select("word", F.size("near").cast("long").alias("n_near"), F.array_min("near").alias("best"))
    )
    fits = -F.col("best.less") >= F.col("n") * ratio
    found = stored(
        words.join(near, "word", "left").select(
            "word", F.when(fits, F.col("best.near")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(fits, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    # Counts grow by the ratio at each step, which bounds how far a root can be.
    ends = found.agg(F.max("n").alias("most"), F.min("n").alias("least")).first()
    steps = 0 if ends["most"] is None else int(math.log(ends["most"] / ends["least"], ratio)) + 1
    hops = found.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    reach = 1
    while reach < steps:
        on = hops.select(F.col("word").alias("root"), F.col("root").alias("further"))
        hops = stored(
            hops.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "hops"
        )
        reach *= 2
    return found.join(hops, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Variants among the words of all texts; ``options`` as for ``word_counts``."""
    return group_variants(word_counts(docs, key, text, **options))

"""Periodic runs of words by block convolution.

A run is a longest stretch of words that repeats with a smallest period q at least four
times. At the dyadic scale B (a power of two) the words are cut into blocks of B, and
each block is compared with the words after it at all distances B to 2B at once: the sum
of squared differences of word numbers is ``sum(x^2) + sum(y^2) - 2 sum(x y)``, whose
last term is a convolution, taken exactly by a number-theoretic transform modulo a prime.
A run of a period in [B, 2B) has two neighbouring blocks or more that come again at that
distance without a mismatch. These distances are the seeds; neighbouring seeds are joined
and extended word by word in both directions.

Word numbers are small, so a difference of zero modulo the prime is nearly always a true
one; each seed is compared word by word all the same, so results are exact. Blocks that
cannot come again are not transformed: those with a word that does not return within the
window, and those that lie, window and all, in a run found at a smaller scale.

Nothing is shuffled: a document is the work of one task, at n log^2 n steps for n words.
The documents of a batch are laid end to end, with a number of its own between any two,
so that short documents share a transform.

Edge cases: null and empty texts have no words and no runs; a very long text is held by
one worker, with some 100 bytes for each of its words, up to 2^28 words, beyond which the
task raises; equal rows each get their own result; an empty table gives an empty result;
other columns pass through ``collapse`` and do not matter elsewhere.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curate.llm.tokenization import small_batches

PERIODS = 4
MIN_LENGTH = 6

#: 15 * 2^27 + 1, with the primitive root 31: transforms of up to 2^27 numbers.
PRIME = 2_013_265_921
ROOT = 31
MOST_WORDS = 1 << 28
#: Numbers in one call of the transform, which bounds its memory.
CHUNK = 1 << 21


@lru_cache(maxsize=64)
def _roots(size: int, inverse: bool) -> np.ndarray:
    """Powers of a root of unity of order ``size``, half of them."""
    base = pow(ROOT, (PRIME - 1) // size, PRIME)
    base = pow(base, PRIME - 2, PRIME) if inverse else base
    powers = np.ones(max(1, size // 2), dtype=np.uint64)
    filled = 1
    while filled < len(powers):
        step = np.uint64(pow(base, filled, PRIME))
        powers[filled : 2 * filled] = powers[:filled] * step % PRIME
        filled *= 2
    return powers


def _forward(rows: np.ndarray) -> np.ndarray:
    """Transform of each row, in bit-reversed order, by halving."""
    m, size = rows.shape
    x, half = rows, size // 2
    while half:
        x = x.reshape(m, -1, 2, half)
        a, b = x[:, :, 0], x[:, :, 1]
        out = np.empty_like(x)
        out[:, :, 0] = (a + b) % PRIME
        out[:, :, 1] = (a + (PRIME - b)) % PRIME * _roots(2 * half, False) % PRIME
        x, half = out, half // 2
    return x.reshape(m, size)


def _backward(rows: np.ndarray) -> np.ndarray:
    """Undoes ``_forward``."""
    m, size = rows.shape
    x, half = rows, 1
    while half < size:
        x = x.reshape(m, -1, 2, half)
        a, b = x[:, :, 0], x[:, :, 1] * _roots(2 * half, True) % PRIME
        out = np.empty_like(x)
        out[:, :, 0] = (a + b) % PRIME
        out[:, :, 1] = (a + (PRIME - b)) % PRIME
        x, half = out, half * 2
    return x.reshape(m, size) * np.uint64(pow(size, PRIME - 2, PRIME)) % PRIME


def zero_mismatches(x: np.ndarray, blocks: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, distance) of all places, ``size`` to ``2 * size - 1`` words on, where a
    block of ``size`` numbers comes again; ``x`` must reach three blocks past each."""
    found_blocks, found = [], []
    for at in range(0, len(blocks), max(1, CHUNK // (2 * size))):
        some = blocks[at : at + max(1, CHUNK // (2 * size))]
        start = some[:, None] * size
        block = x[start + np.arange(size)]
        window = x[start + size + np.arange(2 * size)]
        turned = np.zeros_like(window)
        turned[:, :size] = block[:, ::-1]
        products = _backward(_forward(turned) * _forward(window) % PRIME)[:, size - 1 : 2 * size - 1]
        squares = np.zeros((len(some), 2 * size + 1), dtype=np.uint64)
        np.cumsum(window * window % PRIME, axis=1, out=squares[:, 1:])
        of_window = (squares[:, size : 2 * size] - squares[:, :size]) % PRIME
        of_block = (block * block % PRIME).sum(axis=1) % PRIME
        differences = (of_block[:, None] + of_window + 2 * (PRIME - products)) % PRIME
        row, lag = np.nonzero(differences == 0)
        found_blocks.append(some[row])
        found.append(lag + size)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    block, distance = np.concatenate(found_blocks), np.concatenate(found)
    same = np.ones(len(block), dtype=bool)
    for at in range(0, len(block), max(1, CHUNK // size)):
        some = slice(at, at + max(1, CHUNK // size))
        place = block[some, None] * size + np.arange(size)
        same[some] = (x[place] == x[place + distance[some, None]]).all(axis=1)
    return block[same], distance[same]


def _next_same(x: np.ndarray) -> np.ndarray:
    """How many words on each word comes next; very far where it does not."""
    order = np.argsort(x, kind="stable")
    gap = np.full(len(x), 1 << 40, dtype=np.int64)
    same = x[order[1:]] == x[order[:-1]]
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return gap


def find_runs(
    codes: np.ndarray, periods: int = PERIODS, min_length: int = MIN_LENGTH, longest: int | None = None
) -> list[tuple[int, int, int]]:
    """All (start, length, period) of an array of word numbers, by start, then period.

    ``periods`` is the least number of repeats, four or more, since two neighbouring
    blocks must fit; ``longest`` bounds the length of any run, if the caller knows it.
    """
    if periods < PERIODS:
        raise ValueError(f"runs of fewer than {PERIODS} periods are not seeded")
    n = len(codes)
    if n > MOST_WORDS:
        raise ValueError(f"{n} words at once are more than the transform holds")
    longest = n if longest is None else longest
    runs: list[tuple[int, int, int]] = []
    if n < 2:
        return runs
    gap = _next_same(codes)
    size = 1
    while periods * size <= longest:
        count = -(-n // size)
        # Beyond the end each number differs from all others, so nothing matches there.
        beyond = np.arange(count * size + 3 * size - n, dtype=np.uint64) + np.uint64(int(codes.max()) + 1)
        x = np.concatenate([codes.astype(np.uint64), beyond])
        far = np.full(count * size, 1 << 40, dtype=np.int64)
        far[:n] = gap
        blocks = np.flatnonzero(far.reshape(count, size).max(axis=1) < 2 * size)
        blocks = blocks[~_inside(runs, blocks * size, (blocks + 3) * size)]
        if len(blocks):
            block, distance = zero_mismatches(x, blocks, size)
            runs += _extended(x, n, size, block, distance, min_length, periods, runs)
        size *= 2
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _extended(
    x: np.ndarray, n: int, size: int, block: np.ndarray, distance: np.ndarray,
    least: int, periods: int, runs: list[tuple[int, int, int]],
) -> list[tuple[int, int, int]]:
    """Runs of one scale: neighbouring seeds joined, extended, and left out where they lie
    in a run of a smaller period."""
    order = np.lexsort((block, distance))
    block, distance = block[order], distance[order]
    opens = np.ones(len(block), dtype=bool)
    opens[1:] = (np.diff(distance) != 0) | (np.diff(block) != 1)
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(block))[: len(first)] - 1
    found = set()
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        if a == b:
            continue
        q, low, high = int(distance[a]), int(block[a]) * size, (int(block[b]) + 1) * size
        while low:
            back = max(0, low - 2 * size)
            differs = np.flatnonzero(x[back:low] != x[back + q : low + q])
            if len(differs):
                low = back + int(differs[-1]) + 1
                break
            low = back
        while high < n - q:
            on = min(high + 2 * size, n - q)
            differs = np.flatnonzero(x[high:on] != x[high + q : on + q])
            if len(differs):
                high += int(differs[0])
                break
            high = on
        if high + q - low >= max(least, periods * q):
            found.add((low, high + q - low, q))
    if not found:
        return []
    candidates = sorted(found)
    inside = _inside(runs, np.array([s for s, _, _ in candidates]), np.array([s + n for s, n, _ in candidates]))
    return [c for c, i in zip(candidates, inside.tolist(), strict=True) if not i]


def _inside(runs: list[tuple[int, int, int]], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether each stretch lies in one of the runs."""
    if not runs:
        return np.zeros(len(low), dtype=bool)
    by_start = sorted((s, s + length) for s, length, _ in runs)
    starts = np.array([s for s, _ in by_start])
    ends = np.maximum.accumulate(np.array([e for _, e in by_start]))
    before = np.searchsorted(starts, low, side="right") - 1
    return (before >= 0) & (ends[np.maximum(before, 0)] >= high)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def planted(key: int | None, n: int) -> np.ndarray | None:
    """Which original word stands at each place, for documents that are made periodic; the
    rule of ``op12_periodic_runs``."""
    if key is None or not n:
        return None
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    return np.where(places < a, places, a + (places - a) % p)


def _batch_runs(
    keys: list, texts: list[str | None], rewrite: Callable | None, periods: int, min_length: int
) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """Words and runs of each document, found together."""
    documents = []
    for key, text in zip(keys, texts, strict=True):
        words = words_of(text)
        places = rewrite(key, len(words)) if rewrite else None
        documents.append(words if places is None else [words[i] for i in places.tolist()])
    lengths = np.array([len(w) for w in documents], dtype=np.int64)
    flat = pa.array([w for words in documents for w in words], pa.large_binary()).dictionary_encode()
    numbers = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    distinct = len(flat.dictionary)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    codes = np.zeros(int(starts[-1]), dtype=np.int64)
    inside = np.ones(len(codes), dtype=bool)
    ends = starts[1:] - 1
    inside[ends] = False
    codes[inside] = numbers
    codes[ends] = distinct + np.arange(len(ends))
    runs = find_runs(codes, periods, min_length, int(lengths.max(initial=0)))
    at = 0
    for i, words in enumerate(documents):
        mine = []
        while at < len(runs) and runs[at][0] < starts[i + 1]:
            start, length, q = runs[at]
            mine.append((start - int(starts[i]), length, q))
            at += 1
        yield words, mine


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words outside all runs and those of the first period of some run alone."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, q in runs:
        gone[start + q] += 1
        gone[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(gone)[:-1] == 0).tolist()]


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _scan(
    batches: Iterator[pa.RecordBatch], rewrite: Callable | None, periods: int, min_length: int,
    digests: bool,
) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches):
        found = list(
            _batch_runs(batch.column("key").to_pylist(), batch.column("text").to_pylist(), rewrite, periods, min_length)
        )
        lists = [[{"start": s, "length": n, "period": q} for s, n, q in runs] for _, runs in found]
        left = [b" ".join(collapsed(words, runs)) for words, runs in found]
        rest = [n for n in batch.schema.names if n != "text"]
        columns = [*[batch.column(n) for n in rest], pa.array(lists, _RUNS)]
        if digests:
            lines = ["".join(f"{s},{n},{q}\n" for s, n, q in runs) for _, runs in found]
            columns += [
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in lines], pa.string()),
                pa.array([hashlib.sha256(t).hexdigest() for t in left], pa.string()),
            ]
            names = [*rest, "runs", "runs_sha256", "collapsed_sha256"]
        else:
            texts = batch.column("text").to_pylist()
            for i, (_, runs) in enumerate(found):
                if runs:
                    texts[i] = left[i].decode("utf-8", "surrogatepass")
            columns.append(pa.array(texts, pa.string()))
            names = [*rest, "runs", "text"]
        yield pa.RecordBatch.from_arrays(columns, names=names)


_RUNS_SQL = "array<struct<start:long,length:long,period:long>>"


def document_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", periods: int = PERIODS,
    min_length: int = MIN_LENGTH, rewrite: Callable | None = None,
) -> DataFrame:
    """One row for each row of ``docs``: (key, runs, runs_sha256, collapsed_sha256).

    ``rewrite(key, n)`` may say which of the n words stands at each place.
    """
    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    work = partial(_scan, rewrite=rewrite, periods=periods, min_length=min_length, digests=True)
    kind = docs.schema[key].dataType.simpleString()
    return slim.mapInArrow(
        work, f"key {kind}, runs {_RUNS_SQL}, runs_sha256 string, collapsed_sha256 string"
    ).withColumnRenamed("key", key)


def run_report(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per row the number of runs, the greatest one and digests of all of them."""
    best = F.element_at(
        F.array_sort(
            F.transform(
                "runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("s"), r["period"].alias("q"))
            )
        ),
        1,
    )
    best = F.when(F.size("runs") > 0, best)  # an empty list has no first element
    reported = document_runs(docs, key, text, **options).withColumn("best", best)
    length, period = -F.col("best.n"), F.col("best.q")
    return reported.select(
        key, F.size("runs").cast("long").alias("n_runs"), F.col("best.s").alias("start"),
        length.alias("length"), period.alias("period"),
        F.floor(length * 1000 / period).cast("long").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )


def collapse(
    docs: DataFrame, key: str = "doc_id", text: str = "text", periods: int = PERIODS,
    min_length: int = MIN_LENGTH,
) -> DataFrame:
    """The documents with each run cut to its first period; words of changed texts are
    joined by single spaces, other texts stay as they are."""
    boxed = docs.select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.struct(*docs.columns).alias("row")
    )
    work = partial(_scan, rewrite=None, periods=periods, min_length=min_length, digests=False)
    row = boxed.schema["row"].dataType.simpleString()
    kind = docs.schema[key].dataType.simpleString()
    cut = boxed.mapInArrow(work, f"key {kind}, row {row}, runs {_RUNS_SQL}, text string")
    return cut.select(
        *[(F.col("text") if c == text else F.col("row")[c]).alias(c) for c in docs.columns]
    )

"""Best-fit packing of tokenized documents, with certified numbers of sequences.

Pieces are dealt out at random to partitions of a bounded number of rows. Each partition
packs its pieces by best-fit decreasing and computes a lower bound on its number of
sequences from two families of dual feasible functions. Where the bound is reached the
partition is certified; only its emptiest sequence may still change. Where there is a
gap, all its sequences that are not full are taken apart. What is left over is dealt out
anew, mixed over the partitions it came from, and packed again by the same rule, as long
as that saves sequences.

Edge cases: a null or empty text is its end id alone; documents longer than a sequence
are cut into full pieces, the first of them shorter; equal rows are packed one by one; an
empty table gives an empty result; other columns do not matter. A very long text is
encoded in the memory of one worker.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curate.llm.common import stored
from curate.llm.tokenization import END_ID, encoder, small_batches, vocabulary_path

CAPACITY = 1024
GROUP_ROWS = 25_000
#: What the ids of sequences have room for; the exchange ends before, when a round saves
#: nothing.
MAX_ROUNDS = 127


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of a document of ``n`` ids."""
    first = n % capacity or capacity
    ends = range(first, n + 1, capacity)
    return [(0 if e == first else e - capacity, e) for e in ends]


def _pieces(
    batches: Iterator[pa.RecordBatch], path: str, capacity: int, with_ids: bool
) -> Iterator[pa.RecordBatch]:
    coder = encoder(path)
    end = np.array([END_ID], dtype="<u4").tobytes()
    for batch in small_batches(batches):
        rows, crc, tokens = [], [], []
        for at, coded in enumerate(coder.encode(batch.column("text"))):
            ids = coded + end
            for number, (a, b) in enumerate(cuts(len(ids) // 4, capacity)):
                rows.append((at, number, a, b - a))
                crc.append(zlib.crc32(ids[4 * a : 4 * b]))
                if with_ids:
                    tokens.append(np.frombuffer(ids[4 * a : 4 * b], dtype="<i4"))
        at, number, start, length = np.array(rows, dtype=np.int64).reshape(-1, 4).T
        columns = [
            batch.column("key").take(pa.array(at)), pa.array(number.astype(np.int32)),
            pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
        ]
        names = ["key", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            columns.append(pa.array(tokens, pa.list_(pa.int32())))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(columns, names=names)


def tokenized_pieces(
    docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
    tokenizer: str | None = None, with_ids: bool = False,
) -> DataFrame:
    """(key, piece, start, length, ids_crc32) and, if asked for, ``ids`` of each piece."""
    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return slim.mapInArrow(
        partial(_pieces, path=tokenizer or vocabulary_path(), capacity=capacity, with_ids=with_ids),
        f"key {kind}, piece int, start long, length long, ids_crc32 long"
        + (", ids array<int>" if with_ids else ""),
    ).withColumnRenamed("key", key)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and place of each length by best-fit decreasing, and the number of bins."""
    bins = np.zeros(len(lengths), dtype=np.int64)
    places = np.zeros(len(lengths), dtype=np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    free, n = 0, 0  # bit r of free: a bin with r tokens left is open
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = free >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            b = open_bins[left].pop()
            if not open_bins[left]:
                free &= ~(1 << left)
        else:
            b, left, n = n, capacity, n + 1
        bins[i], places[i] = b, capacity - left
        if left > size:
            open_bins[left - size].append(b)
            free |= 1 << (left - size)
    return bins, places, n


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, by dual feasible functions.

    One family drops lengths below a threshold and counts those above its complement
    as whole; the other rounds multiples down.
    """
    if not len(lengths):
        return 0
    sizes, counts = np.unique(lengths, return_counts=True)
    best = -(-int(sizes @ counts) // capacity)
    for e in sizes[2 * sizes <= capacity].tolist():
        kept = np.where(sizes > capacity - e, capacity, np.where(sizes < e, 0, sizes))
        best = max(best, -(-int(kept @ counts) // capacity))
    for k in range(1, 21):
        times = (k + 1) * sizes
        # Both sides times k and the capacity, to stay with whole numbers.
        scaled = np.where(times % capacity == 0, k * sizes, capacity * (times // capacity))
        best = max(best, -(-int(scaled @ counts) // (k * capacity)))
    return best


def _pack(group: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Pack one partition; ``__pool`` marks rows of sequences to be taken apart."""
    group = group.sort_values(["length", "__order"], ascending=[False, True], kind="stable")
    lengths = group["length"].to_numpy()
    bins, places, n = best_fit(lengths, capacity)
    fill = np.bincount(bins, weights=lengths, minlength=n)
    open_ones = fill < capacity
    if n > lower_bound(lengths, capacity):
        pool = open_ones
    else:
        pool = np.zeros(n, dtype=bool)
        emptiest = int(np.argmin(fill))
        pool[emptiest] = open_ones[emptiest]
    return group.assign(__bin=bins, offset=places, __pool=pool[bins])


def _dealt(rows: DataFrame, count: int, turn: int, group_rows: int) -> DataFrame:
    groups = max(1, -(-count // group_rows))
    # With the place of a row in its stored table, as equal rows would fill one group.
    place = F.monotonically_increasing_id()
    order = F.xxhash64(F.lit(turn), place, *[F.col(c) for c in rows.columns])
    return rows.withColumn("__order", order).withColumn(
        "__group", F.pmod("__order", F.lit(groups)).cast("long")
    )


def pack(
    pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS,
    max_rounds: int = MAX_ROUNDS,
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table with a ``length`` of 1 to capacity.

    Rows travel through the packing as they are. Of each round, what stays and what is
    dealt anew are read from one written table.
    """
    names = pieces.columns
    rows = stored(pieces, "pieces")
    count, turn, before, done = rows.count(), 0, None, []
    kept_back: DataFrame | None = None
    while True:
        dealt = _dealt(rows, count, turn, group_rows)
        schema = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields
        ) + ", __bin long, offset long, __pool boolean"
        packed = stored(
            dealt.groupBy("__group").applyInPandas(partial(_pack, capacity=capacity), schema),
            f"round{turn}",
        ).withColumn(
            "sequence_id",
            F.lit(turn * 2**56) + F.col("__group") * F.lit(2**28) + F.col("__bin"),
        )
        if before is not None:
            now = packed.select("sequence_id").distinct().count()
            if now >= before:
                done.append(kept_back)
                break
        pool = packed.filter("__pool")
        seen = pool.agg(F.count("*").alias("n"), F.countDistinct("sequence_id").alias("bins")).first()
        only_group = count <= group_rows
        turn += 1
        if seen["bins"] < 2 or only_group or turn >= max_rounds:
            done.append(packed)
            break
        done.append(packed.filter(~F.col("__pool")))
        rows, kept_back = pool.select(*names), pool
        count, before = seen["n"], seen["bins"]
    result = done[0].select(*names, "sequence_id", "offset")
    for part in done[1:]:
        result = result.unionByName(part.select(*names, "sequence_id", "offset"))
    return result


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """Tokenize, cut and pack: one row per piece with its sequence and place there."""
    return pack(tokenized_pieces(docs, key, text), **how)


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of whole sequences, from packed pieces that carry ``ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids")
    )

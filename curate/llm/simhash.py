"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints within two bits of each other both lie within one bit of some common
value. So every distinct fingerprint emits itself and its 64 one-bit variants; those
that meet on a variant are candidates. At most 65 distinct fingerprints can meet on one
variant, however many documents there are, and exact copies are folded into one row
before that. Each meeting gives links from its smallest fingerprint, verified by
counting bits; together they connect whatever lies within two bits, so the components
are exact.

Edge cases: a text without words (null, empty, blank) has fingerprint zero and is linked
like any other; fewer than three words are one shingle; rows with a null id get a
component like others, named by the smallest id that is not null, null if there is none;
equal rows share a fingerprint and stay one row each in ``near_duplicates``, one in all in
``keep_one_per_group``; an empty table gives an empty result; other columns, of whatever
name, pass through ``keep_one_per_group`` and do not matter elsewhere. A very long text is
split in the memory of one worker and hashed in blocks of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curate.llm.common import packed, stored, unpacked
from curate.llm.components import connected_components

RADIUS = 2
SEED = 42
SHINGLE = 3
#: Shingles hashed at a time, which bounds memory for very long texts.
BLOCK = 50_000


def fingerprint(text: str | None) -> int:
    """64-bit SimHash of a text as a signed number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    shingles = max(1, len(words) - SHINGLE + 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, shingles, BLOCK):
        hashes = np.array(
            [
                xxhash.xxh64_intdigest(b" ".join(words[i : i + SHINGLE]), SEED)
                for i in range(at, min(at + BLOCK, shingles))
            ],
            dtype="<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > shingles, bitorder="little")
    return int(packed.view("<i8")[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(t) for t in batch.column("__text").to_pylist()]
        rest = [n for n in batch.schema.names if n != "__text"]
        columns = [batch.column(n) for n in rest] + [pa.array(prints, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=[*rest, "fp"])


def fingerprints(docs: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """The named columns of every row and its fingerprint ``fp``."""
    slim = docs.select(*columns, F.col(text).alias("__text"))
    kinds = ", ".join(f"`{c}` {slim.schema[c].dataType.simpleString()}" for c in columns)
    return slim.mapInArrow(_fingerprint_batches, f"{kinds}, fp long")


def _variants(fp: Column) -> Column:
    """The fingerprint and all values one bit away."""
    flips = [fp] + [fp.bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63))) for b in range(64)]
    return F.array(*flips)


def links(distinct: DataFrame) -> DataFrame:
    """Verified links (u, v) between the fingerprints ``fp`` of a table without repeats."""
    met = (
        distinct.select("fp", F.explode(_variants(F.col("fp"))).alias("variant"))
        .groupBy("variant")
        .agg(F.array_sort(F.collect_list("fp")).alias("fps"))
        .filter(F.size("fps") > 1)
    )
    pairs = met.select(F.col("fps")[0].alias("v"), F.explode(F.slice("fps", 2, 64)).alias("u"))
    return pairs.distinct().filter(
        F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= RADIUS
    )


def components(prints: DataFrame, key: str = "doc_id") -> DataFrame:
    """(fp, component_id) for every distinct fingerprint of a table (key, fp)."""
    distinct = stored(prints.groupBy("fp").agg(F.min(key).alias("least")), "distinct")
    roots = connected_components(links(distinct.select("fp")))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root", F.hash("root").alias("h")).agg(
        F.min("least").alias("component_id")
    )
    return rooted.join(named, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp, component_id), one row for each row of ``docs``."""
    prints = stored(fingerprints(docs, [key], text), "fingerprints")
    return prints.join(components(prints, key), "fp")


def keep_one_per_group(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one of each near-duplicate group: the smallest id (null last),
    then the smallest hash of the text; of equal rows, one."""
    slim = packed(docs, key, text)
    prints = stored(
        fingerprints(slim.withColumn("__null", F.col(key).isNull()), ["__null", "__id", "__th"], text),
        "fingerprints",
    )
    roots = stored(connected_components(links(prints.select("fp").distinct())), "roots")
    best = prints.groupBy("fp").agg(F.min(F.struct("__null", "__id", "__th")).alias("best"))
    winners = (
        best.join(roots, best["fp"] == roots["node"], "left")
        .groupBy(F.coalesce("root", "fp").alias("root"))
        .agg(F.min("best").alias("best"))
        .select("best.__id", "best.__th")
    )
    kept = slim.select("__row", "__id", "__th").join(winners, ["__id", "__th"], "left_semi")
    return unpacked(kept.dropDuplicates(["__id", "__th"]), docs.columns)

"""Token ids as ORC files, in ascending id order.

Rows are dealt out by ranges of the document id and sorted within them, so that every
file, stripe and row group covers a narrow range of ids: readers skip by the statistics
of stripes and row groups and by Bloom filters on the id, and may read the stripes of a
file in parallel. Ids are stored as a list of integers, which ORC writes as runs (RLE).

Edge cases: a null text is an empty one and gives the end id alone; null document ids
come first; rows with an equal id are ordered by their text; an empty table gives an
empty folder with a schema; a very long text is encoded and written as one row, in the
memory of one worker; only id and text are read, other columns do not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curate.llm.common import stored
from curate.llm.tokenization import END_ID, encoder, small_batches, vocabulary_path
from curate.operators.skew import fits_broadcast

ORC_OPTIONS = {
    "orc.stripe.size": str(16 << 20),
    "orc.row.index.stride": "1000",
    "orc.bloom.filter.fpp": "0.01",
    "compression": "zstd",
}


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Adds the ids of each text and how many ids precede it in this partition."""
    coder, before = encoder(path), 0
    end = np.array([END_ID], dtype="<u4").tobytes()
    for batch in small_batches(batches):
        coded = [ids + end for ids in coder.encode(batch.column("text"))]
        lengths = np.array([len(c) // 4 for c in coded], dtype=np.int64)
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        ids = pa.array(np.frombuffer(b"".join(coded), dtype="<i4"))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("key"),
                pa.array(before + offsets[:-1]),
                pa.array(lengths),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), ids),
            ],
            names=["key", "row_start", "n_tokens", "ids"],
        )
        before += int(offsets[-1])


def write_tokens(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
    tokenizer: str | None = None,
) -> None:
    """Write (key, row_start, n_tokens, ids); ``row_start`` counts the ids before a row in
    its own file."""
    kind = docs.schema[key].dataType.simpleString()
    in_order = (
        docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        .repartitionByRange("key")
        .sortWithinPartitions("key", "text")
    )
    coded = in_order.mapInArrow(
        partial(_encoded, path=tokenizer or vocabulary_path()),
        f"key {kind}, row_start long, n_tokens long, ids array<int>",
    )
    coded.withColumnRenamed("key", key).write.options(
        **ORC_OPTIONS, **{"orc.bloom.filter.columns": key}
    ).orc(path)


def _file_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path).withColumn("__file", F.col("_metadata.file_name"))


def _with_start(rows: DataFrame, every: DataFrame) -> DataFrame:
    """Add ``start`` to ``rows``, whose files are those of ``every``.

    Starts of files are running sums over one row per file, ordered by the numbers in
    its name, those of the task and of the file within the task, which follow the
    ranges; that is the only step one task does alone. A task goes on counting rows in
    its next file, so a file begins with its first ``row_start``. The table of files is
    broadcast if it is small, which is measured, and joined by a shuffle otherwise.
    """
    number = [F.regexp_extract("__file", p, 1).cast("long") for p in (r"^part-(\d+)", r"-c(\d+)\.")]
    earlier = Window.orderBy(*number, "__file").rowsBetween(Window.unboundedPreceding, -1)
    files = stored(
        every.groupBy("__file").agg(F.sum("n_tokens").alias("n"), F.min("row_start").alias("first")),
        "files",
    )
    base = F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")
    files = files.select("__file", base.alias("__base"))
    if fits_broadcast(files):
        files = F.broadcast(files)
    return rows.join(files, "__file").withColumn("start", F.col("__base") + F.col("row_start"))


def read_tokens(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """All documents of a folder with ``start``, the ids of all documents before each.

    A filter on the key reaches the row index and the Bloom filters.
    """
    rows = _file_rows(spark, path)
    return _with_start(rows, rows).select(key, "start", "n_tokens", "ids")


def read_digests(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """As ``token_digests`` of ``read_tokens``, with the ids summed up where they are read."""
    rows = _file_rows(spark, path)
    kind = rows.schema[key].dataType.simpleString()
    digests = rows.select(key, "__file", "row_start", "ids").mapInArrow(
        _digests, f"{key} {kind}, __file string, row_start long, n_tokens long, ids_crc32 long"
    )
    return _with_start(digests, rows).select(key, "start", "n_tokens", "ids_crc32")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        offsets = ids.offsets.to_numpy()
        data = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
        crc = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(offsets, offsets[1:])]  # noqa: B905
        names = [n for n in batch.schema.names if n != "ids"]
        columns = [batch.column(n) for n in names]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64())],
            names=[*names, "n_tokens", "ids_crc32"],
        )


def token_digests(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32), counted and summed from the ids themselves."""
    kind = tokens.schema[key].dataType.simpleString()
    return tokens.select(key, "start", "ids").mapInArrow(
        _digests, f"{key} {kind}, start long, n_tokens long, ids_crc32 long"
    )

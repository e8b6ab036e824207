"""Words, row keys and shared tables, as all operators here use them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curate.sinks.files import delete_folder, discard, owned, stored

__all__ = [
    "BLANK", "DOCUMENT_COLUMNS", "ascii_lower", "delete_folder", "discard", "keyed", "owned",
    "packed", "stored", "unpacked", "word_array",
]

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: What separates words: space, tab, line feed, vertical tab, form feed, return.
BLANK = r"[\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def word_array(text: Column) -> Column:
    """Words of a text in order; none for null or blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK), "")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, _UPPER, _UPPER.lower())


def keyed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Add ``__id`` and ``__th``, which together name a document and are never null.

    Rows with the same id and the same text are one document under these keys; a
    null id is told from an id of zero by the hash.
    """
    column = F.col(key)
    return docs.withColumns(
        {
            "__id": F.coalesce(column, F.lit(0).cast(docs.schema[key].dataType)),
            "__th": F.xxhash64(column.isNull(), column, text),
        }
    )


def packed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row whole in ``__row``, beside its key, its text, ``__id`` and ``__th``, so that
    columns of any name travel without meeting those of an operator."""
    row = F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("__row")
    return keyed(docs.select(key, text, row), key, text)


def unpacked(rows: DataFrame, names: list[str]) -> DataFrame:
    """The named columns of ``__row``."""
    return rows.select(*[F.col(f"__row.`{n}`").alias(n) for n in names])

"""Column contracts: what a table must hold and in which order."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

logger = logging.getLogger(__name__)


def check_layout(df: DataFrame, expected: Iterable[str]) -> DataFrame:
    """Return ``df`` when it has every expected column, else raise.

    Columns outside the contract are only reported.
    """
    wanted = set(expected)
    present = set(df.columns)
    missing = sorted(wanted - present)
    extra = sorted(present - wanted)
    if missing:
        raise ValueError(f"columns missing from the input: {missing}")
    if extra:
        logger.warning("columns outside the contract: %s", extra)
    return df


def in_order(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The contract columns, in contract order."""
    return df.select(*columns)


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, nullable."""
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable)
        for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, name string, type string, nullable boolean"
    )

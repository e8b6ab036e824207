"""Guarded load into a database table over JDBC."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from curate.sources.jdbc import jdbc_options

logger = logging.getLogger(__name__)

MODES = ("append", "overwrite")


def load_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    *,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    num_partitions: int | None = None,
    batch_size: int | None = None,
    truncate: bool = False,
) -> int:
    """Append to or overwrite a table and return the number of rows written.

    An empty input is skipped with a warning. Rows are counted by the write
    itself. ``num_partitions`` bounds the connections open at once; ``truncate``
    keeps the table definition when overwriting. Each task commits on its own,
    so a lost executor can repeat an appended partition: load a staging table
    with ``overwrite`` where that matters.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if df.isEmpty():
        logger.warning("nothing to load into %s: the input is empty", table)
        return 0
    extra = {
        "numPartitions": num_partitions,
        "batchsize": batch_size,
        "truncate": "true" if truncate else None,
    }
    options = jdbc_options(url, table, user, password, driver, extra)
    written = Observation("load")
    counted = df.observe(written, F.count(F.lit(1)).alias("rows"))
    try:
        counted.write.format("jdbc").options(**options).mode(mode).save()
    except Exception:
        logger.exception("load into %s failed", table)
        raise
    rows = written.get["rows"]
    logger.info("%d rows loaded into %s", rows, table)
    return rows

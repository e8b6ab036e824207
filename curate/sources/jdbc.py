"""Reading from a database over JDBC."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

logger = logging.getLogger(__name__)


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    extra: Mapping[str, object] | None = None,
) -> dict[str, str]:
    """Option map for a JDBC reader or writer; unset entries are left out."""
    options = {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver}
    options |= dict(extra or {})
    return {name: str(value) for name, value in options.items() if value is not None}


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    num_partitions: int | None = None,
    fetch_size: int | None = None,
) -> DataFrame:
    """A table, or a query in parentheses with an alias.

    A partition column with bounds and a number of partitions makes the read
    parallel; without them one task reads everything, which is logged as a warning
    unless one partition is asked for.
    """
    if partition_column is None and num_partitions != 1:
        logger.warning("one task reads all of %s: no partition column is given", table)
    split = {"partitionColumn": partition_column, "numPartitions": num_partitions}
    if bounds is not None:
        split |= {"lowerBound": bounds[0], "upperBound": bounds[1]}
    options = jdbc_options(url, table, user, password, driver, split | {"fetchsize": fetch_size})
    return spark.read.format("jdbc").options(**options).load()


def probe_jdbc(
    spark: SparkSession,
    url: str,
    *,
    query: str = "(SELECT 1) AS probe",
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
) -> None:
    """Run a trivial query; log the outcome and raise when it fails."""
    try:
        read_jdbc(
            spark, url, query, user=user, password=password, driver=driver, num_partitions=1
        ).limit(1).collect()
    except Exception:
        logger.exception("no connection to the database")
        raise
    logger.info("connection to the database works")

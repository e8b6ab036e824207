"""Parquet output and shared intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a directory of Parquet files; a failed write raises."""
    df.write.mode(mode).parquet(path)


def write_parts(df: DataFrame, part: str, path: str) -> None:
    """Write one folder ``part=value`` per value of a column, which the files leave out."""
    df.write.mode("overwrite").partitionBy(part).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder that driver and executors share.

    It lies below ``spark.checkpoint.dir``, else below the checkpoint folder set
    on the context. Only a local master, which has one machine, may fall back to
    a temporary folder; elsewhere a missing setting raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and (context := spark.sparkContext.getCheckpointDir()):
        base = context
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="curate-")
    return f"{base.rstrip('/')}/curate-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    It cuts the lineage, outlives lost executors, and gives the planner the
    true size of the table.
    """
    folder = shared_folder(df.sparkSession)
    write_parquet(df, f"{folder}/{name}")
    read = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")
    read.stored_in = folder
    for owner in _OWNERS:
        owner.append(folder)
    return read


_OWNERS: list[list[str]] = []


@contextmanager
def owned() -> Iterator[list[str]]:
    """Collects the folders of all tables stored meanwhile, for their owner to delete
    once what depends on them is written."""
    folders: list[str] = []
    _OWNERS.append(folders)
    try:
        yield folders
    finally:
        _OWNERS[:] = [o for o in _OWNERS if o is not folders]


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for table in tables:
        delete_folder(table.sparkSession, table.stored_in)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store the path names; an absent one is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another, which is deleted; both lie in one store."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(path(target).getParent())
    delete_folder(spark, target)
    if not store.rename(path(source), path(target)):
        raise OSError(f"{source} could not be moved to {target}")

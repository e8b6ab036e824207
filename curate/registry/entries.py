"""Pairs of a Spark query and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from curate.sources.readers import read_parquet

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    build: Build
    sql: str


class Registry(dict[str, Entry]):
    def query(self, sql: str, name: str | None = None) -> Callable[[Build], Build]:
        """Register a function, under its own name unless another is given."""

        def add(build: Build) -> Build:
            key = name or build.__name__
            if key in self:
                raise ValueError(f"{key} is registered twice")
            self[key] = Entry(build, sql)
            return build

        return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")

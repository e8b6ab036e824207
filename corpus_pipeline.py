"""From raw documents to packed training sequences, in five written stages."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from curate.llm import line_dedup, mixing, packing, quality_rules, simhash
from curate.llm.common import DOCUMENT_COLUMNS, delete_folder, discard, owned, stored

#: The limits of op1_mixing.
MIX = mixing.Mix()

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Folders of the tables that the last stage stored for its result.
_LEFT: list[str] = []


def _stage(work: Stage) -> Stage:
    """Deletes what the stage before has stored: its result is written by the time the
    next stage is called, so nothing reads that any more."""

    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _LEFT:
            delete_folder(spark, _LEFT.pop())
        with owned() as folders:
            result = work(spark, docs, sf_dir)
        _LEFT.extend(folders)
        return result

    return run_stage


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a base rule or an adaptive limit go."""
    return quality_rules.filter_documents(docs.select(*DOCUMENT_COLUMNS))


@_stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines are cut out of the texts."""
    return line_dedup.dedup_lines(docs, whole_runs=True).select(*DOCUMENT_COLUMNS)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays, at the shingle length and
    distance of op6_simhash."""
    return simhash.keep_one_per_group(docs).select(*DOCUMENT_COLUMNS)


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of small sources are read again until the weights are met; written in
    the order of the schedule, by block and position."""
    return mixing.realise(docs, MIX).select(*DOCUMENT_COLUMNS)


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and place."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near duplicates", near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage{number}")
        if before is not None:
            discard(before)
        before = docs
    return docs


#: The hash of shingles and the tokenizer have no counterpart in SQL. Line dedup and near duplicates are
#: compared with brute force in ``tests/llm``, mixing with its schedule and packed pieces with
#: the library's ids.
ORACLE_SQL = None

"""Queries over the test tables, one for each operator, and SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curate.llm import (
    decontamination,
    lattice,
    line_dedup,
    mixing,
    neighbours,
    packing,
    periodic_runs,
    quality_rules,
    rule_ensemble,
    simhash,
    spelling,
    token_files,
    url_rules,
)
from curate.registry.entries import table
from curate.sinks.files import shared_folder


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/tokens"
    token_files.write_tokens(table(spark, sf_dir, "documents"), path)
    return token_files.read_digests(spark, path)


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op7_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score_documents(table(spark, sf_dir, "documents"))


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_pages(table(spark, sf_dir, "pages"))


def op9_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return rule_ensemble.score_documents(docs, labels)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("text").alias("whole"))
    gone = F.aggregate(
        F.coalesce("__removed", F.expr("array()")),
        F.lit(0).cast("long"),
        lambda n, s: n + s["last_pos"] - s["first_pos"] + 1,
    )
    return line_dedup.dedup_lines(docs, whole_runs=True).select(
        "doc_id", "text",
        F.coalesce(F.size(F.split("whole", "\n")).cast("long"), F.lit(0)).alias("n_lines"),
        gone.alias("n_removed"),
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return spelling.spelling_variants(docs, rewrite=spelling.slipped)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return periodic_runs.run_report(docs, rewrite=periodic_runs.planted)


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.contamination(docs, items)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_mixing, op2_token_files, op3_neighbours, op4_packing, op5_quality_rules,
            op6_simhash, op7_lattice, op8_url_rules, op9_rule_ensemble, op10_line_dedup,
            op11_spelling, op12_periodic_runs, op13_decontamination, pipeline,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op8_url_rules": url_rules.ORACLE_SQL,
        "op5_quality_rules": quality_rules.ORACLE_SQL,
        "op10_line_dedup": line_dedup.ORACLE_SQL,
        "op13_decontamination": decontamination.ORACLE_SQL,
    }

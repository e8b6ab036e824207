"""Data quality rules, reported as a table and never enforced.

Row rules count the rows that break them; all of them share one scan. A value
that is null passes every rule but ``not_null``.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curate.operators.dedup import repeated_keys
from curate.operators.profile import Counts
from curate.operators.skew import count_rows_by

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class RowRule:
    rule: str
    column: str
    broken: Column


@dataclass(frozen=True)
class UniqueRule:
    column: str
    rule: str = "unique"


@dataclass(frozen=True)
class ReferenceRule:
    column: str
    target: DataFrame
    target_column: str
    rule: str = "references"


Rule = RowRule | UniqueRule | ReferenceRule


def rule_range(column: str, low: object, high: object) -> RowRule:
    value = F.col(column)
    return RowRule("range", column, (value < F.lit(low)) | (value > F.lit(high)))


def rule_not_null(column: str) -> RowRule:
    return RowRule("not_null", column, F.col(column).isNull())


def rule_unique(column: str) -> UniqueRule:
    """Fails once per key that occurs more than once."""
    return UniqueRule(column)


def rule_matches(column: str, pattern: str) -> RowRule:
    return RowRule("matches", column, ~F.col(column).rlike(pattern))


def rule_in_set(column: str, allowed: Sequence[object]) -> RowRule:
    return RowRule("in_set", column, ~F.col(column).isin(*allowed))


def rule_references(column: str, target: DataFrame, target_column: str) -> ReferenceRule:
    """Fails once per row whose value has no row in ``target``."""
    return ReferenceRule(column, target, target_column)


def row_rule_counts(rules: Sequence[RowRule]) -> Counts:
    """One count per row rule, and the result lines they stand up to."""
    counts = [F.count_if(r.broken).alias(f"__broken_{i}") for i, r in enumerate(rules)]
    cells = [
        cell
        for i, r in enumerate(rules)
        for cell in (F.lit(r.rule), F.lit(r.column), F.col(f"__broken_{i}"))
    ]
    lines = F.stack(F.lit(len(rules)), *cells)
    return Counts(counts, lines.alias("rule", "column", "failed_rows"))


def with_status(results: DataFrame) -> DataFrame:
    """Add ``warn`` where a rule failed, else ``ok``."""
    status = F.when(F.col("failed_rows") > 0, "warn").otherwise("ok")
    return results.withColumn("status", status)


def _one_result(failed: DataFrame, rule: str, column: str) -> DataFrame:
    return failed.agg(F.count("*").alias("failed_rows")).select(
        F.lit(rule).alias("rule"), F.lit(column).alias("column"), "failed_rows"
    )


def _orphans(df: DataFrame, rule: ReferenceRule) -> DataFrame:
    """Values are counted before they are looked up, so no row travels and no key is hot."""
    values = df.select(F.col(rule.column).alias("value")).dropna()
    known = rule.target.select(F.col(rule.target_column).alias("value")).distinct()
    missing = count_rows_by(values, ["value"], "rows").join(known, "value", "left_anti")
    return missing.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("failed_rows")).select(
        F.lit(rule.rule).alias("rule"), F.lit(rule.column).alias("column"), "failed_rows"
    )


def check_rules(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Result table (rule, column, failed_rows, status)."""
    rules = list(rules)
    row_rules = [r for r in rules if isinstance(r, RowRule)]
    results = [row_rule_counts(row_rules).over(df)] if row_rules else []
    for r in rules:
        if isinstance(r, UniqueRule):
            results.append(_one_result(repeated_keys(df, r.column), r.rule, r.column))
        elif isinstance(r, ReferenceRule):
            results.append(_orphans(df, r))
    if not results:
        raise ValueError("no rules given")
    return with_status(reduce(DataFrame.unionByName, results))


def log_rules(results: DataFrame) -> None:
    """Log a result table, which has one row per rule."""
    for row in results.collect():
        if row["status"] == "ok":
            logger.info("%s(%s): OK", row["rule"], row["column"])
        else:
            logger.warning(
                "%s(%s): %d failed", row["rule"], row["column"], row["failed_rows"]
            )

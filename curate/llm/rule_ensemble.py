"""Sparse rule ensemble for document quality.

A forest of shallow trees is grown on document statistics of the labelled training rows.
Every path from a root to an inner node or leaf is a rule, a conjunction of bounds on
statistics. A lasso logistic regression over the rules keeps few of them. Those are
compiled to column expressions, so scoring runs in whole-stage code without a model.

Statistics come from the text alone. Labels, language, source and id are never inputs.

Edge cases: a null, empty or blank text has statistics of zero and a score like any other;
rows with null ids are scored, never learned from; repeated labels of a document count
once (the largest); without labels of both kinds the score is the share of label 1 in
training, or one half; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curate.llm.common import stored
from curate.llm.quality_rules import document_statistics

TREES = 12
DEPTH = 3
LASSO = 0.003
THRESHOLD = 0.7
SEED = 17

FEATURES = (
    "words", "word_length", "symbol_rate", "dup_line_rate", "repeat_rate", "line_words",
    "upper_rate", "mark_rate", "bar_rate", "digit_rate", "distinct_rate", "stop_rate",
)


@dataclass(frozen=True)
class Bound:
    """``feature <= value``, or ``feature > value`` where ``above``."""

    feature: str
    above: bool
    value: float

    def column(self) -> Column:
        column = F.col(self.feature)
        return column > F.lit(self.value) if self.above else column <= F.lit(self.value)


Rule = tuple[Bound, ...]


def rule_column(rule: Rule) -> Column:
    """1.0 where all bounds of a rule hold, else 0.0."""
    held = F.lit(True)
    for bound in rule:
        held = held & bound.column()
    return F.when(held, F.lit(1.0)).otherwise(F.lit(0.0))


def _removed(column: Column, pattern: str) -> Column:
    return F.length(column) - F.length(F.regexp_replace(column, pattern, ""))


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the statistics named in FEATURES, as doubles; drops the text."""
    body = F.coalesce(F.col(text), F.lit(""))
    step = docs.withColumns(
        {
            "__upper": F.length(body) - F.length(F.regexp_replace(body, r"\p{Lu}+", "")),
            "__marks": F.length(body) - F.length(F.replace(body, F.lit("!"), F.lit(""))),
            "__bars": F.length(body) - F.length(F.replace(body, F.lit("|"), F.lit(""))),
            "__digits": _removed(body, r"[0-9]+"),
            "__stops": F.length(body) - F.length(F.replace(body, F.lit("."), F.lit(""))),
            "__distinct": F.size(F.array_distinct(F.split(body, " "))),
            "__spaces": F.length(body) - F.length(F.replace(body, F.lit(" "), F.lit(""))),
            "__length": F.length(body),
        }
    )
    step = document_statistics(step, text).drop(text)
    words = F.greatest("n_words", F.lit(1)).cast("double")
    length = F.greatest("__length", F.lit(1)).cast("double")
    lines = F.greatest("n_lines", F.lit(1)).cast("double")
    made = {
        "words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / words,
        "symbol_rate": F.col("n_symbols") / words,
        "dup_line_rate": F.col("n_dup_lines") / lines,
        "repeat_rate": F.col("n_repeat_words") / words,
        "line_words": F.col("n_words") / lines,
        "upper_rate": F.col("__upper") / length,
        "mark_rate": F.col("__marks") / words,
        "bar_rate": F.col("__bars") / words,
        "digit_rate": F.col("__digits") / length,
        "distinct_rate": F.col("__distinct") / (F.col("__spaces") + 1),
        "stop_rate": F.col("__stops") / words,
    }
    return step.select(*docs.drop(text).columns, *[c.alias(n) for n, c in made.items()])


def tree_rules(model) -> list[Rule]:
    """The distinct rules of a fitted forest: every path to a node below a root."""
    found: dict[Rule, None] = {}

    def walk(node, path: dict[tuple[str, bool], float]) -> None:
        if path:
            rule = tuple(Bound(f, above, v) for (f, above), v in sorted(path.items()))
            found[rule] = None
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        name, value = FEATURES[split.featureIndex()], float(split.threshold())
        low, high = path.get((name, False), value), path.get((name, True), value)
        walk(node.leftChild(), path | {(name, False): min(low, value)})
        walk(node.rightChild(), path | {(name, True): max(high, value)})

    for tree in model.trees:
        walk(tree._call_java("rootNode"), {})
    return list(found)


@dataclass(frozen=True)
class Ensemble:
    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """Probability of label 1 as one expression over FEATURES."""
        total = F.lit(self.intercept)
        for rule, weight in self.weights:
            total = total + F.lit(weight) * rule_column(rule)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(train: DataFrame, label: str = "label") -> Ensemble | float:
    """Grow the forest and fit the lasso on a table with FEATURES and a 0/1 label.

    A plain number is returned where there is nothing to tell apart."""
    seen = train.agg(F.count("*").alias("n"), F.avg(label).alias("share")).first()
    if not seen["n"]:
        return 0.5
    if seen["share"] in (0.0, 1.0):
        return float(seen["share"])
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    forest = RandomForestClassifier(
        labelCol=label, numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=1.0,
        featureSubsetStrategy="onethird",
    ).fit(vectors.transform(train).select(label, "features"))
    rules = tree_rules(forest)
    if not rules:
        return float(seen["share"])
    named = train.select(label, *[rule_column(r).alias(f"r{i}") for i, r in enumerate(rules)])
    indicators = VectorAssembler(inputCols=named.columns[1:], outputCol="features")
    lasso = LogisticRegression(
        labelCol=label, elasticNetParam=1.0, regParam=LASSO, maxIter=60, standardization=False
    ).fit(indicators.transform(named).select(label, "features"))
    kept = [(r, float(w)) for r, w in zip(rules, lasso.coefficients, strict=True) if abs(w) > 1e-9]
    return Ensemble(float(lasso.intercept), tuple(kept))


def held_out(key: Column) -> Column:
    """True for the fold that is never learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score_documents(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    label: str = "quality",
) -> DataFrame:
    """(key, held_out, score, predicted) for every row of ``docs``."""
    slim = docs.select(F.col(key), F.col(text).alias("__text"))
    table = stored(features(slim, "__text"), "features")
    marks = (
        labels.filter(F.col(label).isin(0, 1))
        .groupBy(key)
        .agg(F.max(label).cast("double").alias("label"))
        .filter(~held_out(F.col(key)))
    )
    train = stored(
        table.filter(~held_out(F.col(key))).join(marks, key).select(*FEATURES, "label"), "training"
    )
    model = fit(train)
    score = model.score() if isinstance(model, Ensemble) else F.lit(model)
    return table.select(key, held_out(F.col(key)).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )

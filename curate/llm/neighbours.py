"""Approximate nearest neighbours by stable projections and kd-trees.

Vectors are scaled to length one and projected by a random Gaussian (2-stable) matrix to
a few dimensions, where the squared distance of two vectors divided by their true one
follows a chi-square law. A kd-tree fitted on a bounded sample of projections divides the
space into leaves; every vector is dealt to its leaf, large leaves into blocks of bounded
size. A query searches its own leaf first and then every leaf that the stopping test does
not rule out. In a block, a kd-tree over its projections gives candidates nearest first,
which are verified with the exact cosine until the test holds: a vector nearer than the
k-th best so far would, with probability ``confidence``, have been met already.

Equal vectors are searched once. Of each distinct vector only the ``k + 1`` smallest ids
can be among the nearest, so groups of copies of any size cost nothing more.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components take
no part, neither as queries nor as candidates; vectors of different length are never
neighbours; repeated rows count once; ties go to the smaller id; null ids take no part; an
empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curate.llm.common import stored

K = 5
#: The kd-tree over all data is fitted on at most this many distinct vectors.
SAMPLE_ROWS = 20_000


@dataclass(frozen=True)
class Search:
    k: int = K
    projections: int = 8
    confidence: float = 0.98
    block_rows: int = 8_000
    bucket_rows: int = 64
    query_rows: int = 20_000
    sample_rows: int = SAMPLE_ROWS
    seed: int = 5


def chi_square_quantile(p: float, degrees: int) -> float:
    """Quantile of the chi-square law for an even number of degrees, by bisection."""

    def below(x: float) -> float:
        terms, term = 1.0, 1.0
        for i in range(1, degrees // 2):
            term *= x / 2 / i
            terms += term
        return 1 - math.exp(-x / 2) * terms

    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


def projection(dimension: int, search: Search) -> np.ndarray:
    return np.random.default_rng(search.seed).standard_normal((dimension, search.projections))


def projected(vectors: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True) @ matrix


class Tree:
    """A kd-tree over points: ``low`` and ``high`` corners of its leaves, which together
    cover the space, and for the fitted points their leaf ``of``."""

    def __init__(self, points: np.ndarray, leaf_rows: int):
        n, m = points.shape
        self.of = np.zeros(n, dtype=np.int64)
        low, high = [], []
        waiting = [(np.arange(n), np.full(m, -np.inf), np.full(m, np.inf))]
        while waiting:
            rows, a, b = waiting.pop()
            mine = points[rows]
            axis = int(np.argmax(np.ptp(mine, axis=0))) if len(rows) else 0
            if len(rows) > leaf_rows:
                cut = float(np.median(mine[:, axis]))
                left = mine[:, axis] < cut
                if 0 < left.sum() < len(rows):
                    upper, lower = b.copy(), a.copy()
                    upper[axis] = lower[axis] = cut
                    waiting += [(rows[left], a, upper), (rows[~left], lower, b)]
                    continue
            self.of[rows] = len(low)
            low.append(a)
            high.append(b)
        self.low, self.high = np.array(low), np.array(high)

    def gaps(self, points: np.ndarray) -> np.ndarray:
        """Squared distances from points to the boxes of all leaves."""
        out = np.zeros((len(points), len(self.low)))
        for axis in range(points.shape[1]):
            x = points[:, axis, None]
            out += np.maximum(np.maximum(self.low[:, axis] - x, x - self.high[:, axis]), 0) ** 2
        return out


def _vectors(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


def _leaf_of(batches, matrix: np.ndarray, tree: Tree):
    for pdf in batches:
        if len(pdf):
            points, leaf = projected(_vectors(pdf["vector"]), matrix), []
            for at in range(0, len(points), 1000):
                leaf.append(np.argmin(tree.gaps(points[at : at + 1000]), axis=1))
            yield pdf.assign(leaf=np.concatenate(leaf))


def _further_leaves(batches, matrix: np.ndarray, tree: Tree, reach: float):
    """Leaves besides its own that may hold something nearer than a query's ``bound``."""
    for pdf in batches:
        if not len(pdf):
            continue
        gaps = tree.gaps(projected(_vectors(pdf["vector"]), matrix))
        open_ = gaps <= reach * pdf["bound"].to_numpy()[:, None]
        open_[np.arange(len(pdf)), pdf["leaf"].to_numpy()] = False
        row, leaf = np.nonzero(open_)
        yield pdf.iloc[row].assign(leaf=leaf)


def _search_block(data: pd.DataFrame, queries: pd.DataFrame, matrix, search: Search, reach: float):
    """The nearest distinct vectors of one block for the queries that came to it."""
    names = ["q1", "q2", "h1", "h2", "least", "score"]
    if not len(data) or not len(queries):
        return pd.DataFrame({n: [] for n in names})
    vectors, asked = _vectors(data["vector"]), _vectors(queries["vector"])
    norms, least = np.sqrt((vectors * vectors).sum(axis=1)), data["least"].to_numpy()
    points, wanted = projected(vectors, matrix), projected(asked, matrix)
    tree = Tree(points, search.bucket_rows)
    order = np.argsort(tree.of, kind="stable")
    starts = np.searchsorted(tree.of[order], np.arange(len(tree.low) + 1))
    members = [order[a:b] for a, b in zip(starts, starts[1:])]  # noqa: B905
    k, found = search.k + 1, []
    for q, bound in enumerate(queries["bound"].to_numpy()):
        norm = np.sqrt((asked[q] * asked[q]).sum())
        gaps = tree.gaps(wanted[q : q + 1])[0]
        nearest = np.argsort(gaps, kind="stable")
        best, scores, at, step = np.empty(0, dtype=np.int64), np.empty(0), 0, 1
        while at < len(nearest) and gaps[nearest[at]] <= reach * bound:
            rows = np.concatenate([members[leaf] for leaf in nearest[at : at + step]])
            apart = ((points[rows] - wanted[q]) ** 2).sum(axis=1)
            rows = rows[apart <= reach * bound]
            score = (vectors[rows] * asked[q]).sum(axis=1) / (norms[rows] * norm)
            best, scores = np.concatenate([best, rows]), np.concatenate([scores, score])
            top = np.lexsort((least[best], -scores))[:k]
            best, scores = best[top], scores[top]
            if len(best) == k:
                bound = min(bound, max(2 - 2 * scores[-1], 0) + 1e-12)
            at, step = at + step, step * 2
        found += [(q, row, score) for row, score in zip(best.tolist(), scores.tolist(), strict=True)]
    if not found:
        return pd.DataFrame({n: [] for n in names})
    q, row, score = (np.array(x) for x in zip(*found, strict=True))
    return pd.DataFrame(
        {
            "q1": queries["h1"].to_numpy()[q], "q2": queries["h2"].to_numpy()[q],
            "h1": data["h1"].to_numpy()[row], "h2": data["h2"].to_numpy()[row],
            "least": least[row], "score": score,
        }
    )


def distinct_vectors(table: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """(h1, h2, vec_id, turn, vector): of every distinct usable vector the rows with its
    ``k + 1`` smallest ids, numbered from 1; the vector itself in the first of them."""
    finite = F.forall(
        vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    )
    usable = table.filter(
        F.col(key).isNotNull() & F.coalesce(finite, F.lit(False))
        & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))
    ).select(
        F.xxhash64(vector).alias("h1"), F.xxhash64(F.lit(1), vector).alias("h2"),
        F.col(key).alias("vec_id"), F.col(vector).alias("vector"),
    )
    turn = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))
    return (
        usable.dropDuplicates(["h1", "h2", "vec_id"])
        .withColumn("turn", turn)
        .filter(F.col("turn") <= k + 1)
        .withColumn("vector", F.when(F.col("turn") == 1, F.col("vector")))
    )


def _blocks(leaves: DataFrame, search: Search) -> DataFrame:
    """How many blocks each leaf needs."""
    return leaves.groupBy("leaf").agg(
        F.ceil(F.count("*") / search.block_rows).cast("int").alias("blocks")
    )


def _searched(data: DataFrame, queries: DataFrame, matrix, search: Search, reach: float) -> DataFrame:
    """Search the queries (h1, h2, vector, bound, leaf) in the blocks of their leaves."""
    chunks = queries.groupBy("leaf").agg(
        F.ceil(F.count("*") / search.query_rows).cast("int").alias("chunks")
    )
    counted = F.broadcast(_blocks(data, search).join(chunks, "leaf"))  # a row per leaf
    spread = data.join(counted, "leaf").withColumns(
        {
            "block": F.pmod("h2", F.col("blocks").cast("long")),
            "chunk": F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)),
        }
    )
    # New names for the other side of the cogroup, which comes from the same tables.
    renewed = [df.select(*[F.col(c).alias(c) for c in df.columns]) for df in (queries, counted)]
    asked = renewed[0].join(F.broadcast(renewed[1]), "leaf").withColumns(
        {
            "chunk": F.pmod("h2", F.col("chunks").cast("long")),
            "block": F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)),
        }
    )
    part = ["leaf", "block", "chunk"]
    kind = data.schema["least"].dataType.simpleString()
    return (
        spread.groupBy(*part)
        .cogroup(asked.groupBy(*part))
        .applyInPandas(
            partial(_search_block, matrix=matrix, search=search, reach=reach),
            f"q1 long, q2 long, h1 long, h2 long, least {kind}, score double",
        )
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest distinct vectors of each query."""
    order = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "least")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _nearest_vectors(data: DataFrame, queries: DataFrame, dimension: int, search: Search) -> DataFrame:
    """(q1, q2, h1, h2, least, score): the k + 1 nearest distinct vectors per query."""
    matrix, reach = projection(dimension, search), chi_square_quantile(search.confidence, search.projections)
    sample = data.orderBy("h1", "h2").limit(search.sample_rows).select("vector").toPandas()
    rows = data.count()
    leaves = max(1, min(-(-rows // search.block_rows), len(sample) // 32))
    tree = Tree(projected(_vectors(sample["vector"]), matrix), -(-len(sample) // leaves))
    dealt = partial(_leaf_of, matrix=matrix, tree=tree)
    schema = f"h1 long, h2 long, least {data.schema['least'].dataType.simpleString()}, vector {data.schema['vector'].dataType.simpleString()}, leaf long"
    data = stored(data.select("h1", "h2", "least", "vector").mapInPandas(dealt, schema), "leaves")
    queries = data.join(queries.select("h1", "h2"), ["h1", "h2"], "left_semi").drop("least")
    at_home = queries.withColumn("bound", F.lit(4.0))
    first = stored(_best(_searched(data, at_home, matrix, search, reach), search.k + 1), "first")
    if len(tree.low) == 1:
        return first.drop("rank")
    bounds = first.filter(F.col("rank") == search.k + 1).select(
        F.col("q1").alias("h1"), F.col("q2").alias("h2"),
        (F.greatest(2 - 2 * F.col("score"), F.lit(0.0)) + 1e-12).alias("bound"),
    )
    wider = queries.join(bounds, ["h1", "h2"], "left").fillna(4.0, ["bound"])
    further = stored(
        wider.select("h1", "h2", "vector", "leaf", "bound").mapInPandas(
            partial(_further_leaves, matrix=matrix, tree=tree, reach=reach),
            f"h1 long, h2 long, vector {data.schema['vector'].dataType.simpleString()}, leaf long, bound double",
        ),
        "visits",
    )
    second = _searched(data, further, matrix, search, reach)
    return _best(first.drop("rank").unionByName(second), search.k + 1).drop("rank")


def nearest(
    table: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 50,
    search: Search = Search(),
) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows whose key is divisible by ``every``."""
    rows = stored(distinct_vectors(table, key, vector, search.k), "vectors")
    ids = rows.groupBy("h1", "h2").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    asking = stored(
        table.filter(F.col(key) % every == 0)
        .select(
            F.xxhash64(vector).alias("h1"), F.xxhash64(F.lit(1), vector).alias("h2"),
            F.col(key).alias("query_id"),
        )
        .distinct(),
        "asking",
    )
    first = rows.filter(F.col("turn") == 1).withColumnRenamed("vec_id", "least")
    distinct_queries = asking.select("h1", "h2").distinct()
    parts = []
    # One pass per length of vectors; a table of embeddings has one, bad rows aside.
    for size in [r[0] for r in first.select(F.size("vector")).distinct().collect()]:
        alike = first.filter(F.size("vector") == size)
        parts.append(_nearest_vectors(alike, distinct_queries, size, search))
    if not parts:
        kind = table.schema[key].dataType.simpleString()
        return table.sparkSession.createDataFrame(
            [], f"query_id {kind}, rank int, vec_id {kind}, score double"
        )
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    near = F.struct((-F.col("score")).alias("far"), F.col("id").alias("vec_id"))
    lists = (
        found.join(ids, ["h1", "h2"])
        .withColumn("id", F.explode("ids"))
        .groupBy(F.col("q1").alias("h1"), F.col("q2").alias("h2"))
        .agg(F.slice(F.array_sort(F.collect_list(near)), 1, search.k + 1).alias("near"))
    )
    # At most (k + 1) squared rows meet in a list; many queries may share one vector.
    others = F.slice(F.filter("near", lambda s: s["vec_id"] != F.col("query_id")), 1, search.k)
    return asking.join(stored(lists, "lists"), ["h1", "h2"]).select(
        "query_id", F.posexplode(others).alias("pos", "hit")
    ).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
        (-F.col("hit.far")).alias("score"),
    )

"""Nearest neighbours by inner product: vantage-point trees, one for each shard of the vectors.

One more component makes all vectors equally long, so the largest inner product is the smallest distance and
the triangle inequality prunes.  A branch is left out if ``factor`` times its least possible distance exceeds the
distance of the worst neighbour found so far: factor 1 is exact search, larger factors search less.

Rounding is bounded for each query and point by their own lengths.  Whatever may be among the nearest within these
bounds is scored once more, pair by pair and always in the same way, and only such scores rank and cut.

Shards and blocks of queries have bounded sizes; each pair of them is one task's group, and returns no more
than ``k`` neighbours for each of its queries.

Vectors that are NULL or zero or hold NULL or non-finite components take no part.  Rows of one vec_id count as
one vector, the smallest by array order; rows without vec_id take no part.  Equal vectors share one place in a
tree, with their smallest ids.  Only vectors of the same length are compared.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 20
SHARD_ROWS = 16_384
BLOCK_QUERIES = 4_096
LEAF = 256
FACTOR = 1.0
PAIRS = 1 << 14  # pairs scored in one pass


class VantageTree:
    """A tree over the rows of ``points``; every node keeps its vantage point and the distances it parts."""

    def __init__(self, points: np.ndarray, longest: float, seed: int = 7) -> None:
        self.points = points
        self.extra = np.sqrt(np.maximum(longest**2 - np.einsum("ij,ij->i", points, points), 0.0))
        self.longest = longest
        self.random = np.random.default_rng(seed)
        self.root = self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray) -> dict:
        if len(rows) <= LEAF:
            return {"rows": rows}
        vantage = rows[self.random.integers(len(rows))]
        apart = self.points[rows] - self.points[vantage]
        far = np.sqrt(np.einsum("ij,ij->i", apart, apart) + (self.extra[rows] - self.extra[vantage]) ** 2)
        middle = np.median(far)
        inner = far <= middle
        if inner.all():
            return {"rows": rows}
        return {
            "vantage": vantage, "inner_most": far[inner].max(), "outer_least": far[~inner].min(), "outer_most": far[~inner].max(),
            "inner": self._build(rows[inner]), "outer": self._build(rows[~inner]), "middle": middle,
        }

    def search(self, queries: np.ndarray, ids: np.ndarray, keep: int, factor: float) -> np.ndarray:
        """Rows of the ``keep`` nearest points of each query (-1: fewer), ties to smaller ``ids``."""
        search = _Search(self, queries, ids, keep, factor)
        search.visit(self.root, np.arange(len(queries)))
        return search.rows


class _Search:
    def __init__(self, tree: VantageTree, queries: np.ndarray, ids: np.ndarray, keep: int, factor: float) -> None:
        self.tree, self.queries, self.ids, self.factor = tree, queries, ids, factor
        self.square = np.einsum("ij,ij->i", queries, queries)
        rounding = 4 * (queries.shape[1] + 8) * np.finfo(float).eps  # bounds the error of a sum of products, relative to both lengths
        self.slack = rounding * np.sqrt(self.square)
        self.lengths = np.sqrt(np.einsum("ij,ij->i", tree.points, tree.points))
        self.square_slack = rounding * (self.square + tree.longest**2)  # bounds the error of squared distances
        self.scores = np.full((len(queries), keep), -np.inf)
        self.rows = np.full((len(queries), keep), -1)
        self.row_ids = np.full((len(queries), keep), np.iinfo(np.int64).max)

    def _reach(self, q: np.ndarray) -> np.ndarray:
        """Distance of the worst neighbour of each query; infinite while it has fewer than wanted."""
        worst = self.scores[q, -1]
        known = np.isfinite(worst)
        square = self.square[q] + self.tree.longest**2 - 2 * np.where(known, worst, 0.0)
        return np.where(known, np.sqrt(np.maximum(square, 0.0) + self.square_slack[q]), np.inf)

    def _leaf(self, rows: np.ndarray, q: np.ndarray) -> None:
        keep = self.scores.shape[1]
        found = self.queries[q] @ self.tree.points[rows].T
        slack = self.slack[q][:, None] * self.lengths[rows]
        least = self.scores[q, -1]
        if len(rows) > keep:
            least = np.maximum(least, np.partition(found - slack, -keep, axis=1)[:, -keep])
        near = found + slack >= least[:, None]
        better = near.any(axis=1)
        if not better.any():
            return
        q, near = q[better], near[better]
        found = np.full(near.shape, -np.inf)
        i, j = np.nonzero(near)
        for begin in range(0, len(i), PAIRS):
            a, b = i[begin:begin + PAIRS], j[begin:begin + PAIRS]
            found[a, b] = pair_scores(self.tree.points[rows[b]], self.queries[q[a]])
        scores = np.hstack([self.scores[q], found])
        row = np.hstack([self.rows[q], np.broadcast_to(rows, found.shape)])
        row_ids = np.hstack([self.row_ids[q], np.broadcast_to(self.ids[rows], found.shape)])
        order = np.lexsort((row_ids, -scores), axis=1)[:, :keep]
        for own, new in ((self.scores, scores), (self.rows, row), (self.row_ids, row_ids)):
            own[q] = np.take_along_axis(new, order, axis=1)

    def visit(self, node: dict, q: np.ndarray) -> None:
        if not len(q):
            return
        if "rows" in node:
            for begin in range(0, len(node["rows"]), LEAF):
                self._leaf(node["rows"][begin:begin + LEAF], q)
            return
        tree, v = self.tree, node["vantage"]
        # A query has no extra component; points lie on the sphere of the longest one.
        square = np.maximum(self.square[q] + tree.longest**2 - 2 * (self.queries[q] @ tree.points[v]), 0.0)
        low, high = np.sqrt(np.maximum(square - self.square_slack[q], 0.0)), np.sqrt(square + self.square_slack[q])
        first = np.sqrt(square) <= node["middle"]
        self.visit(node["inner"], q[first])
        self.visit(node["outer"], q[~first])
        gap = np.maximum(node["outer_least"] - high[first], low[first] - node["outer_most"])
        self.visit(node["outer"], q[first][self.factor * gap <= self._reach(q[first]) + 1e-9 * tree.longest])
        gap = low[~first] - node["inner_most"]
        self.visit(node["inner"], q[~first][self.factor * gap <= self._reach(q[~first]) + 1e-9 * tree.longest])


def pair_scores(points: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner product of each row with its partner; the same for a pair wherever it is computed."""
    return np.einsum("ij,ij->i", points, queries)


def search_shard(vec_ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int = K, factor: float = FACTOR) -> pd.DataFrame:
    """(query_id, vec_id, score): the ``k`` nearest vectors of each query, its own id left out."""
    order = np.argsort(vec_ids, kind="stable")
    vec_ids, vectors = vec_ids[order], vectors[order]
    points, place = np.unique(vectors, axis=0, return_inverse=True)
    place = place.reshape(-1)
    by_point = np.argsort(place, kind="stable")  # ids of each point, rising
    begin = np.searchsorted(place[by_point], np.arange(len(points) + 1))
    first_ids = vec_ids[by_point[begin[:-1]]]
    longest = float(np.sqrt(np.einsum("ij,ij->i", points, points).max(initial=0.0)))
    found = VantageTree(points, longest).search(queries, first_ids, min(k + 1, len(points)), factor)
    out = []
    for i, query in enumerate(query_ids):
        rows = found[i][found[i] >= 0]
        scores = pair_scores(points[rows], np.broadcast_to(queries[i], (len(rows), len(queries[i]))).copy())
        pairs = []
        for row, score in zip(rows, scores, strict=True):
            ids = vec_ids[by_point[begin[row]:begin[row + 1]][: k + 1]]
            pairs += [(-score, int(x)) for x in ids if x != query][:k]
        out += [(int(query), vec_id, -score) for score, vec_id in sorted(pairs)[:k]]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def _searcher(k: int, factor: float) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def search(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if vectors.empty or queries.empty:
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        return search_shard(vectors["vec_id"].to_numpy(), np.stack(vectors["v"].to_list()), queries["vec_id"].to_numpy(), np.stack(queries["v"].to_list()), k, factor)

    return search


def usable_vectors(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, v, dim): one finite, non-zero vector of doubles for each id."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    rows = rows.where(finite & F.exists("v", lambda x: x != 0)).groupBy("vec_id").agg(F.min("v").alias("v"))
    return rows.withColumn("dim", F.size("v"))


def nearest(embeddings: DataFrame, every: int = 20, k: int = K, factor: float = FACTOR) -> DataFrame:
    """(query_id, rank, vec_id, score): neighbours of the rows whose id is divisible by ``every``."""
    vectors = usable_vectors(embeddings)
    is_query = F.col("vec_id") % every == 0
    rows, asked = vectors.agg(F.count("*"), F.count_if(is_query)).first()
    shards, blocks = max(1, -(-rows // SHARD_ROWS)), max(1, -(-asked // BLOCK_QUERIES))

    def part(count: int):
        return F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")

    def each(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    stored_side = vectors.select("vec_id", "v", "dim", part(shards).alias("shard"), each(blocks).alias("block"))
    asking_side = vectors.where(is_query).select("vec_id", "v", "dim", part(blocks).alias("block"), each(shards).alias("shard"))
    keys = ["dim", "shard", "block"]
    found = stored_side.groupBy(*keys).cogroup(asking_side.groupBy(*keys)).applyInPandas(_searcher(k, factor), "query_id bigint, vec_id bigint, score double")
    by_score = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

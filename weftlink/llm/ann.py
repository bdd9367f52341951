"""Nearest neighbours by inner product with vantage-point trees, one per shard.

Inner product becomes a metric by one more component: x is completed to the largest norm M of the table, a query by 0, so
that the squared distance is |q|^2 + M^2 - 2 q.x. Each shard of vectors builds a vantage-point tree; blocks of queries
descend it together, and a subtree is left out when the triangle inequality puts it farther than the k-th best inner
product found allows, over `factor` and with a margin for rounding that grows with the norms. Every point that reaches the
k-th best is collected, ties whole, and scored again in a fixed order. Factor one is exact; larger factors prune more. Shards meet query blocks by keys (shard, block), the smaller
side repeated, so a task holds one shard and one block whatever the table's size; equal vectors of a shard are one point.

Edge cases: vectors that are null, empty, zero, not of the table's commonest length, or hold null or non-finite
components take no part, neither as queries nor as candidates; null ids take no part; ties go to smaller ids; fewer
candidates than k are all returned; repeated rows of an id are candidates each, never of a query with that id; an empty
table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftlink.llm.common import matrix, ship, usable, usual_length

LEAF = 128


class VantageTree:
    """A vantage-point tree over the rows of `points`, searched by many queries at once."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF, seed: int = 7):
        self.points, self.leaf, self.random = points, leaf, np.random.default_rng(seed)
        self.root = self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        tries = self.random.choice(rows, min(4, len(rows)), replace=False)
        spread = [np.linalg.norm(self.points[rows[:: max(1, len(rows) // 64)]] - self.points[t], axis=1).std() for t in tries]
        vantage = tries[int(np.argmax(spread))]
        rows = rows[rows != vantage]
        d = np.linalg.norm(self.points[rows] - self.points[vantage], axis=1)
        radius = np.median(d)
        near = d <= radius
        if near.all():  # all as far: no split here
            return np.append(rows, vantage)
        return vantage, radius, self._build(rows[near]), self._build(rows[~near])

    def search(self, queries: np.ndarray, k: int, factor: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of every point whose inner product reaches the query's k-th best found, within rounding; all if there are not k."""
        self.q, self.k, self.factor = queries, k, factor
        flat = self.points[:, :-1]
        q2, most = (queries**2).sum(1), (self.points**2).sum(1).max()
        unit = 4 * (flat.shape[1] + 8) * np.finfo(float).eps
        self.square = q2 + most
        self.slack = 2 * unit * np.sqrt(q2 * most)  # of two inner products
        self.blur = 2 * unit * self.square  # of a squared distance
        self.best, self.found = np.full((len(queries), k), -np.inf), []
        self._visit(self.root, np.arange(len(queries)))
        if not self.found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        who, rows, dots = (np.concatenate(x) for x in zip(*self.found, strict=True))
        near = dots >= (self.best.min(1) - self.slack)[who]
        return who[near], rows[near]

    def _offer(self, active: np.ndarray, rows: np.ndarray) -> np.ndarray:
        dots = self.q[active] @ self.points[rows, :-1].T
        near = dots >= (self.best[active].min(1) - self.slack[active])[:, None]
        a, r = np.nonzero(near)
        self.found.append((active[a], rows[r], dots[a, r]))
        some = near.any(1)
        who = active[some]
        both = np.hstack([self.best[who], dots[some]])
        self.best[who] = np.partition(both, both.shape[1] - self.k, axis=1)[:, -self.k :]
        return dots

    def _visit(self, node, active: np.ndarray) -> None:
        if not len(active):
            return
        if isinstance(node, np.ndarray):
            if len(node):
                self._offer(active, node)
            return
        vantage, radius, inside, outside = node
        dots = self._offer(active, np.array([vantage]))[:, 0]
        d = np.sqrt(np.maximum(self.square[active] - 2 * dots, 0))
        for first, second, here in ((inside, outside, d <= radius), (outside, inside, d > radius)):
            at = active[here]
            self._visit(first, at)
            room = np.maximum(self.square[at] - 2 * (self.best[at].min(1) - self.slack[at]), 0)
            reach = np.sqrt(room + self.blur[at]) / self.factor + 4 * np.sqrt(self.blur[at])
            self._visit(second, at[np.abs(d[here] - radius) <= reach])


def dot_in_order(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, added up component by component."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


def search_shard(points: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int, factor: float, norm: float, step: int = 256):
    """The k best of one shard for each query: (query id, ids, scores), by score then id. Equal vectors count as one point, with all their ids."""
    unique, back = np.unique(points, axis=0, return_inverse=True)
    back = back.ravel()
    order = np.lexsort((ids, back))
    starts = np.searchsorted(back[order], np.arange(len(unique) + 1))
    lift = np.sqrt(np.maximum(norm**2 - (unique**2).sum(1), 0))
    tree = VantageTree(np.column_stack([unique, lift]))
    own = np.unique(np.column_stack([ids, back]), axis=0)[:, 0]  # an id may be the only one of several points
    wide = min(k + int(np.unique(own, return_counts=True)[1].max()), len(unique))
    for at in range(0, len(queries), step):
        who, rows = tree.search(queries[at : at + step], wide, factor)
        score = np.zeros(len(who))
        for i in range(queries.shape[1]):  # as dot_in_order adds up
            score += queries[at + who, i] * unique[rows, i]
        by = np.argsort(who, kind="stable")
        ends = np.searchsorted(who[by], np.arange(min(step, len(queries) - at) + 1))
        for q, (i, j) in enumerate(zip(ends[:-1], ends[1:], strict=True), start=at):
            lists = [x[x != query_ids[q]][:k] for x in (ids[order[starts[r] : starts[r + 1]]] for r in rows[by[i:j]])]
            flat = np.concatenate(lists) if lists else np.zeros(0, ids.dtype)
            scores = np.repeat(score[by[i:j]], [len(x) for x in lists])
            top = np.lexsort((flat, -scores))[:k]
            yield query_ids[q], flat[top], scores[top]


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, factor: float = 1.0, shard_rows: int = 4096, block_rows: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of `vectors` (vec_id, embedding) whose id is divisible by `every`, its `k` nearest among all others."""
    ship(vectors.sparkSession)
    dim = usual_length(vectors)
    v = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).where(usable() & (F.size("embedding") == dim) & F.col("vec_id").isNotNull())
    norm2 = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    total = v.agg(F.count("*").alias("n"), F.sum((F.col("vec_id") % every == 0).cast("long")).alias("q"), F.max(norm2).alias("m")).first()
    shards, blocks = max(1, math.ceil(total["n"] / shard_rows)), max(1, math.ceil((total["q"] or 0) / block_rows))
    norm = math.sqrt(total["m"] or 0.0)
    mark = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(shards)).cast("int")
    of = F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(blocks)).cast("int")
    here = v.select(mark.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(False).alias("query"), "vec_id", "embedding")
    asked = v.where(F.col("vec_id") % every == 0).select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), of.alias("block"), F.lit(True).alias("query"), "vec_id", "embedding")

    def run(group):
        import pyarrow as pa

        is_query = group.column("query").to_numpy(zero_copy_only=False)
        ids, points = group.column("vec_id").to_numpy(), matrix(group.column("embedding"))
        found = list(search_shard(points[~is_query], ids[~is_query], points[is_query], ids[is_query], k, factor, norm)) if 0 < is_query.sum() < len(ids) else []
        return pa.table(
            {"query_id": pa.array([x[0] for x in found], pa.int64()), "ids": pa.array([x[1].tolist() for x in found], pa.list_(pa.int64())), "scores": pa.array([x[2].tolist() for x in found], pa.list_(pa.float64()))}
        )

    best = here.union(asked).groupBy("shard", "block").applyInArrow(run, "query_id long, ids array<long>, scores array<double>")
    rows = best.distinct().select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("x")).select("query_id", F.col("x.ids").alias("vec_id"), F.col("x.scores").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

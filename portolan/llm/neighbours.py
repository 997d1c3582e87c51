"""Approximate nearest neighbours by a forest of random-projection trees.

Every block of rows has a forest of its own, and every row is in all its trees.
A node splits its rows at the median of their projections on the difference of
two of them, so copies and clusters never unbalance a tree. A query goes down
all trees of the forest at once: one priority queue holds the nodes of all of
them by the least margin on the way to a node, and leaves are taken from it
until a fixed share has been visited. The rows of these leaves are then ranked by
their exact scores. Vectors get one more component, which makes the largest
inner product the smallest distance.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from portolan.llm.blocks import NO_ID, finite, first_of_each, ids, matrix, meet, nullable
from portolan.llm.tables import ROW, numbered, stored
from portolan.sinks import Staging

TREES = 16
# A leaf has at most so many rows.
LEAF = 128
# Share of a forest's leaves that a query visits. On vectors without any structure it reaches a recall of 0.97.
VISITS = 1 / 12
# Queries that are ranked at once.
AT_ONCE = 128


class Forest:
    """Balanced trees over the rows of a matrix; the same for the same rows."""

    def __init__(self, x: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = 7):
        self.norm = np.sqrt((x * x).sum(1).max(initial=0)) or 1.0
        self.x = np.concatenate((x, np.sqrt(np.maximum(self.norm**2 - (x * x).sum(1), 0))[:, None]), 1)
        self.depth = max(0, int(np.ceil(np.log2(max(len(x), 1) / leaf))))
        self.trees = trees
        rng = np.random.default_rng(seed)
        directions, offsets, self.leaves = [], [], []
        for _ in range(trees):
            nodes = [np.arange(len(x))]
            for _ in range(self.depth):
                split = [self._split(node, rng) for node in nodes]
                directions += [s[0] for s in split]
                offsets += [s[1] for s in split]
                nodes = [half for s in split for half in s[2]]
            self.leaves += nodes
        self.directions = np.array(directions).reshape(-1, self.x.shape[1])
        self.offsets = np.array(offsets)

    def _split(self, node: np.ndarray, rng: np.random.Generator):
        a, b = rng.choice(len(node), 2, replace=False)
        direction = self.x[node[a]] - self.x[node[b]]
        size = np.linalg.norm(direction)
        if size == 0:
            direction = rng.normal(size=self.x.shape[1])
            size = np.linalg.norm(direction)
        direction = direction / size
        at = self.x[node] @ direction
        order = np.argsort(at, kind="stable")
        half = len(node) // 2
        offset = (at[order[half - 1]] + at[order[half]]) / 2
        return direction, offset, (node[order[:half]], node[order[half:]])

    def margins(self, y: np.ndarray) -> np.ndarray:
        """How far each query lies on the upper side of every node's split."""
        size = np.sqrt((y * y).sum(1, keepdims=True))
        y = y / np.where(size > 0, size, 1) * self.norm
        return np.pad(y, ((0, 0), (0, 1))) @ self.directions.T - self.offsets

    def visited(self, margin: np.ndarray, n: int) -> list[int]:
        """The first ``n`` leaves of all trees by priority, from one queue; ``margin`` is one query's."""
        inner, leaves = (1 << self.depth) - 1, 1 << self.depth
        if not inner:
            return list(range(min(n, len(self.leaves))))
        margin = margin.tolist()
        push, pop = heapq.heappush, heapq.heappop
        # (least margin on the way, negated; tree; node), nodes of a tree being numbered level by level
        queue = [(-np.inf, tree, 0) for tree in range(self.trees)]
        out: list[int] = []
        while queue and len(out) < n:
            priority, tree, node = pop(queue)
            # Down the better side at once; the other side waits.
            while node < inner:
                m = margin[tree * inner + node]
                near, far = (2 * node + 2, 2 * node + 1) if m > 0 else (2 * node + 1, 2 * node + 2)
                push(queue, (max(priority, abs(m)), tree, far))
                if priority < -abs(m):
                    priority = -abs(m)
                    if queue[0][0] < priority:
                        push(queue, (priority, tree, near))
                        break
                node = near
            else:
                out.append(tree * leaves + node - inner)
        return out


def nearest_in_block(x: np.ndarray, row: np.ndarray, vec_id: np.ndarray, y: np.ndarray, own: np.ndarray, k: int):
    """(query, position, score) of each query's ``k`` nearest rows among those its leaves hold, but not its own row."""
    forest, out = Forest(x), []
    n = max(int(np.ceil(VISITS * len(forest.leaves))), TREES // 2)
    by_row = np.argsort(row)
    for at in range(0, len(y), AT_ONCE):
        part = y[at : at + AT_ONCE]
        margins = forest.margins(part) if forest.depth else np.zeros((len(part), 0))
        guests: dict[int, list[int]] = {}
        for q in range(len(part)):
            for leaf in forest.visited(margins[q], n):
                guests.setdefault(leaf, []).append(q)
        score = np.full((len(part), len(x)), -np.inf)
        for leaf, who in guests.items():
            rows = forest.leaves[leaf]
            score[np.ix_(who, rows)] = part[who] @ x[rows].T
        mine = own[at : at + AT_ONCE]
        spot = by_row[np.minimum(np.searchsorted(row, mine, sorter=by_row), len(row) - 1)]
        here = row[spot] == mine
        score[np.flatnonzero(here), spot[here]] = -np.inf
        least = np.partition(score, -k, 1)[:, -k] if len(x) > k else np.full(len(part), -np.inf)
        # Sums in another order differ in their last bits: what is that near the limit is looked at too.
        scale = np.sqrt((part * part).sum(1)) * forest.norm
        q, r = np.nonzero((score >= (least - 1e-9 * scale)[:, None]) & (score > -np.inf))
        # The score of a pair must not depend on the block it is met in.
        s = (part[q] * x[r]).sum(1)
        order = np.lexsort((row[r], vec_id[r], -s, q))
        order = order[first_of_each(q[order], k)]
        out.append((q[order] + at, r[order], s[order]))
    return tuple(np.concatenate([o[j] for o in out]) if out else np.zeros(0, np.int64) for j in range(3))


_NEAREST = "query long, query_id long, other long, vec_id long, score double"


def _search(k: int):
    def work(rows: pa.Table, queries: pa.Table) -> pa.Table:
        x, y = matrix(rows.column("vector")), matrix(queries.column("vector"))
        width = max(x.shape[1], y.shape[1])
        x, y = (np.pad(z, ((0, 0), (0, width - z.shape[1]))) for z in (x, y))
        row, vec_id, own, own_id = (ids(t.column(c)) for t in (rows, queries) for c in (ROW, "vec_id"))
        # A block's rows come in any order; the forest must not depend on it.
        order = np.argsort(row)
        x, row, vec_id = x[order], row[order], vec_id[order]
        q, r, s = nearest_in_block(x, row, vec_id, y, own, k) if len(x) else (np.zeros(0, np.int64),) * 3
        return pa.table(
            {
                "query": pa.array(own[q], pa.int64()),
                "query_id": nullable(own_id[q], own_id[q] == NO_ID),
                "other": pa.array(row[r], pa.int64()),
                "vec_id": nullable(vec_id[r], vec_id[r] == NO_ID),
                "score": pa.array(s, pa.float64()),
            }
        )

    return work


def nearest(
    rows: DataFrame,
    is_query: Column,
    *,
    k: int = 20,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    staging: Staging | None = None,
) -> DataFrame:
    """The ``k`` rows of largest inner product found for every query: (query_id, rank, vec_id, score).

    Every row but the query's own is a candidate, a repeated row, id included,
    too. Nearest come first, ties by smaller id, null ids last. A query with
    fewer candidates has them all. Scores are sums of doubles over the original components.

    Vectors that are null, empty, zero, or hold a null or non-finite component
    take no part, neither as query nor as candidate. A shorter vector counts
    as ending in zeros. ``is_query`` null is no query. Columns of other names
    are ignored. An empty table gives no row.
    """
    query = F.coalesce(is_query, F.lit(False))
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"), query.alias("is_query"))
    rows = numbered(stored(rows, staging or Staging(rows.sparkSession), "vectors"))
    rows = rows.where(finite("vector") & F.exists("vector", lambda x: x != 0))
    found = meet(rows.drop("is_query"), rows.where("is_query").drop("is_query"), _search(k), _NEAREST)
    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last(), F.col("other")]
    rank = F.row_number().over(Window.partitionBy("query").orderBy(*order))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

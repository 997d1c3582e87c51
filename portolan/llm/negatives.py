"""Hard negatives by threshold joins on an inverted index.

An anchor's positives are its nearest rows of the same label, its negatives the
nearest of other labels whose score lies in a window below the positive's. Both
come from joins "inner product of at least t" between a block of anchors and an
inverted index of a block of rows (L2AP): a row leaves out of the lists the
first dimensions that cannot reach t alone, scores are added up list by list
from the last dimension on, and a pair goes as soon as what it has plus the
product of the norms of what is left stays below t. An anchor's threshold starts high and is lowered
until its windows are full or their lower end is reached, so nothing is missed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from portolan.llm.blocks import AT_ONCE, NO_ID, finite, first_of_each, ids, matrix, meet, nullable
from portolan.llm.tables import ROW, numbered, stored
from portolan.sinks import Staging

# Neighbouring dimensions that share a list of the index.
GROUP = 8
# A threshold of the first join, as a share of the highest possible score, and the factor of each further one.
HIGHEST, LOWER = 0.8, 0.8
# Joins after which an anchor that still lacks positives meets all rows.
ROUNDS = 8
# Norms are rounded up by this factor, so that rounding never loses a pair.
_UP = 1 + 1e-9
# Doubles hold whole numbers up to here.
_EXACT = 2.0**53


class ThresholdIndex:
    """Inverted index of integer vectors for inner products of at least a threshold."""

    def __init__(self, x: np.ndarray):
        x = np.pad(x, ((0, 0), (0, -x.shape[1] % GROUP)))
        self.groups = max(x.shape[1] // GROUP, 1)
        self.x = x if x.shape[1] else np.zeros((len(x), GROUP))
        self.norms = prefix_norms(self.x)

    def search(self, y: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, row and score of every pair whose score is at least the query's threshold."""
        y = np.pad(y, ((0, 0), (0, self.x.shape[1] - y.shape[1])))
        norms = prefix_norms(y)
        with np.errstate(divide="ignore", invalid="ignore"):
            most = np.where(t[:, None] > 0, norms / t[:, None], np.inf).max(0, initial=0)
        most[0] = 0  # no dimension, no score
        # Leading groups that a row leaves out: with them alone no query reaches its threshold.
        with np.errstate(invalid="ignore"):
            reach = np.nan_to_num(self.norms * most, nan=np.inf)
        left_out = np.minimum((reach < 1).sum(1) - 1, self.groups)
        rows = np.flatnonzero(left_out < self.groups) if (t > 0).all() else np.arange(len(self.x))
        left_out = np.minimum(left_out, self.groups - 1)
        rows = rows[np.argsort(left_out[rows], kind="stable")]
        left_out = left_out[rows]
        exact = np.int64 if norms.max(initial=0) * self.norms.max(initial=0) >= _EXACT else np.float64
        x, y = self.x[rows].astype(exact), y.astype(exact)
        score = np.zeros((len(y), len(rows)), exact)
        for group in range(self.groups - 1, -1, -1):
            # The list of a group holds the rows that do not leave it out: the first ones.
            n = np.searchsorted(left_out, group, "right")
            cut = slice(group * GROUP, (group + 1) * GROUP)
            score[:, :n] += y[:, cut] @ x[:n, cut].T
            if group in (self.groups // 2, self.groups // 4):
                alive = np.flatnonzero((self._bound(score, norms, rows, np.maximum(left_out, group)) >= t[:, None]).any(0))
                if len(alive) < 0.8 * len(rows):
                    score, rows, left_out, x = score[:, alive], rows[alive], left_out[alive], x[alive]
        q, r = np.nonzero(self._bound(score, norms, rows, left_out) >= t[:, None])
        found = score[q, r]
        rest = np.flatnonzero(left_out[r] > 0)
        for at in range(0, len(rest), 1 << 16):
            part = rest[at : at + (1 << 16)]
            found[part] = np.einsum("ij,ij->i", y[q[part]], x[r[part]])
        keep = found >= t[q]
        return q[keep], rows[r[keep]], found[keep].astype(np.int64)

    def _bound(self, score: np.ndarray, norms: np.ndarray, rows: np.ndarray, left: np.ndarray) -> np.ndarray:
        """The most a pair can reach: its score so far and the norms of the dimensions before ``left``."""
        return score + norms[:, left] * self.norms[rows, left] * _UP


def prefix_norms(x: np.ndarray) -> np.ndarray:
    """Norms of the first 0, 1, 2 .. groups of every row's dimensions."""
    squares = (x * x).reshape(len(x), -1, GROUP).sum(2)
    return np.sqrt(np.concatenate((np.zeros((len(x), 1)), np.cumsum(squares, 1)), 1)) * _UP


def best_positives(index: ThresholdIndex, row: np.ndarray, vec_id: np.ndarray, y: np.ndarray, own: np.ndarray, k: int):
    """(query, position, score) of each query's first ``k`` rows but its own, highest scores first."""
    out, todo = [], np.arange(len(y))
    highest = prefix_norms(np.pad(y, ((0, 0), (0, -y.shape[1] % GROUP))))[:, -1] * index.norms[:, -1].max(initial=0)
    for i in range(ROUNDS + 1):
        if not len(todo):
            break
        t = highest[todo] * HIGHEST * LOWER**i if i < ROUNDS else np.full(len(todo), -np.inf)
        q, r, s = index.search(y[todo], t)
        other = row[r] != own[todo[q]]
        q, r, s = q[other], r[other], s[other]
        full = np.bincount(q, minlength=len(todo)) >= k if i < ROUNDS else np.ones(len(todo), bool)
        mine = full[q]
        q, r, s = todo[q[mine]], r[mine], s[mine]
        order = np.lexsort((row[r], vec_id[r], -s, q))
        order = order[first_of_each(q[order], k)]
        out.append((q[order], r[order], s[order]))
        todo = todo[~full]
    return tuple(np.concatenate([o[j] for o in out]) if out else np.zeros(0, np.int64) for j in range(3))


def best_negatives(
    index: ThresholdIndex,
    row: np.ndarray,
    vec_id: np.ndarray,
    label: np.ndarray,
    y: np.ndarray,
    own_label: np.ndarray,
    low: np.ndarray,
    high: np.ndarray,
    k: int,
):
    """(query, window, position, score): the first ``k`` rows of another label in every window low..high of a query.

    ``low`` and ``high`` have a column per window; an empty window has low > high.
    """
    out = []
    wanted = low <= high
    lowest = np.where(wanted, low, np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max)
    # The highest threshold is a little below the lowest window's upper end.
    t = np.where(wanted, high, np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max) * LOWER
    todo = np.flatnonzero(wanted.any(1))
    while len(todo):
        now = np.maximum(t[todo], lowest[todo])
        q, r, s = index.search(y[todo], now)
        other = label[r] != own_label[todo[q]]
        q, r, s = q[other], r[other], s[other]
        order = np.lexsort((row[r], vec_id[r], -s, q))
        q, r, s = q[order], r[order], s[order]
        full, found = np.ones(len(todo), bool), []
        for w in range(low.shape[1]):
            inside = (s <= high[todo[q], w]) & (s >= low[todo[q], w])
            n = np.bincount(q[inside], minlength=len(todo))
            full &= ~wanted[todo, w] | (n >= k) | (now <= low[todo, w])
            part = np.flatnonzero(inside)
            found.append(part[first_of_each(q[part], k)])
        for w, part in enumerate(found):
            part = part[full[q[part]]]
            out.append((todo[q[part]], np.full(len(part), w), r[part], s[part]))
        t[todo] *= LOWER
        todo = todo[~full]
    return tuple(np.concatenate([o[j] for o in out]) if out else np.zeros(0, np.int64) for j in range(4))


def _integers(table: pa.Table, scale: float) -> np.ndarray:
    return np.floor(matrix(table.column("vector")) * scale)


def _equal_width(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(x.shape[1], y.shape[1], 1)
    return tuple(np.pad(z, ((0, 0), (0, width - z.shape[1]))) for z in (x, y))


_FOUND = "anchor long, other long, vec_id long, score long"


def _positives(k: int, scale: float):
    def work(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        x, y = _equal_width(_integers(rows, scale), _integers(anchors, scale))
        row, vec_id, label = (ids(rows.column(c)) for c in (ROW, "vec_id", "label"))
        own, own_label = ids(anchors.column(ROW)), ids(anchors.column("label"))
        out = []
        for value in np.unique(own_label):
            at = np.flatnonzero(label == value)
            if not len(at):
                continue
            index = ThresholdIndex(x[at])
            mine = np.flatnonzero(own_label == value)
            for i in range(0, len(mine), AT_ONCE):
                part = mine[i : i + AT_ONCE]
                q, r, s = best_positives(index, row[at], vec_id[at], y[part], own[part], k)
                out.append((own[part[q]], row[at[r]], vec_id[at[r]], s))
        anchor, other, found, score = (
            np.concatenate([o[j] for o in out]) if out else np.zeros(0, np.int64) for j in range(4)
        )
        return pa.table(
            {"anchor": pa.array(anchor), "other": pa.array(other), "vec_id": nullable(found, found == NO_ID), "score": pa.array(score)}
        )

    return work


_MINED = "anchor long, anchor_id long, place int, positive_id long, positive_score long, other long, negative_id long, negative_score long"


def _negatives(k: int, scale: float, low: int, high: int):
    def work(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        x, y = _equal_width(_integers(rows, scale), _integers(anchors, scale))
        row, vec_id, label = (ids(rows.column(c)) for c in (ROW, "vec_id", "label"))
        own, own_label = ids(anchors.column(ROW)), ids(anchors.column("label"))
        sizes = anchors.column("n").to_numpy()
        scores = _ragged(anchors.column("scores"), int(sizes.max(initial=0)))
        there = np.arange(scores.shape[1]) < sizes[:, None]
        scores = np.where(there, scores, 0)
        # Whole scores n with low * p <= 100 * n <= high * p.
        least, most = -(-low * scores // 100), high * scores // 100
        least, most = np.where(there, least, 1), np.where(there, most, 0)
        index, out = ThresholdIndex(x), []
        for i in range(0, len(own), AT_ONCE):
            part = np.arange(i, min(i + AT_ONCE, len(own)))
            q, w, r, s = best_negatives(index, row, vec_id, label, y[part], own_label[part], least[part], most[part], k)
            out.append((part[q], w, r, s))
        q, w, r, s = (np.concatenate([o[j] for o in out]) if out else np.zeros(0, np.int64) for j in range(4))
        q, w, r = q.astype(np.int64), w.astype(np.int64), r.astype(np.int64)
        anchor_id, positive = ids(anchors.column("vec_id"))[q], _ragged(anchors.column("positives"), scores.shape[1])[q, w]
        return pa.table(
            {
                "anchor": pa.array(own[q], pa.int64()),
                "anchor_id": nullable(anchor_id, anchor_id == NO_ID),
                "place": pa.array(w, pa.int32()),
                "positive_id": nullable(positive, positive == NO_ID),
                "positive_score": pa.array(scores[q, w], pa.int64()),
                "other": pa.array(row[r], pa.int64()),
                "negative_id": nullable(vec_id[r], vec_id[r] == NO_ID),
                "negative_score": pa.array(s, pa.int64()),
            }
        )

    return work


def _ragged(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of integers, nulls among them, as the rows of a matrix."""
    out = np.full((len(column), width), NO_ID)
    for i, values in enumerate(column.to_pylist()):
        out[i, : len(values)] = [NO_ID if v is None else v for v in values]
    return out


def mine(
    rows: DataFrame,
    is_anchor: Column,
    *,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: float = 256,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    staging: Staging | None = None,
) -> DataFrame:
    """Hard negatives: (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become ``floor(scale * x)``; a score is the inner product of
    these integers, higher ones come first, ties by smaller id, null ids last.
    An anchor's positives are its first ``positives`` other rows of its label,
    all if there are fewer. For each, the first ``negatives`` rows of another
    label with ``low * p <= 100 * score <= high * p`` are returned, p being the positive's score;
    of a negative p there are none.

    Rows with a null label, a null vector or a null or non-finite component
    take no part; nor do those whose squared norm reaches 2^56, as a hundred
    times their score may exceed 64 bits. An empty vector has score 0 with all; a shorter vector
    counts as ending in zeros. A row that repeats another, id included, is a
    row of its own: it can be the other's positive, and as an anchor it has
    its own results. A null id can be found but ``is_anchor`` must be true for
    an anchor. Columns of other names are ignored. An empty table gives no row.
    """
    staging = staging or Staging(rows.sparkSession)
    value = F.col(label) if isinstance(label, str) else label
    anchor = F.coalesce(is_anchor, F.lit(False))
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), value.cast("long").alias("label"), F.col(vector).alias("vector"), anchor.alias("is_anchor"))
    rows = numbered(stored(rows, staging, "vectors"))
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + F.pow(F.floor(x.cast("double") * scale).cast("double"), 2))
    rows = rows.where(finite("vector") & F.col("label").isNotNull()).where(square < 2.0**56)
    all_rows, anchors = rows.drop("is_anchor"), rows.where("is_anchor").drop("is_anchor")

    first = [F.col("score").desc(), F.col("vec_id").asc_nulls_last(), F.col("other")]
    found = meet(all_rows, anchors, _positives(positives, scale), _FOUND)
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(*first))
    found = found.withColumn("place", place).where(F.col("place") <= positives)
    best = found.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("best"))
    best = best.select(
        F.col("anchor").alias(ROW), F.size("best").alias("n"), F.col("best.vec_id").alias("positives"), F.col("best.score").alias("scores")
    )
    anchors = staging.write(anchors.join(best, ROW), "anchors")

    mined = meet(all_rows, anchors, _negatives(negatives, scale, low, high), _MINED)
    first = [F.col("negative_score").desc(), F.col("negative_id").asc_nulls_last(), F.col("other")]
    rank = F.row_number().over(Window.partitionBy("anchor", "place").orderBy(*first))
    mined = mined.withColumn("rank", rank).where(F.col("rank") <= negatives)
    return mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

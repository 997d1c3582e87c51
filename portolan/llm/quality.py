"""Quality selection by importance resampling.

Two generative models over hashed byte n-grams are compared: one of all raw
text, one of labelled target text. The log ratio of a text under both, taken
over its least target-like window of each length, is its log importance weight;
weights above one count as one, so text as good as the target never competes
with itself. Of all texts the ``k`` with the largest log weight plus Gumbel
noise are selected, which samples without replacement by weight. ``k`` is the
sum of all weights, the number of texts that are expected to pass.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm import words
from portolan.llm.tables import ROW, numbered, stored
from portolan.operators import dense_key_by_range
from portolan.sinks import Staging

GRAM, SLOT_BITS = 5, 19
# The last slot counts words that repeat the word before them.
SLOTS = (1 << SLOT_BITS) + 1
WINDOWS = (6, 64)
# Smoothing counts to choose from: the better one on labelled rows, for each window.
PRIORS = (1.0, 5.0, 20.0, 80.0)
TEMPERATURE = 0.25
# Labelled rows that may be used: a share of all labels, fixed by hash, of about this many.
MAX_LABELS = 200_000
_SEGMENTS = 32
# Text worked on at once; its numbers take about eighty times as much.
BLOCK_BYTES = 1 << 18
FIT, CHECK, LOW, TOXIC = 1, 2, 3, 4


def features(block: words.Block) -> tuple[np.ndarray, np.ndarray]:
    """The slot of the n-gram at each byte, and the bytes where a word repeats the one before it."""
    padded = np.concatenate((block.data, np.zeros(8, np.uint8)))
    grams = np.ndarray((len(block.data),), "<u8", padded, strides=(1,)) & np.uint64((1 << (8 * GRAM)) - 1)
    slots = (grams * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOT_BITS)).astype(np.int32)
    h = block.hashes()
    again = np.zeros(len(h), bool)
    again[1:] = h[1:] == h[:-1]
    first = block.offsets[:-1]
    again[first[first < len(h)]] = False
    return slots, block.starts[again]


def _usable(block: words.Block) -> np.ndarray:
    """Marks the bytes whose n-gram ends in the same text."""
    left = np.repeat(block.bounds[1:], np.diff(block.bounds)) - np.arange(len(block.data))
    return left >= GRAM


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
    for batch in batches:
        fit = batch.column("role").to_numpy(zero_copy_only=False) == FIT
        for block in words.blocks(batch.column("text"), lower=True, limit=BLOCK_BYTES):
            slots, again = features(block)
            usable = _usable(block)
            raw[:-1] += np.bincount(slots[usable], minlength=SLOTS - 1)
            raw[-1] += len(again)
            mine = fit[block.first : block.first + len(block.counts)]
            if mine.any():
                ours = np.repeat(mine, np.diff(block.bounds))
                target[:-1] += np.bincount(slots[usable & ours], minlength=SLOTS - 1)
                target[-1] += np.count_nonzero(ours[again])
    parts = zip(np.array_split(raw, _SEGMENTS), np.array_split(target, _SEGMENTS), strict=True)
    data = [np.stack(x).astype("<i8").tobytes() for x in parts]
    yield pa.RecordBatch.from_arrays([pa.array(range(_SEGMENTS), pa.int32()), pa.array(data, pa.binary())], ["segment", "counts"])


def _added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_buffer(), "<i8") for x in table.column("counts"))
    return pa.table({"segment": table.column("segment")[:1], "counts": pa.array([total.tobytes()], pa.binary())})


def lowest_windows(column: pa.Array | pa.ChunkedArray, tables: Sequence[tuple[np.ndarray, int]]) -> list[np.ndarray]:
    """Per (log ratios, window), each text's smallest sum of ratios over that many n-grams in a row."""
    out: list[list[np.ndarray]] = [[] for _ in tables]
    for block in words.blocks(column, lower=True, limit=BLOCK_BYTES):
        slots, again = features(block)
        unusable = ~_usable(block)
        size = np.diff(block.bounds)
        begin, n = block.bounds[:-1], np.maximum(size - GRAM + 1, 0)
        stop = np.repeat(begin + n, size)
        for k, (ratios, width) in enumerate(tables):
            x = ratios[slots].astype(np.float64)
            x[again] += ratios[-1]
            x[unusable] = 0
            total = np.concatenate(([0.0], np.cumsum(x)))
            sums = np.full(len(x), np.inf)
            fits = np.flatnonzero(np.arange(len(x)) + width <= stop)
            sums[fits] = total[fits + width] - total[fits]
            low = total[begin + n] - total[begin]
            long = np.flatnonzero(n >= width)
            if len(long):
                # Texts without bytes lie between the others without a place of their own.
                some = np.flatnonzero(size > 0)
                least = np.full(len(size), np.inf)
                least[some] = np.minimum.reduceat(sums, begin[some])
                low[long] = least[long]
            out[k].append(low)
    return [np.concatenate(x) if x else np.zeros(0) for x in out]


@dataclass
class Model:
    """Log ratios, window and limit of each test that a text has to pass."""

    tests: list[tuple[np.ndarray, int, float]]

    def weigh(self):
        """Column function: log importance weight (at most 0) of a text."""
        tables, limits = [(r, w) for r, w, _ in self.tests], [t for _, _, t in self.tests]

        @F.arrow_udf("double")
        def log_weight(text: pa.Array) -> pa.Array:
            gap = [(m - t) / TEMPERATURE for m, t in zip(lowest_windows(text, tables), limits, strict=True)]
            return pa.array(np.minimum(0.0, np.min(gap, axis=0)) if gap else np.zeros(len(text)))

        return log_weight


def _limit(good: np.ndarray, bad: np.ndarray) -> tuple[float, float]:
    """The split of two samples with the fewest errors in proportion, amid the best ones; and how good it is."""
    cuts = np.unique(np.concatenate((good, bad)))
    cuts = np.concatenate(([cuts[0] - 1], (cuts[1:] + cuts[:-1]) / 2, [cuts[-1] + 1]))
    kept = 1 - np.searchsorted(np.sort(good), cuts, "right") / len(good)
    caught = np.searchsorted(np.sort(bad), cuts, "right") / len(bad)
    # A target text lost weighs as much as three others let through.
    value = 3 * kept + caught
    best = np.flatnonzero(value >= value.max() - 1e-12)
    return float(cuts[best].mean()), float(value.max())


def with_roles(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``role``: how the labels let a row be used (0: not)."""
    n = labels.count()
    of = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    share = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) < int((1 << 20) * min(1.0, MAX_LABELS / max(n, 1)))
    odd = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2)) == 1
    role = F.when(F.col("t") == 1, TOXIC).when(F.col("q") == 0, LOW).when(F.col("q") == 1, F.when(odd, FIT).otherwise(CHECK))
    of = of.where(share).select("doc_id", role.alias("role"))
    # About MAX_LABELS rows of two numbers: a few MB at any size of the corpus.
    return docs.join(F.broadcast(of), "doc_id", "left").withColumn("role", F.coalesce("role", F.lit(0)))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Count n-grams in all of ``docs`` and in labelled target rows, then set the limits on other labelled rows.

    ``docs`` has doc_id and text; ``labels`` has doc_id, quality and toxic (1 or 0).
    Target rows are those of quality 1 that are not toxic; half of them, by hash,
    give the target model, the rest the limits: of the short window against toxic
    rows, of the long one against rows of quality 0. Without labels of a kind its
    test is absent and refuses nothing.
    """
    rows = with_roles(docs.select("doc_id", "text"), labels.select("doc_id", "quality", "toxic"))
    parts = rows.select("text", "role").mapInArrow(_counts, "segment int, counts binary")
    parts = parts.groupBy("segment").applyInArrow(_added, "segment int, counts binary").collect()
    if not parts:
        return Model([])
    # SLOTS numbers per model, however large the corpus is.
    both = [np.frombuffer(x.counts, "<i8").reshape(2, -1) for x in sorted(parts)]
    raw, target = np.concatenate(both, axis=1).astype(np.float64)
    if not target.any():
        return Model([])
    share = target[:-1].sum() / raw[:-1].sum()
    ratios = [np.log((target + p * share) / ((raw + p) * share)).astype(np.float32) for p in PRIORS]
    tables = [(r, w) for w in WINDOWS for r in ratios]
    names = [f"m{k}" for k in range(len(tables))]

    @F.arrow_udf("struct<" + ",".join(f"{x}:double" for x in names) + ">")
    def low(text: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays([pa.array(x) for x in lowest_windows(text, tables)], names)

    # At most MAX_LABELS rows or so.
    known = rows.where(F.col("role") > FIT).select("role", low("text").alias("m")).select("role", "m.*").collect()
    known = np.array([list(x) for x in known], np.float64).reshape(-1, 1 + len(tables))
    tests = []
    for width, role in zip(WINDOWS, (TOXIC, LOW), strict=True):
        found = []
        for k, (r, w) in enumerate(tables):
            good, bad = known[known[:, 0] == CHECK, 1 + k], known[known[:, 0] == role, 1 + k]
            if w == width and len(good) and len(bad):
                limit, value = _limit(good, bad)
                found.append((value, k, (r, w, limit)))
        if found:
            tests.append(max(found, key=lambda x: (x[0], x[1]))[2])
    return Model(tests)


def select(docs: DataFrame, labels: DataFrame, *, k: int | None = None, seed: int = 0, staging: Staging) -> DataFrame:
    """Add ``log_weight``, ``gumbel_key`` and ``selected`` to ``docs`` (doc_id, text and any others).

    ``k`` rows are selected, by default as many as the weights sum up to. The
    noise depends on doc_id and ``seed`` alone. Of equal keys the earlier rows
    win. A null or empty text has weight 1: nothing speaks against it.
    """
    docs = stored(docs, staging)
    model = fit(docs, labels)
    unit = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    scored = numbered(docs).withColumn("log_weight", model.weigh()("text"))
    scored = scored.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(unit)))
    keys = staging.write(scored.select(ROW, "log_weight", (-F.col("gumbel_key")).alias("down")), "keys")
    if k is None:
        k = round(keys.select(F.sum(F.exp("log_weight"))).first()[0] or 0)
    if k <= 0:
        return scored.withColumn("selected", F.lit(False)).drop(ROW)
    # The last row selected: a number and a row, with which every row decides for itself.
    last = dense_key_by_range(keys.select("down", ROW), ["down", ROW], "rank", staging).where(F.col("rank") == k - 1).first()
    if last is None:
        return scored.withColumn("selected", F.lit(True)).drop(ROW)
    down = -F.col("gumbel_key")
    chosen = (down < last["down"]) | ((down == last["down"]) & (F.col(ROW) <= last[ROW]))
    return scored.withColumn("selected", chosen).drop(ROW)

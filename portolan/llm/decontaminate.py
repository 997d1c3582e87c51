"""Benchmark decontamination by SimHash over item-sized windows.

Every window of an item's size that holds enough of the benchmark's shingles to
be a leak at all gets a 64-bit SimHash of its word triples, from running sums per
bit. Fingerprints are looked up in blocks of 16 bits: two that differ in at most
``RADIUS`` bits differ in at most ``RADIUS // BLOCKS`` bits of some block, and the
table of each block holds every value that near to an item, so no pair within the
radius is missed. What lies beyond the radius, or is a text shorter than the item,
is found by the item's rarest shingles: so many that a leak holds one of them.
Hence no leak is missed. Candidates are then verified by the
exact similarity of their shingles of five words, weighted by how often each
occurs in the window and in the item.

Items are searched for in batches of bounded size. All batches go through the
driver and into the workers of one pass over the texts, so the benchmark must
fit the memory of each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm import words

SHINGLE, FEATURE = 5, 3
BLOCKS, RADIUS = 4, 15
# Of so few items of one size, a window that is near any in some block is compared with all.
FEW = 64
ITEM_BATCH = 5000
# Texts are searched in blocks whose running sums fit a processor's cache.
SEARCH_BYTES = 1 << 18
SIMILAR = 0.8
_HIT = "struct<item_id:long,similarity:double,first_word:long,n_words:long>"


def _shingles(h: np.ndarray, length: int = SHINGLE) -> np.ndarray:
    return words.runs(h, min(length, len(h)))


def fingerprints(h: np.ndarray, size: int, step: int = 1) -> np.ndarray:
    """SimHash of every ``step``-th window of ``size`` words: per bit, whether most of its triples set it."""
    length = min(FEATURE, size)
    sums = _running(words.runs(h, length), size)
    return _windows(sums, size, length, step)


def _running(features: np.ndarray, size: int) -> np.ndarray:
    """Per place and bit, how many of the features before it set the bit.

    For windows below 256 words eight counts share a 64-bit number. Sums of
    these may overflow, but the difference of two is exact while each count of
    the window fits its byte.
    """
    bits = np.unpackbits(np.ascontiguousarray(features).view(np.uint8)).reshape(-1, 64)
    counts = bits.view(np.uint64) if size < 256 else bits.astype(np.uint32)
    out = np.zeros((len(features) + 1, counts.shape[1]), counts.dtype)
    np.cumsum(counts, axis=0, out=out[1:])
    return out


def _windows(sums: np.ndarray, size: int, length: int, step: int) -> np.ndarray:
    return _windows_at(sums, size, length, np.arange(0, max(len(sums) - (size - length + 1), 0), step))


def _windows_at(sums: np.ndarray, size: int, length: int, at: np.ndarray) -> np.ndarray:
    """SimHash of the windows that begin at the places ``at``."""
    n = size - length + 1
    if not len(at):
        return np.zeros(0, np.uint64)
    ones = sums[at + n] - sums[at]
    if ones.dtype == np.uint64:
        ones = ones.view(np.uint8)
    return np.packbits((ones > n // 2).reshape(-1)).view(np.uint64)


class Index:
    """Items of one window size, by the blocks of their fingerprints."""

    def __init__(self, size: int, prints: np.ndarray, items: Sequence[int]):
        self.size, self.prints, self.items = size, prints, np.array(items)
        masks = [sum(1 << b for b in bits) for k in range(RADIUS // BLOCKS + 1) for bits in combinations(range(16), k)]
        masks = np.array(masks, np.uint16)
        self.any, self.starts, self.lists = [], [], []
        for block in range(BLOCKS):
            near = (self._blocks(prints)[:, block][:, None] ^ masks).ravel()
            order = np.argsort(near, kind="stable")
            self.starts.append(np.searchsorted(near[order], np.arange((1 << 16) + 1)).astype(np.int32))
            self.lists.append((order // len(masks)).astype(np.int32))
            self.any.append(np.diff(self.starts[-1]) > 0)

    @staticmethod
    def _blocks(prints: np.ndarray) -> np.ndarray:
        return prints.view(np.uint16).reshape(-1, BLOCKS)

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (place, item) whose fingerprints differ in at most ``RADIUS`` bits."""
        values = self._blocks(prints)
        hit = self.any[0][values[:, 0]]
        for block in range(1, BLOCKS):
            hit |= self.any[block][values[:, block]]
        hit = np.flatnonzero(hit)
        if len(self.items) <= FEW:  # as many comparisons as the lists would name, without the lists
            place, item = np.nonzero(np.bitwise_count(prints[hit][:, None] ^ self.prints) <= RADIUS)
            return hit[place], self.items[item]
        pairs = [self._listed(prints, values, hit, block) for block in range(BLOCKS)]
        both = np.unique(np.concatenate(pairs, axis=1), axis=1)
        return both[0], self.items[both[1]]

    def _listed(self, prints: np.ndarray, values: np.ndarray, hit: np.ndarray, block: int) -> np.ndarray:
        value = values[hit, block].astype(np.int32)
        begin = self.starts[block][value]
        count = self.starts[block][value + 1] - begin
        place = np.repeat(hit, count)
        within = np.arange(len(place)) - np.repeat(np.cumsum(count) - count, count)
        item = self.lists[block][np.repeat(begin, count) + within]
        close = np.bitwise_count(prints[place] ^ self.prints[item]) <= RADIUS
        return np.stack((place[close], item[close]))


class Benchmark:
    """Items ready to be searched for; (item_id, text) pairs."""

    def __init__(self, items: Sequence[tuple[int, str]]):
        self.ids, self.words, by_size = [], [], {}
        for block in words.blocks(pa.array([t for _, t in items], pa.string()), lower=True):
            h, offsets = block.hashes(), block.offsets
            for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                if b > a:
                    self.ids.append(items[block.first + i][0])
                    self.words.append(h[a:b])
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.shingles = [Counter(_shingles(w).tolist()) for w in self.words]
        for at, w in enumerate(self.words):
            by_size.setdefault(len(w), []).append(at)
        self.held = Counter(s for c in self.shingles for s in c)
        by_length: dict[int, set[int]] = {}
        for c, n in zip(self.shingles, self.sizes.tolist(), strict=True):
            by_length.setdefault(min(SHINGLE, n), set()).update(c)
        self.known = {length: Known(shingles) for length, shingles in by_length.items()}
        self.indexes = []
        for size, own in sorted(by_size.items()):
            prints = np.concatenate([fingerprints(self.words[at], size) for at in own])
            self.indexes.append(Index(size, prints, own))
        self._finds: dict[float, list[Find]] = {}

    def finds(self, similar: float) -> list[Find]:
        if similar not in self._finds:
            self._finds[similar] = [Find(self, index, similar) for index in self.indexes]
        return self._finds[similar]

    def similarity(self, h: np.ndarray, item: int) -> float:
        """Shingles in common by shingles in either, each as often as it occurs; no other item plays a part."""
        mine, own = Counter(_shingles(h).tolist()), self.shingles[item]
        return (mine & own).total() / (mine | own).total()

    def rarest(self, item: int, n: int) -> set[int]:
        """The ``n`` shingles of an item, as often as each occurs, that the fewest items hold."""
        own = sorted(self.shingles[item].elements(), key=lambda s: (self.held[s], s))
        return set(own[:n])

    def best(self, h: np.ndarray, item: int, similar: float) -> tuple[float, int]:
        """The best window of the item's size, the first of equals; a shorter text is compared as a whole."""
        size, own = len(self.words[item]), self.shingles[item]
        if len(h) < size:
            return self.similarity(h, item), 0
        runs = _shingles(h, min(SHINGLE, size))
        m = size - min(SHINGLE, size) + 1
        places = np.flatnonzero(_full(_sums(np.isin(runs, np.array(list(own), np.uint64))), m, least_shared(m, similar)))
        best, mine, both, last = (0.0, 0), Counter(), 0, None
        runs = runs.tolist()
        for at in places.tolist():
            if last is None or at != last + 1:
                mine = Counter(runs[at : at + m])
                both = (mine & own).total()
            else:  # one shingle leaves, one comes
                both -= mine[runs[last]] <= own[runs[last]]
                mine[runs[last]] -= 1
                mine[runs[last + m]] += 1
                both += mine[runs[last + m]] <= own[runs[last + m]]
            last = at
            best = max(best, (both / (2 * m - both), -at))
        return best[0], -best[1]

    def search(self, column: pa.Array | pa.ChunkedArray, similar: float) -> Iterator[list[dict]]:
        """Per text its hits, one for each item found, the best first."""
        finds = self.finds(similar)
        lowest = {k: min(min(f.least, f.least_whole) for f in finds if f.length == k) for k in self.known}
        for block in words.blocks(column, lower=True, limit=SEARCH_BYTES):
            h, offsets = block.hashes(), block.offsets
            known, may = {}, np.zeros(len(block.counts), bool)
            for length, fewest in lowest.items():
                marks = np.zeros(len(h), bool)
                marks[: max(len(h) - length + 1, 0)] = self.known[length].marks(words.runs(h, length))
                # A run that goes on in the next text is none.
                known[length] = _sums(marks & words.whole(offsets, length, len(h)))
                may |= np.diff(known[length][offsets]) >= fewest
            for t, (begin, stop) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                hits = {}
                if may[t] and stop > begin:
                    counts = {k: v[begin : max(stop - k + 2, begin + 1)] for k, v in known.items()}
                    for item in self._candidates(h[begin:stop], counts, finds):
                        score, at = self.best(h[begin:stop], item, similar)
                        if score >= similar:
                            hits[item] = (score, at)
                out = [
                    {"item_id": self.ids[i], "similarity": s, "first_word": a, "n_words": min(len(self.words[i]), stop - begin)}
                    for i, (s, a) in hits.items()
                ]
                yield sorted(out, key=lambda x: (-x["similarity"], x["item_id"]))

    def _candidates(self, h: np.ndarray, known: dict[int, np.ndarray], finds: list[Find]) -> set[int]:
        """Items of which the text may hold a leak; ``known`` has running counts of the benchmark's shingles."""
        out: set[int] = set()
        runs: dict[int, np.ndarray] = {}
        sums: dict[tuple[int, bool], np.ndarray] = {}
        for find in finds:
            counts, size, length = known[find.length], find.index.size, find.length
            if counts[-1] - counts[0] < (find.least if len(h) >= size else find.least_whole):
                continue
            if length not in runs:
                runs[length] = words.runs(h, length)
            if len(h) < size:
                out.update(find.anchored(runs[length]))
                continue
            full = np.flatnonzero(_full(counts, find.m, find.least))
            if not len(full):
                continue
            kind = (min(FEATURE, size), size < 256)
            if kind not in sums:
                sums[kind] = _running(words.runs(h, kind[0]), size)
            out.update(find.index.near(_windows_at(sums[kind], size, kind[0], full))[1].tolist())
            covered = np.zeros(len(runs[length]) + 1, np.int64)
            np.add.at(covered, full, 1)
            np.add.at(covered, full + find.m, -1)
            out.update(find.anchored(runs[length][np.cumsum(covered[:-1]) > 0]))
        return out


def _sums(flags: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(flags)))


def _full(sums: np.ndarray, m: int, least: int) -> np.ndarray:
    """Which runs of ``m`` places have ``least`` marks or more, by the running sums of the marks."""
    return sums[m:] - sums[: max(len(sums) - m, 0)] >= least


def least_shared(m: int, similar: float) -> int:
    """Shingles that a window of ``m`` has in common with an item of ``m``, if their similarity is ``similar``."""
    return next((b for b in range(m + 1) if b / (2 * m - b) >= similar), m + 1)


class Known:
    """All shingles of one length that items hold."""

    def __init__(self, shingles: set[int]):
        self.keys = np.array(sorted(shingles), np.uint64)
        self.bits = np.zeros(1 << 20, bool)
        self.bits[self.keys >> np.uint64(44)] = True

    def marks(self, runs: np.ndarray) -> np.ndarray:
        out = self.bits[runs >> np.uint64(44)]
        some = np.flatnonzero(out)
        if len(some):
            out[some] = self.keys[np.minimum(np.searchsorted(self.keys, runs[some]), len(self.keys) - 1)] == runs[some]
        return out


class Find:
    """How leaks of the items of one size are found for a given similarity."""

    def __init__(self, items: Benchmark, index: Index, similar: float):
        self.index, self.length = index, min(SHINGLE, index.size)
        self.m = index.size - self.length + 1
        self.least = least_shared(self.m, similar)
        # A shorter text is all in the item at best.
        self.least_whole = next((b for b in range(self.m + 1) if b / self.m >= similar), self.m + 1)
        # A leak lacks at most m - least of the item's shingles, so of one more it holds one.
        spare = self.m - min(self.least, self.least_whole) + 1
        held = [(s, item) for item in index.items.tolist() for s in items.rarest(item, spare)]
        order = sorted(range(len(held)), key=lambda k: held[k])
        self.keys = np.array([held[k][0] for k in order], np.uint64)
        self.items = np.array([held[k][1] for k in order], np.int64)

    def anchored(self, runs: np.ndarray) -> list[int]:
        """Items one of whose rarest shingles is among ``runs``."""
        runs = np.unique(runs)
        begin, stop = np.searchsorted(self.keys, runs, "left"), np.searchsorted(self.keys, runs, "right")
        some = np.flatnonzero(stop > begin)
        return np.unique(np.concatenate([self.items[a:b] for a, b in zip(begin[some], stop[some], strict=True)])).tolist() if len(some) else []


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, similar: float = SIMILAR) -> DataFrame:
    """Add ``leaks`` to ``docs``: an array of (item_id, similarity, first_word, n_words), the best first.

    A leak is a window of the item's number of words whose shingle similarity
    with the item is at least ``similar``, whatever else the benchmark holds. A null or wordless text
    has none; items without words, or with a null id or text, are not searched
    for. Equal items under several ids are all reported.
    """
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text")
    n = items.count()
    leaks = []
    for k in range(max(1, -(-n // ITEM_BATCH))):
        batches = max(1, -(-n // ITEM_BATCH))
        some = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(batches)) == k)
        # About ITEM_BATCH items.
        leaks.append(_search(Benchmark(sorted((r.item_id, r.text) for r in some.toLocalIterator())), similar)("text"))
    found = leaks[0] if len(leaks) == 1 else F.flatten(F.array(*leaks))
    order = lambda a, b: F.when(a["similarity"] > b["similarity"], -1).when(a["similarity"] < b["similarity"], 1).when(a["item_id"] < b["item_id"], -1).otherwise(1)
    return docs.withColumn("leaks", found if len(leaks) == 1 else F.array_sort(found, order))


def _search(items: Benchmark, similar: float):
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("first_word", pa.int64()), ("n_words", pa.int64())]))

    items.finds(similar)  # made once, not by every task

    @F.arrow_udf(f"array<{_HIT}>")
    def search(text: pa.Array) -> pa.Array:
        return pa.array(list(items.search(text, similar)), kind)

    return search

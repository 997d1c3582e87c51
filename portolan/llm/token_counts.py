"""Token counts by a map-side lookup in two tiers; no word of a text is shuffled to be looked up.

First tier: a compact open-addressing table of the lengths, in tokens, of
frequent words, sent to every worker. It holds 64-bit hashes and one byte per
word and is looked up for all words of a block at once. Second tier: what it
lacks is encoded by the library, once per word, and remembered by the worker.

The frequent words are those of all texts: tasks count their own, and one row
per distinct word of a task is summed. The table decides how fast a count is
found, never what it is.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portolan.llm import words

FREQUENT = 100_000
# Distinct words that a task counts, or bytes of text since it last looked, before it hands on its counts.
COUNTED_WORDS, COUNTED_BYTES = 300_000, 32 << 20
_BITS = 18
_REMEMBERED = 1_000_000


def _counter(path: str):
    """Number of tokens of each text, as the library counts them."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Table:
    """Open addressing with linear probing over ``1 << _BITS`` places."""

    def __init__(self, hashes: np.ndarray, lengths: np.ndarray):
        size = 1 << _BITS
        self.keys, self.values = np.zeros(size, np.uint64), np.zeros(size, np.uint8)
        self.probes = 1
        for h, n in zip(hashes.tolist(), lengths.tolist(), strict=True):
            at, probe = h >> (64 - _BITS), 1
            while self.values[at]:
                at, probe = (at + 1) % size, probe + 1
            self.keys[at], self.values[at] = h, n
            self.probes = max(self.probes, probe)

    def lengths(self, hashes: np.ndarray) -> np.ndarray:
        """Length of each word; 0 where the table lacks it."""
        at = (hashes >> np.uint64(64 - _BITS)).astype(np.int64)
        out = np.where(self.keys[at] == hashes, self.values[at], 0).astype(np.int64)
        open_ = np.flatnonzero((self.keys[at] != hashes) & (self.values[at] > 0))
        for _ in range(1, self.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & ((1 << _BITS) - 1)
            here = at[open_]
            same = self.keys[here] == hashes[open_]
            out[open_[same]] = self.values[here[same]]
            open_ = open_[~same & (self.values[here] > 0)]
        return out


class Counts:
    """Both tiers of one worker."""

    def __init__(self, path: str, table: Table):
        self.count, self.table = _counter(path), table
        self.hashes, self.lengths = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def _second(self, block: words.Block, hashes: np.ndarray, missing: np.ndarray) -> np.ndarray:
        own, first, back = np.unique(hashes[missing], return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, own)
        at[at == len(self.hashes)] = 0
        known = self.hashes[at] == own if len(self.hashes) else np.zeros(len(own), bool)
        found = np.zeros(len(own), np.int64)
        found[known] = self.lengths[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            where = missing[first[new]]
            texts = [block.data[s:e].tobytes().decode() for s, e in zip(block.starts[where], block.ends[where], strict=True)]
            found[new] = self.count(texts)
            if len(self.hashes) + len(new) <= _REMEMBERED:
                both = np.concatenate((self.hashes, own[new]))
                order = np.argsort(both, kind="stable")
                self.hashes, self.lengths = both[order], np.concatenate((self.lengths, found[new]))[order]
        return found[back]

    def per_text(self, column: pa.Array) -> np.ndarray:
        out = [np.zeros(0, np.int64)]
        for block in words.blocks(column, limit=8 << 20):
            hashes = block.hashes()
            lengths = self.table.lengths(hashes)
            missing = np.flatnonzero(lengths == 0)
            if len(missing):
                lengths[missing] = self._second(block, hashes, missing)
            total = np.concatenate(([0], np.cumsum(lengths)))[block.offsets]
            out.append(np.diff(total))
        return np.concatenate(out)


@lru_cache(maxsize=1)
def _worker(path: str, key: str, broadcast) -> Counts:
    return Counts(path, broadcast.value)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each word occurs in a task's texts; a word comes again once its count was handed on."""
    seen: Counter[bytes] = Counter()
    held = 0
    for batch in batches:
        for text in batch.column("text").cast(pa.large_binary()).to_pylist():
            seen.update((text or b"").split())
            held += len(text or b"")
            full = len(seen) > COUNTED_WORDS
            if held > COUNTED_BYTES:
                held = sum(map(len, seen))
                full |= 2 * held > COUNTED_BYTES
            if full:
                yield _counted(seen)
                seen, held = Counter(), 0
    yield _counted(seen)


def _counted(seen: Counter[bytes]) -> pa.RecordBatch:
    word = pa.array(list(seen), pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([word, pa.array(list(seen.values()), pa.int64())], ["word", "n"])


def _most_frequent(counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` words of the highest counts, of equal ones the smallest words.

    A word is passed by before ordering if ``k`` others have counts of more
    bits, so that not every partition hands on ``k`` words of its own.
    """
    bits = F.length(F.bin("n"))
    levels = counts.groupBy(bits.alias("bits")).agg(F.count(F.lit(1)).alias("words"))
    longer = F.sum("words").over(Window.orderBy(F.desc("bits")).rowsBetween(Window.unboundedPreceding, -1))
    least = levels.select("bits", F.coalesce(longer, F.lit(0)).alias("longer")).where(F.col("longer") < k).agg(F.min("bits"))
    return counts.where(bits >= least.scalar()).orderBy(F.desc("n"), "word").limit(k)


def count_tokens(docs: DataFrame, path: str, *, text: str = "text", name: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of each whole text, without added special tokens; a null text has none.

    Words are cut at ASCII white space. The vocabulary's pre-tokenizer has to drop
    white space, else (a .model file, byte-level BPE) whole texts are encoded.
    """
    column = F.col(text).cast("string")
    if not _drops_white_space(path):

        @F.arrow_udf("long")
        def whole(texts: pa.Array) -> pa.Array:
            return pa.array(_whole(path)([x or "" for x in texts.to_pylist()]), pa.int64())

        return docs.withColumn(name, whole(column))
    spark = docs.sparkSession
    counts = docs.select(column.alias("text")).mapInArrow(_word_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # At most FREQUENT words reach the driver.
    top = [r.word for r in _most_frequent(counts, FREQUENT).collect()]
    lengths = np.array(_counter(path)(top), np.int64)
    hashes = np.concatenate([b.hashes() for b in words.blocks(pa.array(top, pa.string()))] or [np.zeros(0, np.uint64)])
    fits = (lengths > 0) & (lengths < 256)
    shared = spark.sparkContext.broadcast(Table(hashes[fits], lengths[fits]))
    key = f"{path} {shared.id if hasattr(shared, 'id') else id(shared)}"

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        return pa.array(_worker(path, key, shared).per_text(texts), pa.int64())

    return docs.withColumn(name, count(column))


@lru_cache(maxsize=2)
def _whole(path: str):
    return _counter(path)


def _drops_white_space(path: str) -> bool:
    if path.endswith(".model"):
        return False
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    return t.encode(" a \n b\t", add_special_tokens=False).ids == t.encode("a b", add_special_tokens=False).ids and not any(
        x.lstrip or x.rstrip or x.single_word for x in t.get_added_tokens_decoder().values()
    )

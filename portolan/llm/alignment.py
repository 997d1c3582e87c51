"""Alignment of two tokenizers' ids over the same bytes.

The running byte ends of each tokenization are kept in a dictionary from end to
index. Ends that both dictionaries hold, sorted, cut both id lists into groups
that cover the same bytes; the tokens of a group that end with it are linked.

Neither tokenizer joins a blank to what stands before it. So a text falls into
stretches that begin at a blank and are tokenized, and aligned, by themselves;
frequent ones are remembered by each worker.
"""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.functions import column
from portolan.sinks import Staging

# Stretches of up to so many bytes are remembered, until the text of all takes so many.
SHORT, REMEMBERED_BYTES = 64, 8 << 20
# Characters of stretches that are tokenized as one text.
TOGETHER = 1 << 14
# Texts that are worked on at once take about so many bytes.
BLOCK_BYTES = 2 << 20
# A blank that follows neither white space nor a lower one-eighth block, which stands for a blank within pieces.
_CUT = re.compile(r"(?<=[^\s▁])(?= )")
_IRREGULAR = re.compile(r"[\s▁] ")


@lru_cache(maxsize=1)
def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


# Ids come again and again: their digits are made once.
_decimal = lru_cache(maxsize=1 << 17)(str)


@dataclass(frozen=True)
class Alignment:
    """Groups of ids of two tokenizations.

    Group i ends at byte ``ends[i]``, before ``a[cuts_a[i]]`` and ``b[cuts_b[i]]``;
    its links, pairs of ids, end before ``links[link_cuts[i]]``.
    """

    a: list[int]
    b: list[int]
    ends: list[int]
    cuts_a: list[int]
    cuts_b: list[int]
    links: list[tuple[int, int]]
    link_cuts: list[int]

    def texts(self) -> list[str]:
        """Each group as ``a1,a2|b1``."""
        a, b = ([_decimal(i) for i in ids] for ids in (self.a, self.b))
        spans = zip([0, *self.cuts_a], self.cuts_a, [0, *self.cuts_b], self.cuts_b)
        return [f"{','.join(a[i:j])}|{','.join(b[k:m])}" for i, j, k, m in spans]

    def text(self) -> str:
        """The groups as ``a1,a2|b1;a3|b2,b3``."""
        return ";".join(self.texts())


def align_ids(a: list[int], b: list[int], bytes_a: list[bytes], bytes_b: list[bytes]) -> Alignment:
    """Groups and links of two tokenizations whose bytes are the same.

    A token without bytes ends where the one before it does and is linked like it.
    """
    ends_a = list(itertools.accumulate([len(bytes_a[i]) for i in a]))
    ends_b = list(itertools.accumulate([len(bytes_b[i]) for i in b]))
    at_a, at_b = dict(zip(ends_a, itertools.count(1))), dict(zip(ends_b, itertools.count(1)))
    common = sorted(at_a.keys() & at_b.keys())
    cuts_a, cuts_b = [at_a[e] for e in common], [at_b[e] for e in common]
    links = [(a[i - 1], b[j - 1]) for i, j in zip(cuts_a, cuts_b)]
    link_cuts = list(range(1, len(links) + 1))
    if len(at_a) < len(a) or len(at_b) < len(b):  # several tokens of a group end with it
        links, link_cuts, i, j = [], [], 0, 0
        for end, m, n in zip(common, cuts_a, cuts_b):
            last_a = [x for x, e in zip(a[i:m], ends_a[i:m]) if e == end]
            last_b = [x for x, e in zip(b[j:n], ends_b[j:n]) if e == end]
            links += itertools.product(last_a, last_b)
            link_cuts.append(len(links))
            i, j = m, n
    return Alignment(a, b, common, cuts_a, cuts_b, links, link_cuts)


class Aligner:
    """Two tokenizers: a byte-level one of the tokenizers library and a sentencepiece model.

    Special strings in a text are plain text. ``a`` is given a blank and the
    text, ``b`` the text, to which it adds the blank itself.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = _byte_letters()
        # An entry that is no byte-level text (an added token) stands for its own characters.
        self.bytes_a = [
            bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode()
            for t in (self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size()))
        ]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        # Only then a blank is never joined to what stands before it, and stretches are independent.
        joined = [x for x in self.bytes_a if re.search(r"\S ", x.decode(errors="ignore"))]
        self.apart = not joined and not any(re.search("[^▁]▁", p) for p in pieces)
        self.known: dict[str, tuple] = {}
        self.known_bytes = 0

    def align(self, text: str | None) -> Alignment | None:
        """The alignment of a whole text; None if it is null or empty or a tokenizer changes its bytes."""
        if not text:
            return None
        return self._align(" " + text, self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text, num_threads=1))

    def _align(self, text: str, a: list[int], b: list[int]) -> Alignment | None:
        whole, get_a, get_b = text.encode(), self.bytes_a.__getitem__, self.bytes_b.__getitem__
        if b"".join(map(get_a, a)) != whole or b"".join(map(get_b, b)) != whole:
            return None
        return align_ids(a, b, self.bytes_a, self.bytes_b)

    def stretches(self, text: str) -> list[str]:
        """The text cut before blanks, each stretch without its first blank."""
        if not self.apart:
            return [text]
        irregular = "  " in text or text[0] == " " or _IRREGULAR.search(text)
        parts = [s[1:] for s in _CUT.split(" " + text)] if irregular else text.split(" ")
        if not parts[-1] and len(parts) > 1:  # a blank at the end is no text of its own
            parts[-2:] = [parts[-2] + " "]
        return parts

    def _learn(self, new: list[str]) -> dict[str, tuple | None]:
        """Per stretch: number of ids, of ids, of groups, the groups' text, the links' codes; None if its bytes change.

        Stretches that end in no white space are independent of what follows, so many are aligned as one text.
        """
        lists: list[list[str]] = []
        size = 0
        for s in new:
            if not self.apart or not s or s[-1].isspace() or s[-1] == "▁":
                lists.insert(0, [s])
                continue
            if not size:
                lists.append([])
            lists[-1].append(s)
            size = (size + len(s)) if size + len(s) < TOGETHER else 0
        texts = [" ".join(x) for x in lists]
        a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        out: dict[str, tuple | None] = {}
        for part, text, x, y in zip(lists, texts, a, self.b.encode(texts, num_threads=1), strict=True):
            got = self._align(" " + text, x, y)
            if got is None and len(part) > 1:  # one of them is to blame
                out |= self._learn(part[: len(part) // 2]) | self._learn(part[len(part) // 2 :])
            elif got is None:
                out[part[0]] = None
            else:
                out |= self._cut(part, got)
        return out

    def _cut(self, part: list[str], got: Alignment) -> dict[str, tuple]:
        """The alignment of a text as those of its stretches."""
        groups, out = got.texts(), {}
        codes = (np.array(got.links, np.int64).reshape(-1, 2) @ [len(self.bytes_b), 1]).astype("<u4").tobytes()
        at = {end: i + 1 for i, end in enumerate(got.ends)}
        end = before = 0
        cuts_a, cuts_b, link_cuts = [0, *got.cuts_a], [0, *got.cuts_b], [0, *got.link_cuts]
        for s in part:
            end += 1 + len(s.encode())
            i = at[end]
            found = codes[4 * link_cuts[before] : 4 * link_cuts[i]]
            out[s] = (cuts_a[i] - cuts_a[before], cuts_b[i] - cuts_b[before], i - before, ";".join(groups[before:i]), found)
            before = i
        return out

    def run(self, texts: list[str | None]) -> list[tuple[int, int, int, str, bytes]]:
        """Per text what :meth:`_learn` gives for a stretch; nothing for a text without tokens."""
        cut = [self.stretches(t) if t else [] for t in texts]
        known = self.known
        new = list({s for part in cut for s in part if s not in known})
        known.update(self._learn(new))
        out = []
        for part in cut:
            got = [known[s] for s in part]
            if not got or None in got:
                out.append((0, 0, 0, "", b""))
                continue
            a, b, groups, text, codes = zip(*got)
            out.append((sum(a), sum(b), sum(groups), ";".join(text), b"".join(codes)))
        for s in new:
            if len(s) <= SHORT and self.known_bytes < REMEMBERED_BYTES:
                self.known_bytes += len(s) + 40
            else:
                del known[s]
        return out


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


_ADDED = [("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups", pa.large_string()), ("links", pa.large_binary())]


def _blocks(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Slices of batches whose texts take about ``BLOCK_BYTES``."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False) + 1
        block = np.cumsum(sizes, dtype=np.int64) // BLOCK_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(batch)]
        for i, j in zip(cuts, cuts[1:]):
            if j > i:
                yield batch.slice(i, j - i)


def _align(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches, "text"):
            found = aligner(path_a, path_b).run(batch.column("text").to_pylist())
            added = [pa.array([f[i] for f in found], kind) for i, (_, kind) in enumerate(_ADDED)]
            yield pa.RecordBatch.from_arrays([batch.column("record"), *added], ["record", *(n for n, _ in _ADDED)])

    return run


def align(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """Align both tokenizations of every whole text.

    Gives ``record`` (a struct of all columns but the text, so that no name can
    clash), ``n_a``, ``n_b``, ``n_groups``, ``groups`` (``a1,a2|b1;a3|b2,b3``:
    the ids of A and B in order) and ``links``: a little-endian unsigned 32-bit
    code ``a * size of B + b`` per linked pair of occurrences.

    Null and empty texts, and those whose bytes a tokenizer changes, have
    zeros and empty values. Equal rows are rows of their own, in any order. A
    very long text is held in memory as one, with its alignment. An empty
    table gives an empty one.
    """
    rest = [column(c) for c in docs.columns if c != text]
    sent = docs.select(F.struct(*rest).alias("record") if rest else F.struct(F.lit(None).cast("int").alias("none")).alias("record"), column(text).cast("string").alias("text"))
    record = sent.schema["record"].dataType.simpleString()
    return sent.mapInArrow(_align(path_a, path_b), f"record {record}, n_a long, n_b long, n_groups long, groups string, links binary")


def _codes(column_: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All links of a batch, and the number of each row's links."""
    rows = [x or b"" for x in column_.to_pylist()]
    return np.frombuffer(b"".join(rows), "<u4").astype(np.int64), np.array([len(x) // 4 for x in rows], np.int64)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(inverse, np.concatenate([p[1] for p in parts]), len(codes)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per pair of a task; merged so often that a task holds little more than its distinct pairs."""
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        for at in range(0, len(batch), 500):
            codes, _ = _codes(batch.column(0).slice(at, 500))
            parts.append(np.unique(codes, return_counts=True))
            if len(parts) == 32:
                parts = [_merged(parts)]
    if parts:
        codes, n = _merged(parts)
        yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(n, pa.int64())], ["pair", "n"])


def pair_bound(path_a: str, path_b: str) -> int:
    """Most pairs that can be linked, whatever the texts.

    Of two tokens that end together one is a suffix of the other, so a token's
    partners are its own suffixes, or have it as theirs: each pair is counted
    at the suffixes of its longer token. Equal byte strings occur at most twice
    in a vocabulary (as a piece and as a byte).
    """
    both = aligner(path_a, path_b)
    return 2 * sum(map(len, both.bytes_a)) + 2 * sum(map(len, both.bytes_b))


def count_pairs(aligned: DataFrame, path_b: str) -> DataFrame:
    """(pair, a_id, b_id, n, best): how often each pair is linked in all texts, and whether its B id has none more often.

    Pairs are counted within each task before they are sent.
    """
    import sentencepiece

    size = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    counted = aligned.select("links").mapInArrow(_count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counted = counted.select("pair", F.floor(F.col("pair") / size).alias("a_id"), (F.col("pair") % size).alias("b_id"), "n")
    highest = counted.groupBy("b_id").agg(F.max("n").alias("highest"))
    return counted.join(highest, "b_id").select("pair", "a_id", "b_id", "n", (F.col("n") == F.col("highest")).alias("best"))


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = shared.value
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                codes, sizes = _codes(part.column("links"))
                spot = np.searchsorted(pairs, codes)
                ends = np.cumsum(sizes)
                totals = []
                for values in (counts, best):
                    running = np.concatenate(([0], np.cumsum(values[spot]))) if len(pairs) else np.zeros(1, np.int64)
                    totals.append(running[ends] - running[ends - sizes])
                arrays = [part.column(i) for i, name in enumerate(part.schema.names) if name != "links"]
                names = [n for n in part.schema.names if n != "links"]
                added = [pa.array(sizes), pa.array(totals[1]), pa.array(totals[0])]
                yield pa.RecordBatch.from_arrays([*arrays, *added], [*names, "n_links", "n_best", "count_sum"])

    return run


def score_links(aligned: DataFrame, pairs: DataFrame, bound: int) -> DataFrame:
    """``aligned`` with ``n_links``, ``n_best`` and ``count_sum`` in place of its ``links``.

    ``n_best`` counts the links whose pair is its B id's most frequent one,
    ties included; ``count_sum`` adds the counts of the links' pairs. ``pairs``,
    of which there are at most ``bound`` however large the corpus is, goes
    through the driver to every worker.
    """
    spark = aligned.sparkSession
    table = pairs.select("pair", "n", "best").toArrow().sort_by("pair")
    if len(table) > bound:
        raise ValueError(f"{len(table)} pairs, but the vocabularies allow {bound}")
    columns = [table.column(c).to_numpy().astype(np.int64) for c in ("pair", "n", "best")]
    shared = spark.sparkContext.broadcast(tuple(columns))
    rest = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in aligned.schema if f.name != "links")
    return aligned.mapInArrow(_score(shared), f"{rest}, n_links long, n_best long, count_sum long")


def link_statistics(docs: DataFrame, path_a: str, path_b: str, text: str = "text", staging: Staging | None = None) -> DataFrame:
    """Per document: record, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    The texts are tokenized once; counts of pairs and results come from the
    stored links. ``groups_sha256`` is '' for a text without tokens.
    """
    staging = staging or Staging(docs.sparkSession)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    aligned = align(docs, path_a, path_b, text).select("record", "n_a", "n_b", "n_groups", digest, "links")
    aligned = staging.write(aligned, "links")
    return score_links(aligned, staging.write(count_pairs(aligned, path_b), "pairs"), pair_bound(path_a, path_b))

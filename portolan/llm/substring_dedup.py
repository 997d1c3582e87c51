"""Removal of repeated word sequences by level-wise doubling.

Every run of ``base`` words is counted. Runs found once are dropped; those that
are repeated are joined with the repeated run that follows them to runs of
twice the length, and so on, until the length asked for is reached or no
candidate survives. Only the shortest level looks at every word; the later ones
are made from candidates alone, without the texts.

Texts are worked on in units of two megabytes. A unit sends every distinct run
once, as a few bytes, to the bucket of its hash, so a run that a third of the
corpus repeats reaches its bucket once per unit. Both buckets and units have a
fixed size; their number grows with the corpus. A task holds some twenty times
its unit in arrays while it finds the runs, so units stay small: each core's
Python worker shares an executor's memory with the JVM.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm import words
from portolan.llm.tables import ROW, numbered, pieces, stored, text_bytes
from portolan.sinks import Staging

UNIT_BYTES = 2 << 20
BUCKET_RUNS = 1 << 20
SHORTEST = 10
# Kinds of messages: runs to be counted, runs known to be repeated, the texts of a unit.
COUNT, KNOWN, TEXTS = 0, 1, 2
_MESSAGE = pa.schema([("bucket", pa.int64()), ("kind", pa.int32()), ("unit", pa.int64()), ("data", pa.binary())])
_MESSAGE_DDL = "bucket long, kind int, unit long, data binary"


def levels(length: int, shortest: int = SHORTEST) -> list[int]:
    """The lengths looked at: ``length`` halved while that gives whole numbers of ``shortest`` or more."""
    out = [length]
    while out[0] % 2 == 0 and out[0] // 2 >= shortest:
        out.insert(0, out[0] // 2)
    return out


def pack(at: np.ndarray, hashes: np.ndarray | None = None, width: int = 0) -> bytes:
    """Ascending positions as differences, and the low ``width`` bytes of each hash, byte by byte of equal rank."""
    steps = np.diff(at, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    if not width:
        return steps
    return steps + np.ascontiguousarray(hashes, "<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpack(data: bytes, width: int = 0) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(data, np.uint8).reshape(4 + width, -1)
    steps = np.ascontiguousarray(raw[:4].T).view("<u4").ravel()
    hashes = np.zeros((raw.shape[1], 8), np.uint8)
    hashes[:, :width] = raw[4:].T
    return np.cumsum(steps, dtype=np.int64), hashes.view("<u8").ravel()


def _pack_texts(offsets: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> bytes:
    return np.concatenate((ids, rows, offsets)).astype("<i8").tobytes()


def _unpack_texts(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    flat = np.frombuffer(data, "<i8")
    n = len(flat) // 3
    return flat[2 * n :], flat[:n], flat[n : 2 * n]


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def numbered_hash(hashes: np.ndarray, bucket: np.ndarray | int, width: int) -> np.ndarray:
    if width == 8:
        return hashes
    low = hashes & np.uint64((1 << (8 * width)) - 1)
    return low | (np.asarray(bucket, np.uint64) << np.uint64(8 * width))


class _Sender:
    """Splits the runs of one unit into messages."""

    def __init__(self, buckets: int, width: int, last: bool):
        self.buckets, self.width, self.last = buckets, width, last

    def shown(self, hashes: np.ndarray) -> np.ndarray:
        """What a bucket knows of a hash: its sent bytes and the bucket's own number."""
        return numbered_hash(hashes, _bucket(hashes, self.buckets), self.width)

    def send(self, unit: int, at: np.ndarray, hashes: np.ndarray, texts: bytes) -> pa.RecordBatch:
        offsets, ids, rows = _unpack_texts(texts)
        text = np.searchsorted(offsets, at, "right") - 1
        if self.last:  # the run that stays is the earliest by id, row and place
            rank = np.empty(len(ids), np.int64)
            rank[np.lexsort((rows, ids))] = np.arange(len(ids))
            order = np.lexsort((at, rank[text], hashes))
        else:
            order = np.argsort(hashes, kind="stable")
        h = hashes[order]
        first = np.ones(len(h), bool)
        first[1:] = h[1:] != h[:-1]
        known = ~first
        if not self.last:  # all of a run's places within the unit are candidates then
            known[:-1] |= known[1:]
        known = np.sort(order[known])
        sent = np.sort(order[first])
        out = [(unit % self.buckets, TEXTS, texts)]
        if len(known):
            data = pack(at[known]) if self.last else pack(at[known], self.shown(hashes[known]), 8)
            out.append((unit % self.buckets, KNOWN, data))
        bucket = _bucket(hashes[sent], self.buckets)
        by = np.argsort(bucket, kind="stable")
        for part in np.split(by, np.flatnonzero(np.diff(bucket[by])) + 1):
            if len(part):
                own = sent[part]
                data = pack(at[own], hashes[own], self.width)
                if self.last:
                    head, count = np.unique(text[own], return_counts=True)
                    data = np.concatenate((ids[head], rows[head], count)).astype("<i8").tobytes() + data
                    data = np.array([len(head)], "<i8").tobytes() + data
                out.append((int(bucket[part[0]]), COUNT, data))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([x[0] for x in out], pa.int64()),
                pa.array([x[1] for x in out], pa.int32()),
                pa.array([unit] * len(out), pa.int64()),
                pa.array([x[2] for x in out], pa.binary()),
            ],
            schema=_MESSAGE,
        )


def _shortest_runs(length: int, sender: _Sender):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(ROW).to_numpy()
            ids = batch.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy()
            for block in words.blocks(batch.column("text"), limit=UNIT_BYTES):
                offsets = block.offsets
                runs = words.runs(block.hashes(), length)
                at = np.flatnonzero(words.whole(offsets, length, len(runs)))
                if len(at):
                    use = slice(block.first, block.first + len(block.counts))
                    texts = _pack_texts(offsets[:-1], ids[use], rows[use])
                    # The end of the last text is not needed: no run kept here crosses it.
                    yield sender.send(int(rows[block.first]), at, runs[at], texts)

    return run


def _count(width: int):
    """Of the runs sent to a bucket, those that more than one unit sent."""

    def run(table: pa.Table) -> pa.Table:
        kinds, units = table.column("kind").to_numpy(), table.column("unit").to_numpy()
        data = table.column("data").to_pylist()
        out = [(int(units[i]), int(kinds[i]), data[i]) for i in np.flatnonzero(kinds != COUNT)]
        sent = np.flatnonzero(kinds == COUNT)
        if len(sent):
            parts = [unpack(data[i], width) for i in sent]
            hashes = np.concatenate([h for _, h in parts])
            order = np.argsort(hashes, kind="stable")
            same = hashes[order][1:] == hashes[order][:-1]
            again = np.zeros(len(hashes), bool)
            again[order[1:][same]] = True
            again[order[:-1][same]] = True
            done = 0
            for i, (at, h) in zip(sent, parts, strict=True):
                mine = again[done : done + len(at)]
                done += len(at)
                if mine.any():
                    shown = numbered_hash(h[mine], table.column("bucket")[0].as_py(), width)
                    out.append((int(units[i]), KNOWN, pack(at[mine], shown, 8)))
        return _replies(out)

    return run


def _replies(out: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.table(
        {
            "kind": pa.array([x[1] for x in out], pa.int32()),
            "unit": pa.array([x[0] for x in out], pa.int64()),
            "data": pa.array([x[2] for x in out], pa.binary()),
        }
    )


def _twice(half: int, sender: _Sender):
    """Join the candidates of a unit to runs of twice the length."""
    factor = np.uint64(pow(int(words.BASE), 2 * half, 1 << 64))

    def run(table: pa.Table) -> pa.Table:
        unit, texts, parts = table.column("unit")[0].as_py(), None, []
        for kind, data in zip(table.column("kind").to_pylist(), table.column("data").to_pylist(), strict=True):
            if kind == TEXTS:
                texts = data
            else:
                parts.append(unpack(data, 8))
        if not parts:
            return pa.Table.from_batches([], schema=_MESSAGE)
        at, first = np.unique(np.concatenate([x for x, _ in parts]), return_index=True)
        hashes = np.concatenate([h for _, h in parts])[first]
        after = np.searchsorted(at, at + half)
        after[after == len(at)] = 0
        offsets = _unpack_texts(texts)[0]
        text = np.searchsorted(offsets, at, "right") - 1
        both = (at[after] == at + half) & (text[after] == text)
        if not both.any():
            return pa.Table.from_batches([], schema=_MESSAGE)
        longer = words.mix(words.mix(hashes[both]) * factor + hashes[after[both]])
        return pa.Table.from_batches([sender.send(unit, at[both], longer, texts)])

    return run


def _later(table: pa.Table) -> pa.Table:
    """Of the runs sent to a bucket, those whose like starts earlier in another unit."""
    kinds, units = table.column("kind").to_numpy(), table.column("unit").to_numpy()
    data = table.column("data").to_pylist()
    out = [(int(units[i]), int(kinds[i]), data[i]) for i in np.flatnonzero(kinds != COUNT)]
    sent = np.flatnonzero(kinds == COUNT)
    if len(sent):
        ats, hashes, ids, rows = [], [], [], []
        for i in sent:
            n = int(np.frombuffer(data[i], "<i8", 1)[0])
            head = np.frombuffer(data[i], "<i8", 3 * n, 8)
            at, h = unpack(data[i][8 + 24 * n :], 8)
            count = head[2 * n :]
            ats.append(at)
            hashes.append(h)
            ids.append(np.repeat(head[:n], count))
            rows.append(np.repeat(head[n : 2 * n], count))
        h = np.concatenate(hashes)
        order = np.lexsort((np.concatenate(rows), np.concatenate(ids), h))
        later = np.zeros(len(h), bool)
        later[order[1:][h[order][1:] == h[order][:-1]]] = True
        done = 0
        for i, at in zip(sent, ats, strict=True):
            mine = later[done : done + len(at)]
            done += len(at)
            if mine.any():
                out.append((int(units[i]), KNOWN, pack(at[mine])))
    return _replies(out)


def _spans(length: int):
    """Per text of a unit, the words that removed runs cover, as starts and ends."""

    def run(table: pa.Table) -> pa.Table:
        texts, parts = None, []
        for kind, data in zip(table.column("kind").to_pylist(), table.column("data").to_pylist(), strict=True):
            if kind == TEXTS:
                texts = data
            else:
                parts.append(unpack(data)[0])
        out_rows, out_spans = [], []
        if parts:
            at = np.unique(np.concatenate(parts))
            offsets, _, rows = _unpack_texts(texts)
            text = np.searchsorted(offsets, at, "right") - 1
            # A gap: the next run begins beyond this one's end, or in another text.
            gap = (at[1:] > at[:-1] + length) | (text[1:] != text[:-1])
            begin = at[np.concatenate(([True], gap))]
            end = at[np.concatenate((gap, [True]))] + length
            text = text[np.concatenate(([True], gap))]
            for part in np.split(np.arange(len(begin)), np.flatnonzero(np.diff(text)) + 1):
                base = offsets[text[part[0]]]
                out_rows.append(int(rows[text[part[0]]]))
                out_spans.append(np.stack((begin[part] - base, end[part] - base), 1).astype("<i8").tobytes())
        return pa.table({ROW: pa.array(out_rows, pa.int64()), "spans": pa.array(out_spans, pa.binary())})

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        text = [x.as_buffer() if x.is_valid else None for x in batch.column("text").cast(pa.large_binary())]
        data = pa.array([None if x is None else press.compress(x) for x in text], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(ROW), batch.column("record"), data], [ROW, "record", "packed"])


def _kept(as_is: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.slice(at, 1000)
                total, removed, kept = [], [], []
                for data, spans in zip(part.column("packed").to_pylist(), part.column("spans").to_pylist(), strict=True):
                    text = None if data is None else unpress.decompress(data)
                    own = text.split() if text is not None else []
                    total.append(len(own))
                    if spans is not None:
                        cover = np.ones(len(own), bool)
                        for a, b in np.frombuffer(spans, "<i8").reshape(-1, 2):
                            cover[a:b] = False
                        own = [own[i] for i in np.flatnonzero(cover)]
                    removed.append(total[-1] - len(own))
                    kept.append(text if as_is and not removed[-1] else b" ".join(own))
                kept = pa.array(kept, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column("record"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), kept],
                    ["record", "n_words", "n_removed", "kept"],
                )

    return run


def remove_repeats(
    docs: DataFrame,
    *,
    min_words: int = 20,
    staging: Staging,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: Sequence[str] = (),
    as_is: bool = False,
) -> DataFrame:
    """Remove every word covered by a window of ``min_words`` words whose like starts earlier.

    Earlier means in a text of smaller ``doc_id`` (null counts as smallest, equal
    ids go by their rows), or in the same text before it. Windows are judged on
    the input. Gives one row per row of ``docs``: ``record`` (a struct of
    ``doc_id`` and the columns named in ``carry``, under their own names),
    n_words, n_removed, kept. ``kept`` joins the words that stay by one space. A
    null or wordless text has no words and gives the empty text. With ``as_is`` a
    text that loses nothing is given unchanged, white space, null and all.
    """
    record = F.struct(F.col(doc_id), *[F.col(c) for c in carry if c != doc_id]).alias("record")
    docs = docs.select(record, F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    docs = stored(docs, staging)
    rows = numbered(docs)
    size = text_bytes(docs, "text") / 6  # about so many words
    buckets = pieces(size, BUCKET_RUNS)
    # Hashes wide enough that chance repeats are rare: 18 bits more than the number of runs has.
    width = min(8, max(3, math.ceil((math.log2(size + 2) + 18 - math.log2(buckets)) / 8)))
    lengths = levels(min_words)
    last = len(lengths) == 1
    sender = _Sender(buckets, 8 if last else width, last)
    sent = rows.select(ROW, "doc_id", "text").mapInArrow(_shortest_runs(lengths[0], sender), _MESSAGE_DDL)
    for half in lengths[:-1]:
        known = sent.groupBy("bucket").applyInArrow(_count(width), "kind int, unit long, data binary")
        last = 2 * half == min_words
        sender = _Sender(buckets, 8 if last else width, last)
        sent = known.groupBy("unit").applyInArrow(_twice(half, sender), _MESSAGE_DDL)
    later = sent.groupBy("bucket").applyInArrow(_later, "kind int, unit long, data binary")
    spans = later.groupBy("unit").applyInArrow(_spans(min_words), f"{ROW} long, spans binary")
    shape = docs.schema["record"].dataType.simpleString()
    packed = rows.select(ROW, "record", "text").mapInArrow(_packed, f"{ROW} long, record {shape}, packed binary")
    return packed.join(spans, ROW, "left").select("record", "packed", "spans").mapInArrow(
        _kept(as_is), f"record {shape}, n_words long, n_removed long, kept string"
    )

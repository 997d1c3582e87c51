"""Words of whole Arrow columns as 64-bit hashes, without a Python loop over words.

A word is a run of bytes other than space and 0x09-0x0D. Texts are worked on in
blocks of whole documents, so memory is bounded by the block (or by one text).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_LONG_WORD = 1 << 12
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_K1, _K2, _K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers, so that every bit depends on every bit."""
    x = (x ^ (x >> np.uint64(30))) * _K2
    x = (x ^ (x >> np.uint64(27))) * _K3
    return x ^ (x >> np.uint64(31))


@dataclass
class Block:
    """Consecutive texts ``first .. first + len(counts) - 1`` of one column."""

    first: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray
    bounds: np.ndarray  # where each text begins in ``data``; one more entry for the end

    @property
    def offsets(self) -> np.ndarray:
        """Index of each text's first word; one more entry for the end."""
        return np.concatenate(([0], np.cumsum(self.counts)))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        size = self.ends - self.starts
        padded = np.concatenate((self.data, np.zeros(8, np.uint8)))
        words = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
        h = size.astype(np.uint64) * _K1
        todo, at, left = None, self.starts, size
        while len(at):
            x = words[at]
            short = left < 8
            x[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
            if todo is None:
                h = mix(h ^ x)
                todo = np.flatnonzero(left > 8)
                for i in todo[left[todo] > _LONG_WORD]:
                    word = self.data[self.starts[i] : self.ends[i]].tobytes()
                    h[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
                todo = todo[left[todo] <= _LONG_WORD]
                at, left = at[todo] + 8, left[todo] - 8
            else:
                h[todo] = mix(h[todo] * _K1 ^ x)
                more = left > 8
                todo, at, left = todo[more], at[more] + 8, left[more] - 8
        return h

    def words(self, i: int) -> list[bytes]:
        """The words of the i-th text of the block."""
        a, b = self.offsets[i : i + 2]
        return [self.data[s:e].tobytes() for s, e in zip(self.starts[a:b], self.ends[a:b], strict=True)]


def blocks(column: pa.Array | pa.ChunkedArray, *, lower: bool = False, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a string column into blocks; a null text has no words."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    raw = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        bounds = offsets[first : last + 1] - offsets[first]
        data = raw[offsets[first] : offsets[last]]
        if lower:
            data = _LOWER[data]
        yield _block(first, data, bounds)
        first = last


def _block(first: int, data: np.ndarray, bounds: np.ndarray) -> Block:
    inside = ~_SPACE[data]
    begins, stops = inside.copy(), inside.copy()
    if len(data):
        cut = np.zeros(len(data) + 1, bool)
        cut[bounds] = True
        begins[1:] &= ~inside[:-1] | cut[1:-1]
        stops[:-1] &= ~inside[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return Block(first, data, starts, ends, np.diff(np.searchsorted(starts, bounds)), bounds)


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each position; the last ``length - 1`` positions fall away."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64)
    out, have = hashes, 1
    for bit in bin(length)[3:]:
        out = joined(out, out, have)
        have *= 2
        if bit == "1":
            out = joined(out, hashes, have)
            have += 1
    return out


def joined(left: np.ndarray, right: np.ndarray, length: int) -> np.ndarray:
    """Hash of the run ``left[i]`` of ``length`` words followed by the run ``right[i + length]``."""
    factor = np.uint64(pow(int(BASE), length, 1 << 64))
    n = len(right) - length
    return mix(left[:n] * factor + right[length : length + n])


def whole(offsets: np.ndarray, length: int, total: int) -> np.ndarray:
    """Marks the positions from which ``length`` words lie in one text; ``total`` positions in all."""
    ok = np.zeros(total + 1, np.int32)
    begin, stop = offsets[:-1], offsets[1:] - length + 1
    use = stop > begin
    np.add.at(ok, begin[use], 1)
    np.add.at(ok, stop[use], -1)
    return np.cumsum(ok[:total]) > 0

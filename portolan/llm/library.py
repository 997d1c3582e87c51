"""Ids of whole Arrow columns of text from the tokenizers library, remembered per worker in a compact table.

Texts are cut into units: runs of letters, single digits and runs of other
characters of a plain ASCII word, or a whole word that has further characters.
All units of a block are looked up at once; ids are kept as one flat array.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from portolan.llm import words

# What a worker remembers takes at most so many bytes.
REMEMBERED_BYTES = 32 << 20
_JOINED = 1000
# Kinds of bytes: white space, letters, digits, what a plain word may hold beside them, and all others.
_SPACE, _LETTER, _DIGIT, _SIGN, _OTHER = range(5)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[32, 9, 10, 11, 12, 13]] = _SPACE
# Apostrophes bind letters to a unit of their own, angle brackets enclose special strings.
_KIND[[b for b in range(33, 127) if chr(b) not in "'<"]] = _SIGN
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[48:58] = _DIGIT
_PIECE = re.compile(r"[a-z]+|[0-9]|[^a-z0-9]+")


class IdTable:
    """Ids of units, found by the units' 64-bit hashes.

    A second number tells units of one hash apart: the first eight bytes. With
    the hash, which holds the length, it is unique for units of up to eight bytes.
    """

    def __init__(self, kind: str):
        self.hashes, self.heads = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids = np.zeros(0, kind)

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for x in (self.hashes, self.heads, self.starts, self.sizes, self.ids))

    def find(self, hashes: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """Place of each unit; -1 where the table lacks it. ``hashes`` are in ascending order."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where((self.hashes[at] == hashes) & (self.heads[at] == heads), at, -1)

    def add(self, hashes: np.ndarray, heads: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Take up new units, whose ids lie one after the other; a hash that is known stays as it is."""
        starts = len(self.ids) + np.cumsum(sizes) - sizes
        both = np.concatenate((self.hashes, hashes))
        order = np.argsort(both, kind="stable")
        order = order[np.concatenate(([True], both[order][1:] != both[order][:-1]))] if len(order) else order
        self.hashes, self.heads = both[order], np.concatenate((self.heads, heads))[order]
        self.starts = np.concatenate((self.starts, starts))[order]
        self.sizes = np.concatenate((self.sizes, sizes.astype(np.int32)))[order]
        self.ids = np.concatenate((self.ids, ids))


def _heads(block: words.Block) -> np.ndarray:
    """The first eight bytes of each unit, as a number."""
    padded = np.concatenate((block.data, np.zeros(8, np.uint8)))
    heads = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))[block.starts]
    size = block.ends - block.starts
    short = size < 8
    heads[short] &= (np.uint64(1) << (size[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
    return heads


def units(block: words.Block) -> tuple[words.Block, np.ndarray]:
    """A block's words cut into units, plain ones in lower case, and marks of the plain ones."""
    data, kind = block.data, _KIND[block.data]
    others = np.concatenate(([0], np.cumsum(kind == _OTHER)))
    odd = others[block.ends] > others[block.starts]
    if odd.any():  # all bytes of such a word are of one kind
        inside = np.zeros(len(data) + 1, np.int8)
        inside[block.starts[odd]] += 1
        inside[block.ends[odd]] -= 1
        kind[np.cumsum(inside[:-1]) > 0] = _OTHER
    data = np.where(kind == _LETTER, data | 32, data).astype(np.uint8)
    begins = kind != _SPACE
    if len(data):
        begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    # Texts that follow each other without white space are different words.
    at = block.bounds[:-1]
    at = at[at < block.bounds[1:]]
    begins[at] = kind[at] != _SPACE
    starts = np.flatnonzero(begins)
    stops = np.concatenate((begins[1:] | (kind[1:] == _SPACE), [True])) & (kind != _SPACE) if len(data) else begins
    ends = np.flatnonzero(stops) + 1
    counts = np.diff(np.searchsorted(starts, block.bounds))
    return words.Block(block.first, data, starts, ends, counts, block.bounds), kind[starts] != _OTHER


class LibraryCoder:
    """Ids of texts as the library gives them, asked once per unit of a block, and once at all for those remembered.

    Only for vocabulary files whose pre-tokenizer drops white space, so that no
    token, special string or normalization reaches over it. If the vocabulary
    marks no word ends, or cuts plain words otherwise than into units, or has a special
    string without an angle bracket, whole words are the units.
    """

    def __init__(self, path: str, kind: str = "<u4"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.kind = kind
        self.known = IdTable(kind)
        self.ends = self._word_ends()

    def _word_ends(self) -> np.ndarray | None:
        """Marks the ids that end a unit; none if whole words have to be the units."""
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        if not suffix or not all("<" in x for x in added):
            return None
        ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        ends[[i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if t.endswith(suffix)]] = True
        proof = "Ab,1.2(cD)e=>f#%&*+-/:;?@[]^_`{|}~!"
        parts = _PIECE.findall(proof.lower())
        together = self._ids([proof])[0]
        return ends if together == [i for x in self._ids(parts) for i in x] and ends[together].sum() == len(parts) else None

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _ask(self, texts: list[str], plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each unit, and the ids; plain units come first and are asked for many at once."""
        n = int(plain.sum())
        sizes, ids = [np.zeros(0, np.int64)], [np.zeros(0, self.kind)]
        for at in range(0, n, _JOINED):
            part = texts[at : min(at + _JOINED, n)]
            got = np.array(self._ids([" ".join(part)])[0], np.int64)
            stops = np.flatnonzero(self.ends[got])
            if len(stops) != len(part):
                raise ValueError("the vocabulary cuts plain words otherwise than into units")
            sizes.append(np.diff(stops, prepend=-1))
            ids.append(got.astype(self.kind))
        for at in range(n, len(texts), _JOINED):
            got = self._ids(texts[at : at + _JOINED])
            sizes.append(np.array([len(x) for x in got], np.int64))
            ids.extend(np.array(x, self.kind) for x in got)
        return np.concatenate(sizes), np.concatenate(ids)

    def _learn(self, block: words.Block, plain: np.ndarray, hashes: np.ndarray, heads: np.ndarray, first: np.ndarray):
        """Places of the units at ``first``, in ascending order of their hashes, and the starts, sizes and ids of the places."""
        known = self.known
        at = known.find(hashes, heads)
        new = np.flatnonzero(at < 0)
        starts, sizes, ids = known.starts, known.sizes, known.ids
        if len(new):
            new = new[np.argsort(~plain[first[new]], kind="stable")]
            where, raw = first[new], block.data.tobytes()
            texts = [raw[s:e].decode() for s, e in zip(block.starts[where].tolist(), block.ends[where].tolist(), strict=True)]
            n, found = self._ask(texts, plain[where])
            at[new] = len(known.hashes) + np.arange(len(new))
            starts = np.concatenate((starts, len(ids) + np.cumsum(n) - n))
            sizes, ids = np.concatenate((sizes, n)), np.concatenate((ids, found))
            room = REMEMBERED_BYTES - known.nbytes
            take = int(np.searchsorted(np.cumsum(28 + n * found.itemsize), room, "right"))
            if take:
                known.add(hashes[new[:take]], heads[new[:take]], n[:take], found[: n[:take].sum()])
        return at, starts, sizes, ids

    def _block(self, block: words.Block) -> tuple[np.ndarray, np.ndarray]:
        plain = np.zeros(len(block.starts), bool)
        if self.ends is not None:
            block, plain = units(block)
        hashes, heads = block.hashes(), _heads(block)
        own, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        at, starts, sizes, ids = self._learn(block, plain, own, heads[first], first)
        at = at[back]
        n = sizes[at].astype(np.int64)
        ends = np.cumsum(n)
        flat = ids[np.repeat(starts[at] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]
        per_text = np.diff(np.concatenate(([0], ends))[block.offsets])
        twins = np.flatnonzero(heads != heads[first][back])
        if len(twins):  # units of one hash: their texts are asked for as a whole
            parts = np.split(flat, np.cumsum(per_text)[:-1])
            for i in np.unique(np.searchsorted(block.offsets, twins, "right") - 1):
                text = block.data[block.bounds[i] : block.bounds[i + 1]].tobytes().decode()
                parts[i] = np.array(self._ids([text])[0], self.kind)
                per_text[i] = len(parts[i])
            flat = np.concatenate(parts)
        return per_text, flat

    def run(self, column: pa.Array, limit: int = words.BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Blocks of texts of about ``limit`` bytes: index of the first, number of ids of each, all ids; a null text has none."""
        for block in words.blocks(column, limit=limit):
            yield block.first, *self._block(block)


@lru_cache(maxsize=2)
def library(path: str, kind: str) -> LibraryCoder:
    return LibraryCoder(path, kind)

"""BPE encoding and decoding with a contiguous rank array.

For a short word, the parts' boundaries and the ranks of adjacent parts lie in
two lists. The smallest rank is searched for by a scan, its boundary deleted,
and the ranks on both sides refreshed, until no rank is left. Long words keep
their ranks in a heap, where a scan per merge would take quadratic time.

``Codec`` does what the tokenizers library does for a vocabulary file of the
form it describes: special strings are cut out of the raw text, the rest is
composed (NFC), lower-cased character by character, cut by a pattern that drops
white space, mapped to printable characters byte by byte, and merged with a mark
at the end of each word. Decoding joins the tokens by blanks, as the library
does for a file without a decoder.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from functools import cached_property, lru_cache

import numpy as np
import regex
from tokenizers import Tokenizer

NEVER = 1 << 60
# Words of more parts than this use a heap.
SHORT = 64
# Distinct words whose ids a worker remembers.
REMEMBERED = 300_000

# White space as the pattern library of the tokenizers counts it.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_characters() -> list[str]:
    """A printable character for each byte: its own if it has one in Latin-1, else the next from U+0100."""
    own = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b if b in own else next(spare)) for b in range(256)]


class Codec:
    """Ids and decoded text of whole texts under one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, self.path = spec["model"], path
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        cut, as_bytes = spec["pre_tokenizer"]["pretokenizers"]
        if kinds != ["NFC", "Replace", "Lowercase"] or cut["behavior"] != "Removed" or as_bytes["type"] != "ByteLevel":
            raise ValueError(f"{path}: not a vocabulary of words with word ends")
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ids = self.vocab
        self.ranks = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        self.bytes = dict(enumerate(byte_characters()))
        # The pattern's own white space class differs from this library's by a few control characters.
        self.pattern = regex.compile(cut["pattern"]["Regex"].replace(r"[^\s", f"[^{WHITE}"))
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def word_ids(self, word: str) -> list[int]:
        """Ids of one pre-token, given as its bytes' printable characters."""
        parts = [self.vocab[c] for c in word[:-1]]
        parts.append(self.vocab[word[-1] + self.end])
        return self._merged(parts) if len(parts) <= SHORT else self._merged_long(parts)

    def _merged(self, parts: list[int]) -> list[int]:
        get, none = self.ranks.get, (NEVER, 0)
        near = [get(pair, none) for pair in zip(parts, parts[1:], strict=False)]
        while near:
            best = min(near)
            if best is none or best[0] == NEVER:
                break
            i = near.index(best)
            parts[i] = best[1]
            del parts[i + 1], near[i]
            if i < len(near):
                near[i] = get((best[1], parts[i + 1]), none)
            if i:
                near[i - 1] = get((parts[i - 1], best[1]), none)
        return parts

    def _merged_long(self, parts: list[int]) -> list[int]:
        n = len(parts)
        after, before, ranks = [*range(1, n), -1], [-1, *range(n - 1)], self.ranks
        heap = [(ranks[p][0], i, p) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i] if parts[i] >= 0 else -1
            if j < 0 or (parts[i], parts[j]) != pair:
                continue
            parts[i], parts[j] = ranks[pair][1], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (parts[a], parts[b]) in ranks:
                    heapq.heappush(heap, (ranks[parts[a], parts[b]][0], a, (parts[a], parts[b])))
        return [p for p in parts if p >= 0]

    def pre_tokens(self, text: str) -> list[str]:
        """The words that are merged each by itself, as their bytes' printable characters."""
        if text.isascii() and text.isprintable():
            return self.pattern.findall(text.lower())
        if any(unicodedata.category(c) == "Cn" for c in text):
            # Characters newer than Python's tables: only the library knows what it takes them for.
            text = self.library.normalizer.normalize_str(text)
            return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]
        text = "".join([c.lower() for c in unicodedata.normalize("NFC", text)])
        return [w.encode().decode("latin-1").translate(self.bytes) for w in self.pattern.findall(text)]

    def chunk_ids(self, chunk: str) -> list[int]:
        """Ids of a stretch of text without Python-level caching of the stretch itself."""
        out: list[int] = []
        for piece in self.cut.split(chunk) if "<" in chunk else (chunk,):
            if piece in self.special:
                out.append(self.special[piece])
            else:
                for word in self.pre_tokens(piece):
                    out.extend(self._remembered(word))
        return out

    @cached_property
    def _remembered(self):
        return lru_cache(REMEMBERED)(self.word_ids)

    @cached_property
    def library(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    def encode(self, text: str) -> list[int]:
        return self.chunk_ids(text)

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by blanks; special ones are kept, unknown ids left out."""
        return " ".join([self.tokens[i] for i in ids if i in self.tokens])

    def __getstate__(self):
        return self.path

    def __setstate__(self, path):
        self.__init__(path)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker and file."""
    return Codec(path)


class Memo(dict):
    """Remembers a function of byte strings for the first keys it meets, up to a number."""

    def __init__(self, make, limit: int = REMEMBERED):
        self.make, self.limit = make, limit

    def __missing__(self, key: bytes):
        value = self.make(key)
        if len(self) < self.limit:
            self[key] = value
        return value


class Coder:
    """Encodes and decodes texts by their stretches between ASCII white space, which no token crosses."""

    def __init__(self, path: str):
        own = self.codec = codec(path)

        def both(chunk: bytes) -> tuple[bytes, bytes]:
            ids = own.chunk_ids(chunk.decode())
            return np.array(ids, "<u4").tobytes(), own.decode(ids).encode()

        self.memo = Memo(both)

    def run(self, text: bytes) -> tuple[bytes, bytes]:
        """Ids as little-endian 32-bit numbers, and the decoded text."""
        found = list(map(self.memo.__getitem__, text.split()))
        return b"".join([x for x, _ in found]), b" ".join([y for x, y in found if x])


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    return Coder(path)

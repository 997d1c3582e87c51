"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is parsed
into phrases, each the longest string that the language's text contains. The
fewer phrases a character takes, the lower its cross entropy to the language;
the language with the fewest normalised phrases wins.

Many stretches of text are parsed at once, one step of the automaton for all of
them at a time, on tables of numbers. A stretch is at most ``STRETCH``
characters, so that a long text does not hold up the others; a new stretch
starts a new phrase in every language alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STRETCH = 256
# Characters of labelled text a language's automaton is built from, and texts they may come from.
TRAIN_CHARS, TRAIN_TEXTS = 40_000, 400
LANES = 1 << 14
UNKNOWN = "und"
_OTHER = 1  # class 0 is what is not a letter, class 1 a letter unknown to all languages


def automaton(codes: list[int], classes: int) -> np.ndarray:
    """Transition table of the suffix automaton of a string of small numbers; 0 is no transition.

    States are numbered from 1, the start; every number path that exists is a
    substring.
    """
    link, size, moves = [0, 0], [0, 0], [{}, {}]
    last = 1
    for c in codes:
        state = len(moves)
        moves.append({})
        size.append(size[last] + 1)
        link.append(1)
        p = last
        while p and c not in moves[p]:
            moves[p][c] = state
            p = link[p]
        if p:
            q = moves[p][c]
            if size[p] + 1 == size[q]:
                link[state] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                while p and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[state] = copy
        last = state
    table = np.zeros((len(moves), classes), np.int32)
    for state, own in enumerate(moves):
        for c, target in own.items():
            table[state, c] = target
    return table


@dataclass
class Model:
    languages: list[str]
    classes: np.ndarray  # of each code point up to U+FFFF
    tables: list[np.ndarray]

    def codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Classes of all characters, runs of non-letters as one, and where each text's begin."""
        points = np.frombuffer("\0".join([*texts, ""]).lower().encode("utf-32-le", "surrogatepass"), "<u4")
        ends = np.flatnonzero(points == 0)
        own = np.where(points < 1 << 16, self.classes[np.minimum(points, 0xFFFF)], _OTHER)
        if len(ends) != len(texts):  # a text holds the separator itself
            ends = np.cumsum([len(t.lower()) + 1 for t in texts]) - 1
        stop = np.zeros(len(points), bool)
        stop[ends] = True
        keep = (own != 0) | (np.concatenate(([1], own[:-1])) != 0) | stop
        own, stop = own[keep], stop[keep]
        bounds = np.concatenate(([0], np.flatnonzero(stop) + 1))
        return own, bounds

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases per text (rows) and language, and characters per text."""
        own, bounds = self.codes(texts)
        size = np.diff(bounds) - 1  # without the separator
        cuts = -(-size // STRETCH)
        text = np.repeat(np.arange(len(texts)), cuts)
        within = np.arange(len(text)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        begin = bounds[text] + within * STRETCH
        length = np.minimum(size[text] - within * STRETCH, STRETCH)
        order = np.argsort(-length, kind="stable")
        out = np.zeros((len(texts), len(self.tables)), np.int64)
        for at in range(0, len(order), LANES):
            lanes = order[at : at + LANES]
            for k, table in enumerate(self.tables):
                np.add.at(out[:, k], text[lanes], _parse(table, own, begin[lanes], length[lanes]))
        return out, size


def _parse(table: np.ndarray, codes: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Phrases of each stretch; stretches come by falling length."""
    flat, width = table.ravel(), table.shape[1]
    state, count = np.ones(len(begin), np.int32), np.ones(len(begin), np.int64)
    active = np.searchsorted(-length, -np.arange(length.max(initial=0)), "left")
    for step, n in enumerate(active.tolist()):
        c = codes[begin[:n] + step]
        to = flat[state[:n] * width + c]
        broken = np.flatnonzero(to == 0)
        if len(broken):
            # The longest match ends before this character, which begins the next
            # phrase; one that the language lacks altogether is a phrase of its own.
            count[broken] += state[broken] != 1
            again = flat[width + c[broken]]
            count[broken] += again == 0
            to[broken] = np.maximum(again, 1)
        state[:n] = to
    return count - (state == 1)


def fit(docs: DataFrame) -> Model:
    """Learn from (text, lang) rows; rows with a null are ignored.

    Per language the distinct texts with the smallest hashes are taken, at most
    ``TRAIN_TEXTS`` of them and at most ``TRAIN_CHARS`` characters in all, so the
    model has the same size for any corpus. Of each text an equal share is taken
    from a place chosen by its hash; what follows that place, then what precedes
    it, fills the room that short texts leave, up to ``TRAIN_CHARS`` of a text.
    """
    known = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("lang", "text").where(F.length(F.trim("text")) > 0)
    known = known.withColumn("hash", F.xxhash64("text"))
    # Copies count once. Hashes alone are ranked, partial results hold TRAIN_TEXTS rows at most, and only texts chosen are dealt out.
    from pyspark.sql.window import Window

    near = Window.partitionBy("lang").orderBy("hash")
    chosen = known.select("lang", "hash").distinct().withColumn("place", F.row_number().over(near)).where(F.col("place") <= TRAIN_TEXTS)
    least = TRAIN_CHARS // TRAIN_TEXTS
    begin = F.pmod(F.xxhash64("text", F.lit(1)), F.greatest(F.length("text") - least + 1, F.lit(1))).cast("int")
    ahead = F.substring(F.col("text"), begin + 1, F.lit(TRAIN_CHARS))
    before = F.substring(F.col("text"), F.lit(1), F.least(begin, F.lit(TRAIN_CHARS)))
    turned = F.when(begin == 0, ahead).otherwise(F.substring(F.concat_ws(" ", ahead, before), 1, TRAIN_CHARS))
    some = known.join(F.broadcast(chosen), ["lang", "hash"]).groupBy("lang", "place").agg(F.min(turned).alias("text"))
    texts: dict[str, list[str]] = {}
    for row in some.orderBy("lang", "place").toLocalIterator():
        texts.setdefault(row.lang, []).append(row.text)
    letters = sorted({c for t in texts.values() for x in t for c in x[:TRAIN_CHARS].lower() if c.isalpha() and ord(c) < 1 << 16})
    classes = np.zeros(1 << 16, np.int32)
    classes[[p for p in range(1 << 16) if chr(p).isalpha()]] = _OTHER
    for k, c in enumerate(letters):
        classes[ord(c)] = 2 + k
    model = Model(sorted(texts), classes, [])
    for lang in model.languages:
        joined, room = [], TRAIN_CHARS
        share = max(1, TRAIN_CHARS // len(texts[lang]))
        # An equal share of every text first, then whatever room is left from the longer ones.
        for x in [t[:share] for t in texts[lang]] + [t[share:] for t in texts[lang]]:
            joined.append(x[:room])
            room -= len(joined[-1])
        codes, _ = model.codes([" ".join(joined)])
        model.tables.append(automaton(codes[:-1].tolist(), 2 + len(letters)))
    return model


@lru_cache(maxsize=1)
def _held(broadcast):
    return broadcast.value


def identify(docs: DataFrame, model: Model, *, text: str = "text", name: str = "language") -> DataFrame:
    """Add the struct ``name`` (lang, score, phrases) to ``docs``.

    Ties go to the first language in alphabetical order. ``score`` is the share of
    phrases that the best language saves against the next one (with one language
    1). A text that is null or has no letter gets ``und`` and the score 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang:string,score:double,phrases:double>")
    def run(column: pa.Array) -> pa.Array:
        own: Model = _held(shared)
        lang, score, least = [], [], []
        for texts in _portions(column):
            count, size = own.phrases(texts)
            for t, c, n in zip(texts, count, size, strict=True):
                if not len(c) or not any(map(str.isalpha, t)):
                    lang.append(UNKNOWN)
                    score.append(0.0)
                    least.append(None)
                    continue
                best = int(np.argmin(c))
                others = np.delete(c, best)
                lang.append(own.languages[best])
                score.append(float(1 - c[best] / max(others.min(), 1)) if len(others) else 1.0)
                least.append(float(c[best] / max(n, 1)))
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(least, pa.float64())], ["lang", "score", "phrases"])

    return docs.withColumn(name, run(F.col(text).cast("string")))


def _portions(column: pa.Array, chars: int = 4 << 20) -> Iterator[list[str]]:
    part, size = [], 0
    for x in column:
        part.append(x.as_py() or "")
        size += len(part[-1])
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part

"""Plain versions of the operators, for small tables."""

import re
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(VOCABULARY)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, length):
    w = words(lower(text))
    return {tuple(w[i : i + length]) for i in range(len(w) - length + 1)} if len(w) >= length else ({tuple(w)} if w else set())


def components(rows, length, percent=80):
    """Per row (id, text): size of its set, smallest id reachable; by comparing all pairs."""
    sets = [shingles(t, length) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                up[find(i)] = find(j)
    lowest = {}
    for i, (d, _) in enumerate(rows):
        known = lowest.get(find(i))
        lowest[find(i)] = d if known is None else known if d is None else min(known, d)
    return [(len(s), lowest[find(i)]) for i, s in enumerate(sets)]


def removed(rows, length):
    """Per row (id, text) in order: words, number removed, kept text."""
    seen, out = set(), []
    for _, text in rows:
        w = words(text)
        cover = [False] * len(w)
        for i in range(len(w) - length + 1):
            run = tuple(w[i : i + length])
            if run in seen:
                cover[i : i + length] = [True] * length
            seen.add(run)
        out.append((len(w), sum(cover), " ".join(x for x, c in zip(w, cover, strict=True) if not c)))
    return out


def similarity(one, other, weight):
    """Weighted shingles in common by those in either; multisets of runs of five words."""
    both = either = 0.0
    for s in one.keys() | other.keys():
        both += weight.get(s, 1.0) * min(one[s], other[s])
        either += weight.get(s, 1.0) * max(one[s], other[s])
    return both / either


def leaks(text, items):
    """Best similarity of any window of each item's size."""
    bags = {i: Counter(runs(words(lower(t)))) for i, t in items}
    shared = Counter(s for b in bags.values() for s in b)
    weight = {s: 1 / n for s, n in shared.items()}
    w, out = words(lower(text)), {}
    for i, t in items:
        n = len(words(t))
        for at in range(max(1, len(w) - n + 1)):
            if w and n:
                out[i] = max(out.get(i, 0.0), similarity(Counter(runs(w[at : at + n])), bags[i], weight))
    return out


def runs(w):
    k = min(5, len(w))
    return [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from portolan.llm import words
from tests.llm import brute

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbé \n\t\x0b\x1c漢", max_size=40)), max_size=12)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.sampled_from([3, 1 << 20]))
def test_words_and_their_hashes(texts, limit):
    seen, got = {}, []
    for block in words.blocks(pa.array(texts, pa.string()), limit=limit):
        offsets, h = block.offsets, block.hashes()
        for i in range(len(block.counts)):
            own = block.words(i)
            got.append([w.decode() for w in own])
            for w, x in zip(own, h[offsets[i] : offsets[i + 1]].tolist(), strict=True):
                assert seen.setdefault(w, x) == x
    assert got == [brute.words(t) for t in texts]
    assert len(set(seen.values())) == len(seen)


def test_long_words_and_runs():
    texts = ["x" * n for n in (7, 8, 9, 16, 4096, 4097, 100_000)] + ["x" * 99_999 + "y"]
    (block,) = words.blocks(pa.array(texts))
    assert len(set(block.hashes().tolist())) == len(texts)
    h = np.arange(40, dtype=np.uint64) % np.uint64(7)
    for n in (1, 2, 3, 5, 8, 13):
        r = words.runs(h, n)
        assert len(r) == 41 - n and len(set(r.tolist())) == 7
    assert len(words.runs(h, 41)) == 0
    ok = words.whole(np.array([0, 3, 3, 10]), 3, 8)
    assert ok.tolist() == [True, False, False, True, True, True, True, True]

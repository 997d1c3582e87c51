import hashlib

import numpy as np
from hypothesis import example, given, settings
from hypothesis import strategies as st

from portolan.llm import bpe
from portolan.llm.bpe_texts import encode_decode
from tests.llm import brute

ODD = "aAzİΣσς é'sllvereTD1٣½Ⅷǅ漢かㅏ한̸́Ᲊ\U00010d50\U0001246f\U00018ff0\x1c\x85  　\t\n\x00\x7f﻿<|>"
TEXT = st.one_of(
    st.text(max_size=30),
    st.text(alphabet=ODD, max_size=40),
    st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|", "|>", " ", "word", "̸", "'ll"])).map("".join),
)


@settings(max_examples=400, deadline=None)
@given(TEXT)
@example("a" * 3000 + " " + "word" * 500)
def test_ids_and_text_are_those_of_the_library(text):
    ids, decoded = bpe.coder(brute.VOCABULARY).run(text.encode())
    want = brute.LIBRARY.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == want
    assert decoded.decode() == brute.LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aehinorst", min_size=1, max_size=120))
def test_scan_and_heap_agree(word):
    codec = bpe.codec(brute.VOCABULARY)
    parts = [codec.vocab[c] for c in word[:-1]] + [codec.vocab[word[-1] + codec.end]]
    assert codec._merged(list(parts)) == codec._merged_long(list(parts))


def test_column(docs, corpus, empty):
    out = {r.doc_id: r for r in encode_decode(docs, brute.VOCABULARY).collect()}
    assert encode_decode(empty, brute.VOCABULARY).count() == 0
    for d, text in corpus:
        ids = brute.LIBRARY.encode(text or "", add_special_tokens=False).ids
        row = out[d].bpe
        assert list(row.ids) == ids and row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(brute.LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_memory_is_bounded():
    memo = bpe.Memo(len, limit=3)
    assert [memo[b"x" * n] for n in range(6)] == list(range(6)) and len(memo) == 3

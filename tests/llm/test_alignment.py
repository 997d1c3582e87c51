"""op11 against a plain alignment of whole texts."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from portolan.llm import alignment
from portolan.llm.queries import QUERIES, vocabulary

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b   c", "a\n\n b\t c 　 d", "  x\u0085 y", "don't  stop", "lower▁one eighth",
    "<|endoftext|> <s> </s> <unk> <0x41>", "é ß İ Σς 漢字 🙂 ​́", "1234567 890", "x" * 5000, "漢" * 3000, "a " * 4000, "\u0000nul",
    "tab\tand\r\nline  \n  indented", "  sep", "\x1c \x1d x",
]


def plain(text, both):
    """(A ids, B ids, groups, links) of the whole text, by looking at every offset."""
    if not text:
        return None
    a = both.a.encode(" " + text, add_special_tokens=False).ids
    b = both.b.encode(text)
    whole = (" " + text).encode()
    if b"".join(both.bytes_a[i] for i in a) != whole or b"".join(both.bytes_b[i] for i in b) != whole:
        return None
    groups, links, i, j, at_a, at_b = [], [], 0, 0, 0, 0
    ga, gb = [], []
    while i < len(a) or j < len(b):
        if at_a <= at_b:
            at_a += len(both.bytes_a[a[i]])
            ga.append(a[i])
            i += 1
        else:
            at_b += len(both.bytes_b[b[j]])
            gb.append(b[j])
            j += 1
        if at_a == at_b:
            groups.append((ga, gb))
            links.append((ga[-1], gb[-1]))
            ga, gb = [], []
    return a, b, groups, links


def expected(rows):
    both = alignment.aligner(A, B)
    found = [plain(t, both) for _, t in rows]
    counts = Counter(x for f in found if f for x in f[3])
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for (d, _), f in zip(rows, found):
        if f is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = f
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        score = [counts[x] for x in links]
        n_best = sum(counts[x] == best[x[1]] for x in links)
        out.append((d, len(a), len(b), len(groups), len(links), n_best, sum(score), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def statistics(docs, staging):
    out = alignment.link_statistics(docs, A, B, staging=staging)
    return sorted((tuple(r) for r in out.select("record.doc_id", *NAMES).collect()), key=repr)


def test_documents(docs, corpus, staging):
    assert statistics(docs, staging) == expected(corpus)


def test_odd_texts(spark, staging):
    rng = random.Random(3)
    letters = ["a", "B", " ", " ", "  ", "\n", "\t", "'", "s", "é", "漢", "1", ".", " ", "　", "▁", "\r", "\x1f", "the", "ing"]
    rows = list(enumerate(ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(600)]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert statistics(docs, staging) == expected(rows)


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = QUERIES["op11_alignment"](spark, sf)
    assert sorted((tuple(r) for r in out.select("doc_id", *NAMES).collect()), key=repr) == expected(rows)
    assert dict(out.dtypes) == {n: "bigint" for n in ["doc_id", *NAMES]} | {"groups_sha256": "string"}


def test_columns_with_clashing_names_stay(spark):
    row = [(1, "some text here", "x", 5, None)]
    docs = spark.createDataFrame(row, "doc_id long, text string, record string, n_a int, links string")
    got = alignment.align(docs, A, B).first()
    assert (got.record.record, got.record.n_a, got.record.links, got.record.doc_id) == ("x", 5, None, 1) and got.n_a > 0
    only = alignment.align(spark.createDataFrame([("text",)], "text string"), A, B).first()
    assert only.groups.count("|") == only.n_groups == len(only.links) // 4


def test_empty_table(empty, staging):
    assert alignment.link_statistics(empty, A, B, staging=staging).count() == 0


def test_memory_of_stretches_is_bounded(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED_BYTES", 500)
    both = alignment.Aligner(A, B)
    texts = [f"word{i} and word{i + 1} again {'y' * 100}" for i in range(200)]
    got = both.run(texts)
    assert sum(len(s) + 40 for s in both.known) < 700 and "y" * 100 not in both.known
    assert got == alignment.Aligner(A, B).run(texts)
    whole = [both.align(t) for t in texts]
    assert [g[3] for g in got] == [w.text() for w in whole]


def test_tokens_without_bytes_share_an_end():
    got = alignment.align_ids([0, 1, 2], [0, 3], [b"ab", b"", b"c"], [b"ab", b"", b"", b"c"])
    assert got.text() == "0,1|0;2|3" and got.links == [(0, 0), (1, 0), (2, 3)]


def test_pairs_stay_within_the_bound(spark, docs, staging):
    aligned = staging.write(alignment.align(docs, A, B), "aligned")
    pairs = alignment.count_pairs(aligned, B)
    both = alignment.aligner(A, B)
    for r in pairs.collect():
        x, y = both.bytes_a[r.a_id], both.bytes_b[r.b_id]
        assert x.endswith(y) or y.endswith(x)
    assert pairs.agg(F.sum("n")).first()[0] == aligned.agg(F.sum(F.length("links") / 4)).first()[0]
    with pytest.raises(ValueError, match="vocabularies allow"):
        alignment.score_links(aligned, pairs, 3)

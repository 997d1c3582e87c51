"""MinHash near-duplicates by a multi-index Hamming join over b-bit signatures.

A text's signature holds ``VALUES`` minwise values of 16 bits; the distance of
two signatures is the number of values that differ. The signature is cut into
``CHUNKS`` chunks. If at most ``RADIUS`` values differ, some chunk has at most
``RADIUS // CHUNKS`` errors (pigeonhole), so looking up every chunk with each
allowed set of errors left out finds all pairs within the radius. At the
similarity of 0.8 a value differs with probability 0.2; more than 23 of 48
differ in 3.3 of a million pairs. The link of such a pair is lost, even if it
shares a looked-up part; its texts may still be joined by other links.

Pairs found are confirmed on the full shingle sets. Large groups of candidates
are compared block by block, so that no task holds more than two blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm import words
from portolan.llm.tables import ROW, components, numbered, pieces, stored
from portolan.sinks import Staging

VALUES, CHUNKS, RADIUS = 48, 12, 23
ERRORS = RADIUS // CHUNKS
# Members of one bucket, or of one group of candidates, that a task compares with as many others.
BUCKET_BLOCK, GROUP_BLOCK = 2000, 256
_MULTIPLIERS = np.random.default_rng(48).integers(1, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(column: pa.ChunkedArray | pa.Array, length: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle, an empty one none."""
    for block in words.blocks(column, lower=True):
        h, offsets = block.hashes(), block.offsets
        run = words.runs(h, length)
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            if b - a >= length:
                yield np.unique(run[a : b - length + 1])
            else:
                yield words.runs(h[a:b], int(b - a)) ^ np.uint64(b - a) if b > a else h[:0]


def signature(shingles: np.ndarray) -> bytes:
    """The low 16 bits of the smallest value of each of the hash functions."""
    low = np.full(VALUES, np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), 2048):
        low = np.minimum(low, words.mix(shingles[at : at + 2048, None] * _MULTIPLIERS).min(axis=0))
    return low.astype(np.uint16).tobytes()


def _sketches(length: int):
    schema = pa.schema(
        [(ROW, pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("sig", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digests, sigs = [], [], []
            for s in shingle_sets(batch.column("text"), length):
                n.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                sigs.append(signature(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(ROW), pa.array(n, pa.int64()), pa.array(digests), pa.array(sigs, pa.binary())], schema=schema
            )

    return run


def lookup_keys(sigs: np.ndarray) -> np.ndarray:
    """Keys of each signature: every chunk with every allowed set of its values left out."""
    width = VALUES // CHUNKS
    keys = []
    for chunk in range(CHUNKS):
        part = sigs[:, chunk * width : (chunk + 1) * width].astype(np.uint64)
        for kept in combinations(range(width), width - ERRORS):
            key = np.full(len(sigs), len(keys) + 1, np.uint64)
            for i in kept:
                key = words.mix(key ^ part[:, i] << np.uint64(16)) + part[:, i]
            keys.append(key)
    return np.stack(keys, axis=1).view(np.int64)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 2000):
            part = batch.slice(at, 2000)
            keys = lookup_keys(_signatures(part.column("sig")))
            nodes = np.repeat(part.column("node").to_numpy(), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(nodes)], ["key", "node"])


def _signatures(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, VALUES)


class Union:
    """Union-find over 0 .. n - 1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)


def _edge_table(names: list[bytes], tree: Union) -> pa.Table:
    """Each name's edge to the smallest name of its tree: the same edges in whichever order the names come."""
    least: dict[int, bytes] = {}
    for i, name in enumerate(names):
        root = tree.find(i)
        least[root] = min(least.get(root, name), name)
    pairs = [(least[tree.find(i)], name) for i, name in enumerate(names) if least[tree.find(i)] != name]
    return pa.table(
        {"a": pa.array([x for x, _ in pairs], pa.binary()), "b": pa.array([y for _, y in pairs], pa.binary())}
    )


def _sizes_allow(one: np.ndarray, other: int, percent: int) -> np.ndarray:
    return 100 * np.minimum(one, other) >= percent * np.maximum(one, other)


def _bucket_edges(percent: int):
    """Within each bucket of a group, join texts whose signatures are within the radius."""

    def run(table: pa.Table) -> pa.Table:
        names, index = table.column("digest").to_pylist(), {}
        own = np.array([index.setdefault(x, len(index)) for x in names])
        first = np.unique(own, return_index=True)[1]
        sigs, n = _signatures(table.column("sig"))[first], table.column("n").to_numpy()[first]
        tree = Union(len(index))
        keys, block = table.column("key").to_numpy(), table.column("block").to_numpy()
        order = np.argsort(keys, kind="stable")
        cuts = np.flatnonzero(np.diff(keys[order])) + 1
        two_blocks = table.column("i")[0].as_py() != table.column("j")[0].as_py()
        for members in np.split(order, cuts):
            left = members[block[members] == table.column("i")[0].as_py()] if two_blocks else members
            for at, x in enumerate(left):
                rest = own[members[block[members] != block[x]] if two_blocks else members[at + 1 :]]
                a = own[x]
                rest = rest[_sizes_allow(n[rest], n[a], percent)]
                near = rest[(sigs[rest] != sigs[a]).sum(axis=1) <= RADIUS]
                for y in near:
                    tree.join(int(a), int(y))
        return _edge_table(list(index), tree)

    return run


def _sets(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                sets = [s.tobytes() for s in shingle_sets(part.column("text"), length)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("digest"), part.column("label"), part.column("size"), pa.array(sets, pa.binary())],
                    ["digest", "label", "size", "shingles"],
                )

    return run


def _links(percent: int):
    """Exact similarity of the texts of each candidate group, as a spanning forest of the links."""

    def run(table: pa.Table) -> pa.Table:
        names, labels = table.column("digest").to_pylist(), table.column("label").to_pylist()
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        block = table.column("block").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        n = np.array([len(x) for x in sets])
        tree = Union(len(names))
        groups: dict[bytes, list[int]] = {}
        for at, label in enumerate(labels):
            groups.setdefault(label, []).append(at)
        for group in groups.values():
            members = np.array(sorted(group, key=lambda at: n[at]))
            ids = np.unique(np.concatenate([sets[m] for m in members]), return_inverse=True)[1]
            bounds = np.concatenate(([0], np.cumsum(n[members])))
            seen = np.zeros(ids.max() + 1, bool)
            for at, x in enumerate(members):
                # Sizes ascend: those after x up to its size / percent can be linked with it.
                stop = int(np.searchsorted(n[members] * percent, 100 * n[x], "right"))
                rest = np.arange(at + 1, stop)
                if i != j:
                    rest = rest[block[members[rest]] != block[x]]
                if not len(rest):
                    continue
                mine = ids[bounds[at] : bounds[at + 1]]
                seen[mine] = True
                shared = np.add.reduceat(seen[ids[bounds[at + 1] : bounds[stop]]], bounds[at + 1 : stop] - bounds[at + 1], dtype=np.int64)
                seen[mine] = False
                shared = shared[rest - at - 1]
                union = n[x] + n[members[rest]] - shared
                for y in members[rest[100 * shared >= percent * union]]:
                    tree.join(int(x), int(y))
        return _edge_table(names, tree)

    return run


def _paired_blocks(df: DataFrame, size: str, item: str, limit: int) -> DataFrame:
    """Repeat each row for every pair (i, j) of blocks that its own block is in."""
    count = F.ceil(F.col(size) / limit).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    df = df.withColumn("blocks", count).withColumn("block", F.pmod(F.xxhash64(item), F.col("blocks")).cast("int"))
    df = df.withColumn("other", other)
    return df.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other", "blocks")


def near_duplicates(
    docs: DataFrame, *, shingle_words: int = 5, percent: int = 80, staging: Staging, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Near-duplicate classes: (``__row``, doc_id, n_shingles, component_id, kept, first_row).

    Words are runs without white space, A-Z in lower case. Two texts are linked
    if their shingle sets share at least ``percent`` hundredths of their union.
    ``component_id`` is the smallest ``doc_id`` among the texts reachable over
    links, ``kept`` is ``doc_id = component_id``. Equal rows share a component;
    ``first_row`` marks exactly one row of each component. A null or wordless
    text is alone. A null ``doc_id`` is smaller than none (nulls are ignored by
    the minimum); its row is kept only if nothing else is in the component.
    """
    docs = stored(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), staging)
    rows = numbered(docs)
    ids = rows.select(ROW, "doc_id")
    sketch = rows.select(ROW, "text").mapInArrow(_sketches(shingle_words), f"{ROW} long, n long, digest binary, sig binary")
    sketch = staging.write(sketch, "sketch")
    classes = sketch.where("n > 0").groupBy("digest").agg(
        F.min("n").alias("n"), F.min("sig").alias("sig"), F.min(ROW).alias(ROW)
    )
    classes = staging.write(classes.withColumn("node", F.xxhash64("digest")), "classes")

    keys = classes.select("node", "sig").mapInArrow(_keys, "key long, node long")
    buckets = keys.groupBy("key").agg(F.count("node").alias("size"), F.min("node").alias("lo"), F.max("node").alias("hi"))
    buckets = buckets.where("lo <> hi").select("key", "size")
    found = keys.join(buckets, "key").join(classes.select("node", "digest", "n", "sig"), "node").drop("node")
    found = staging.write(found, "buckets")
    many = found.count()
    found = _paired_blocks(found, "size", "digest", BUCKET_BLOCK).withColumn(
        "gid", F.when(F.col("size") > BUCKET_BLOCK, F.col("key")).otherwise(F.pmod("key", F.lit(pieces(many, BUCKET_BLOCK))))
    )
    edges = found.groupBy("gid", "i", "j").applyInArrow(_bucket_edges(percent), "a binary, b binary")
    coarse = components(edges, staging)

    sizes = coarse.groupBy("root").agg(F.count("node").alias("size"))
    members = coarse.join(sizes, "root").join(classes.select(F.col("digest").alias("node"), ROW), "node")
    members = members.select(F.col("node").alias("digest"), F.col("root").alias("label"), "size", ROW)
    full = rows.join(members, ROW).select("digest", "label", "size", "text")
    full = full.mapInArrow(_sets(shingle_words), "digest binary, label binary, size long, shingles binary")
    groups = pieces(coarse.count(), GROUP_BLOCK)
    full = _paired_blocks(full, "size", "digest", GROUP_BLOCK).withColumn(
        "gid",
        F.when(F.col("size") > GROUP_BLOCK, F.xxhash64("label")).otherwise(F.pmod(F.xxhash64("label"), F.lit(groups))),
    )
    exact = full.groupBy("gid", "i", "j").applyInArrow(_links(percent), "a binary, b binary")
    linked = components(exact, staging)

    # Per class its smallest id, then per component; the rows follow by their class.
    of_row = sketch.select(ROW, "n", "digest").join(ids, ROW)
    of_row = staging.write(of_row, "rows")
    lowest = of_row.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("lo"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", ROW)).alias("head"))
    lowest = lowest.join(linked.withColumnRenamed("node", "digest"), "digest", "left")
    lowest = staging.write(lowest.withColumn("root", F.coalesce("root", "digest")), "lowest")
    heads = lowest.groupBy("root").agg(F.min("lo").alias("component_id"), F.min("head").alias("head"))
    target = lowest.select("digest", "root").join(heads, "root").select("digest", "component_id", F.col(f"head.{ROW}").alias("head"))
    out = of_row.join(target, "digest", "left") if not target.isEmpty() else of_row.withColumns(
        {"component_id": F.lit(None).cast("long"), "head": F.lit(None).cast("long")}
    )
    alone = F.col("n") == 0
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        ROW,
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        (alone | (F.col(ROW) == F.col("head"))).alias("first_row"),
    )

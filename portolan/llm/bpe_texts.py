"""BPE encoding and decoding of a column of texts."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm.bpe import coder


def encode_decode(docs: DataFrame, path: str, *, text: str = "text", name: str = "bpe") -> DataFrame:
    """Add the struct ``name`` (n_tokens, ids, ids_sha256, decoded_sha256, decoded_bytes) to ``docs``.

    ``path`` is the vocabulary file; it has to be readable by every worker. Ids
    are those of the whole text without added special tokens; a null text
    counts as empty and has none. ``ids_sha256`` is over the ids as little-endian
    unsigned 32-bit numbers, ``decoded_sha256`` over the decoded text in UTF-8.
    """

    @F.arrow_udf("struct<n_tokens:long,ids:array<int>,ids_sha256:string,decoded_sha256:string,decoded_bytes:long>")
    def run(column: pa.Array) -> pa.Array:
        own, ids, decoded = coder(path), [], []
        for x in column.cast(pa.large_binary()):
            a, b = own.run(x.as_py() or b"")
            ids.append(a)
            decoded.append((hashlib.sha256(b).hexdigest(), len(b)))
        sizes = np.array([len(a) // 4 for a in ids], np.int64)
        flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
        offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
        return pa.StructArray.from_arrays(
            [
                pa.array(sizes),
                pa.ListArray.from_arrays(offsets, flat),
                pa.array([hashlib.sha256(a).hexdigest() for a in ids], pa.string()),
                pa.array([h for h, _ in decoded], pa.string()),
                pa.array([n for _, n in decoded], pa.int64()),
            ],
            ["n_tokens", "ids", "ids_sha256", "decoded_sha256", "decoded_bytes"],
        )

    return docs.withColumn(name, run(F.col(text).cast("string")))

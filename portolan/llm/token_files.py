"""Token ids in Arrow files of equal-length sequences.

A file is in Arrow's random-access file format. Every row is one sequence: a
fixed-size list of ids and a fixed-size list of mask bits, false where the last
sequence is filled up. The lists lie in the file as flat arrays, so a
memory-mapped file gives any sequence without a copy. Batches hold equally many
sequences. The documents lie one after the other over the sequences; their ids
and lengths are in the schema's metadata.

Files are written by Spark's text writer, which commits a task's files as a
whole on any store: a file is one value, and the writer's line end is chosen to
be the six bytes an Arrow file ends with. A task holds the ids of one file and
one block of texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from portolan.llm.library import library
from portolan.llm.tables import ROW, numbered, pieces, stored, text_bytes
from portolan.sinks import Staging

SEQUENCE, BATCH = 2048, 256
# Text of a range of documents, on average; a task with more ids than these begins another file.
FILE_TEXT_BYTES, FILE_IDS = 24 << 20, 12 << 20
# Texts are encoded in blocks of about so many bytes.
BLOCK_BYTES = 1 << 20
# Bits of a file's number that count the files of a task.
FILES_BITS = 24
MAGIC = b"ARROW1"


def arrow_file(part: int, parts: list[np.ndarray], doc_ids: list[int | None], sizes: np.ndarray, sequence: int) -> pa.Buffer:
    """The bytes of one file, whose ids are those of ``parts``, one after the other.

    They have an unsigned integer type that is kept; ``parts`` is emptied as the ids are written.
    """
    dtype, total = parts[0].dtype, sum(map(len, parts))
    meta = {
        b"part": str(part).encode(),
        b"total": str(total).encode(),
        b"doc_id": np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        b"doc_id_null": np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        b"n_tokens": sizes.astype("<i8").tobytes(),
    }
    kind = pa.from_numpy_dtype(dtype)
    schema = pa.schema([("ids", pa.list_(kind, sequence)), ("mask", pa.list_(pa.bool_(), sequence))], metadata=meta)
    sink = pa.BufferOutputStream()
    size, parts[:] = BATCH * sequence, parts[::-1]
    with pa.ipc.new_file(sink, schema) as out:
        for at in range(0, max(total, 1), size):
            used = min(size, total - at)
            ids = np.zeros(max(1, -(-used // sequence)) * sequence, dtype)
            have = 0
            while have < used:
                head = parts.pop()
                take = min(len(head), used - have)
                ids[have : have + take] = head[:take]
                have += take
                if take < len(head):
                    parts.append(head[take:])
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), sequence) for x in (ids, np.arange(len(ids)) < used)]
            out.write_batch(pa.RecordBatch.from_arrays(lists, schema=schema))
    return sink.getvalue()


class TokenFile:
    """Random access to one file's sequences and documents, without copying them."""

    def __init__(self, source):
        self.reader = pa.ipc.open_file(source)
        meta = self.reader.schema.metadata
        self.part, self.total = int(meta[b"part"]), int(meta[b"total"])
        null = np.frombuffer(meta[b"doc_id_null"], bool)
        self.doc_ids = [None if x else d for d, x in zip(np.frombuffer(meta[b"doc_id"], "<i8").tolist(), null, strict=True)]
        self.sizes = np.frombuffer(meta[b"n_tokens"], "<i8")
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))[:-1]
        self.length = self.reader.schema.field("ids").type.list_size

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of the i-th sequence."""
        batch = self.reader.get_batch(i // BATCH)
        cut = (i % BATCH) * self.length
        ids = batch.column(0).flatten().to_numpy()[cut : cut + self.length]
        return ids, batch.column(1).flatten().slice(cut, self.length)

    def stream(self) -> np.ndarray:
        """All ids of the file's documents, one after the other."""
        parts = [self.reader.get_batch(i) for i in range(self.reader.num_record_batches)]
        return np.concatenate([b.column(0).flatten().to_numpy()[: b.column(1).flatten().true_count] for b in parts])


def _encode(path: str, end: int, kind: str, sequence: int, limit: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, docs, sizes, ids, held = TaskContext.get().partitionId(), 0, [], [], [], 0

        def file() -> pa.RecordBatch:
            data = arrow_file((task << FILES_BITS) + number, ids, docs, np.concatenate(sizes), sequence)
            size = data.size - len(MAGIC)  # the writer's line end follows
            value = pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(np.array([0, size], "<i4")), data.slice(0, size)])
            docs.clear(), sizes.clear(), ids.clear()
            return pa.RecordBatch.from_arrays([value], ["value"])

        coder = library(path, kind)
        for batch in batches:
            column, numbers = batch.column("text"), batch.column("doc_id")
            for first, n, found in coder.run(column, block):
                docs.extend(numbers.slice(first, len(n)).to_pylist())
                sizes.append(n + 1)
                ids.append(np.insert(found, np.cumsum(n), np.array(end, kind)))
                held += len(ids[-1])
                if held >= limit:
                    yield file()
                    number, held = number + 1, 0
        if docs:
            yield file()

    return run


def write_tokens(
    docs: DataFrame,
    folder: str,
    path: str,
    *,
    end: int = 1,
    sequence: int = SEQUENCE,
    doc_id: str = "doc_id",
    text: str = "text",
    staging: Staging | None = None,
) -> None:
    """Encode ``text`` and write files of documents in ascending order of ``doc_id``, within and over the files.

    Each document is its whole text's ids, without added special tokens, and
    ``end``. A null text counts as empty. Null ids come first; equal ids are in
    the order of their texts' hashes, and rows of equal id and text in that of their place
    in the input, so a group of any size is cut over tasks and files. A document is never
    cut: a very long one makes a long file. An empty table gives no file. Other
    columns, whatever their names, are not read. Ids take two bytes if the
    vocabulary allows it, else four. Input that is no plain scan is stored in ``staging`` first.
    """
    docs = stored(docs, staging or Staging(docs.sparkSession))
    docs = numbered(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), ROW)
    kind = "<u2" if library(path, "<u4").tokenizer.get_vocab_size() <= 1 << 16 and end < 1 << 16 else "<u4"
    n = pieces(text_bytes(docs, "text"), FILE_TEXT_BYTES)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col(ROW)]
    # Hash and row split a frequent id too.
    placed = docs.repartitionByRange(n, *order).sortWithinPartitions(*order)
    files = placed.mapInArrow(_encode(path, end, kind, sequence, FILE_IDS, BLOCK_BYTES), "value binary")
    # A row is a file.
    out = files.select(F.col("value").cast("string")).write.option("lineSep", MAGIC.decode())
    out.option("maxRecordsPerFile", 1).text(folder)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            file = TokenFile(pa.BufferReader(content.as_buffer()))
            ids = file.stream().astype("<u4")
            n = len(file.doc_ids)
            crc = [zlib.crc32(ids[a : a + k]) for a, k in zip(file.starts.tolist(), file.sizes.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([file.part] * n, pa.int64()),
                    pa.array([file.total] * n, pa.int64()),
                    pa.array(file.doc_ids, pa.int64()),
                    pa.array(file.starts),
                    pa.array(file.sizes),
                    pa.array(crc, pa.int64()),
                ],
                ["part", "total", "doc_id", "at", "n_tokens", "ids_crc32"],
            )


def read_documents(spark, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    docs = files.mapInArrow(_documents, "part long, total long, doc_id long, at long, n_tokens long, ids_crc32 long")
    # One row per file.
    before = docs.groupBy("part").agg(F.max("total").alias("total"))
    before = before.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    out = docs.join(before, "part")
    return out.select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", F.col("part").alias("file"))

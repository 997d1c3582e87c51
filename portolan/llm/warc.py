"""WARC archives compressed record by record with a dictionary of their own.

A file starts with a skippable Zstandard frame that holds the dictionary; every
record follows as one frame. The dictionary is built from a bounded number of
the records that are archived, chosen by hash. Payloads that were stored before
become revisit records.

Files are written by Spark's text writer, which commits a task's file as a whole
on any store: a frame is one value, and the writer's line end is chosen to be an
empty skippable frame, which every Zstandard reader passes over.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.llm.tables import ROW, numbered, pieces, stored, text_bytes
from portolan.sinks import Staging

# Fixed values of the format: frame of the dictionary, other skippable frame, compressed frame.
DICTIONARY, SKIPPABLE, FRAME = 0x184D2A5D, 0x184D2A50, 0xFD2FB528
EMPTY_FRAME = struct.pack("<II", SKIPPABLE, 0)
SMALLEST_REVISIT = 100
DICTIONARY_BYTES = 64 << 10
# Records a dictionary is built from, and how much of each: bounds on what the driver fetches for it.
SAMPLE_RECORDS, SAMPLE_BYTES = 1000, 16 << 10
# A file ends with the record that brings it to so many bytes; a task holds one file.
FILE_BYTES = 24 << 20
LEVEL = 3
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"


def record_id(row: int, page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{row}')}>"


def build_record(page: dict) -> bytes:
    """One WARC record; ``page`` has row, page_id, url, payload, digest, n_bytes, refers_to and refers_row."""
    payload, revisit = page["payload"], page["refers_row"] is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {page['n_bytes']}\r\n\r\n".encode()
    block = http if revisit else http + payload
    # A header is a line: what would break it out of its line goes as an escape.
    url = "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in page["url"] or "")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page['row'], page['page_id'])}",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha256:{page['digest']}",
        f"Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page["page_id"] is not None:
        head.append(f"X-Page-ID: {page['page_id']}")
    if revisit:
        head += [
            f"WARC-Profile: {_PROFILE}",
            f"WARC-Refers-To: {record_id(page['refers_row'], page['refers_to'])}",
            f"X-Refers-To-Page-ID: {page['refers_to']}",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Header fields (lower-case names) and block of one record."""
    head, rest = data.split(b"\r\n\r\n", 1)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
    size = int(fields["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record's length is not what its header says")
    return fields | {"block": rest[:size]}


def frames(content: memoryview) -> Iterator[bytes]:
    """The records of an archive file, decompressed with the dictionary that leads it."""
    at, unpress, view = 0, zstandard.ZstdDecompressor(), memoryview(content)
    while at < len(view):
        magic = int.from_bytes(view[at : at + 4], "little")
        if magic & 0xFFFFFFF0 == SKIPPABLE:
            size = int.from_bytes(view[at + 4 : at + 8], "little")
            if magic == DICTIONARY:
                unpress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(view[at + 8 : at + 8 + size])))
            at += 8 + size
            continue
        work = unpress.decompressobj()
        # Records are small against a file; the first piece mostly holds a whole one.
        parts, step = [], 1 << 16
        while not work.eof:
            piece = view[at : at + step]
            if not len(piece):
                raise ValueError("an archive ends within a record")
            parts.append(work.decompress(piece))
            at += len(piece) - len(work.unused_data)
        yield b"".join(parts)


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data = [build_record(x)[:SAMPLE_BYTES] for x in _pages(batch)]
        yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary())], ["sample"])


def _pages(batch: pa.RecordBatch) -> Iterator[dict]:
    for at in range(0, len(batch), 500):
        part = batch.slice(at, 500)
        payload = part.column("payload").cast(pa.large_binary()).to_pylist()
        rest = part.select([c for c in part.schema.names if c != "payload"]).to_pylist()
        for x, y in zip(rest, payload, strict=True):
            yield x | {"payload": y or b""}


@lru_cache(maxsize=1)
def _press(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_checksum=True)


def _compress(dictionary: bytes, limit: int):
    """Archives, each a value: the dictionary's frame and a frame per record, until they take ``limit`` bytes."""
    lead = struct.pack("<II", DICTIONARY, len(dictionary)) + dictionary if dictionary else b""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, out = _press(dictionary), pa.BufferOutputStream()

        def file() -> pa.RecordBatch:
            data = out.getvalue()
            value = pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(struct.pack("<ii", 0, data.size)), data])
            return pa.RecordBatch.from_arrays([value], ["value"])

        for batch in batches:
            for page in _pages(batch):
                if not out.tell():
                    out.write(lead)
                out.write(press.compress(build_record(page)))
                if out.tell() >= limit:
                    yield file()
                    out = pa.BufferOutputStream()
        if out.tell():
            yield file()

    return run


def train(samples: list[bytes]) -> bytes:
    """A dictionary from records; none if there are too few to learn from."""
    if sum(map(len, samples)) < 10 * 1024 or len(samples) < 10:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too little in common to make a dictionary of
        return b""


def archive(pages: DataFrame, folder: str, *, staging: Staging, page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write a record per row, payload the html in UTF-8 (null: empty).

    Of records with equal payloads of at least ``SMALLEST_REVISIT`` bytes the one
    with the smallest id is the response (of equal ids the first row; a null id
    comes last), the others revisit it. An empty table writes no record. Files
    are cut at ``FILE_BYTES``; only a single record may be longer.
    """
    pages = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html")
    )
    pages = numbered(stored(pages, staging, "pages"))
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    pages = pages.select(
        F.col(ROW).alias("row"), "page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"), F.length(payload).cast("long").alias("n_bytes")
    )
    # Digests alone decide; only those that occur twice go on. A frequent one is
    # reduced to a row per task before the shuffle.
    order = F.struct(F.col("page_id").isNull(), "page_id", "row")
    heads = pages.where(F.col("n_bytes") >= SMALLEST_REVISIT).groupBy("digest").agg(F.min(order).alias("head"), F.count("row").alias("n"))
    heads = staging.write(heads.where("n > 1").select("digest", "head.page_id", "head.row"), "heads")
    heads = heads.select("digest", F.col("page_id").alias("refers_to"), F.col("row").alias("refers_row"))
    # Digests meet without payloads; the one link of a row then meets its payload by the row's number.
    keys = pages.where(F.col("n_bytes") >= SMALLEST_REVISIT).select("digest", "row")
    links = keys.join(heads, "digest").where(F.col("refers_row") != F.col("row")).select("row", "refers_to", "refers_row")
    whole = pages.join(staging.write(links, "links"), "row", "left")
    plain = pages.withColumns({"refers_to": F.lit(None).cast("long"), "refers_row": F.lit(None).cast("long")})
    # SAMPLE_RECORDS row numbers, at most, are broadcast, and SAMPLE_BYTES of each of these records are fetched.
    chosen = sampled(pages.select("row"), SAMPLE_RECORDS)
    some = plain.join(F.broadcast(chosen), "row", "left_semi")
    dictionary = train(sorted(bytes(r.sample) for r in some.mapInArrow(_samples, "sample binary").collect()))
    values = whole.mapInArrow(_compress(dictionary, FILE_BYTES), "value binary")
    # A row is a file.
    writer = values.select(F.col("value").cast("string")).write.option("lineSep", EMPTY_FRAME.decode())
    writer.option("maxRecordsPerFile", 1).text(folder)


def sampled(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` row numbers with the smallest hashes, or all.

    Only rows whose hash lies below four times the share wanted are sorted, so
    a task passes on few of them, however many tasks there are.
    """
    total = rows.count()
    below = -(1 << 63) + (1 << 64) * 4 * n // max(total, 4 * n)
    key = F.xxhash64("row")
    if below < 1 << 63:
        rows = rows.where(key < below)
    return rows.orderBy(key, "row").limit(n)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            rows = []
            for data in frames(memoryview(content.as_buffer())):
                rows.append(_row(parse_record(data)))
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def _row(fields: dict) -> tuple:
    number = lambda name: int(fields[name]) if fields.get(name, "None") != "None" else None
    head, payload = fields["block"].split(b"\r\n\r\n", 1)
    size = int(head.rsplit(b"Content-Length: ", 1)[1])
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    if fields["warc-type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"{fields['warc-record-id']}: the payload is not the one archived")
    return number("x-page-id"), size, digest, fields["warc-type"], number("x-refers-to-page-id"), fields["warc-target-uri"]


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """A row per record: page_id, payload_bytes, payload_digest, record_type, refers_to, url.

    The payload of every response is checked against its length and digest.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    return files.mapInArrow(
        _read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
    )

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from portolan.llm import warc
from tests.llm.conftest import prose


def pages_of(spark, rows):
    data = [(i, u, h, "clash", "clash") for i, u, h in rows]
    return spark.createDataFrame(data, "page_id long, url string, html string, payload string, digest string").repartition(3)


def test_archives_give_back_every_page(spark, staging):
    rng = random.Random(1)
    rows = [(i, f"http://h/{i}", f"<html><p>{prose(rng, rng.randint(20, 90))}</p></html>\r\n\r\n") for i in range(10, 120)]
    same = rows[3][2]
    rows += [(i, "u", same) for i in (2, 500, 501, 502)] + [(502, "again", same), (None, None, same)]
    rows += [(600, "odd url\r\nX: y é", None), (601, None, ""), (602, "s", "short"), (603, "s", "short"), (604, "l", "x" * 300_000), (605, "e", "é漢\x00" * 50)]
    folder = staging.path("warc")
    warc.archive(pages_of(spark, rows), folder, staging=staging)
    out = warc.read_archives(spark, folder).collect()
    assert len(out) == len(rows)
    first = {}
    for i, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(h, i)
    seen, want = set(), []
    for i, _, h in rows:
        data = (h or "").encode()
        revisit = len(data) >= 100 and (first[h] != i or (i, h) in seen)
        seen.add((i, h))
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first[h] if revisit else None))
    assert sorted(map(repr, ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out))) == sorted(map(repr, want))
    files = [r.content for r in spark.read.format("binaryFile").load(folder + "/part-*").collect()]
    # the dictionary leads each file, and is needed to read it
    assert all(int.from_bytes(c[:4], "little") == warc.DICTIONARY for c in files)
    bare = files[0][8 + int.from_bytes(files[0][4:8], "little") :]
    with pytest.raises(Exception):
        list(warc.frames(memoryview(bare)))


def test_archives_are_cut(spark, staging, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 70_000)
    rng = random.Random(4)
    rows = [(i, f"u{i}", prose(rng, 900, 10**6)) for i in range(120)] + [(500, "u", rng.randbytes(100_000).hex()), (None, "u", None)]
    folder = staging.path("warc")
    warc.archive(pages_of(spark, rows), folder, staging=staging)
    out = warc.read_archives(spark, folder).collect()
    assert sorted((repr(r.page_id), r.payload_bytes) for r in out) == sorted((repr(i), len(h or "")) for i, _, h in rows)
    sizes = [r.length for r in spark.read.format("binaryFile").load(folder + "/part-*").select("length").collect()]
    assert len(sizes) > 6 and sorted(sizes)[-2] < 80_000


def test_sample_of_rows(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "row")
    want = rows.orderBy(F.xxhash64("row"), "row").limit(50).collect()
    assert warc.sampled(rows, 50).collect() == want
    assert warc.sampled(rows, 30_000).count() == 20_000 and warc.sampled(rows.limit(0), 5).count() == 0


def test_records_that_are_damaged_are_not_read(spark, staging):
    folder = staging.path("warc")
    warc.archive(pages_of(spark, [(1, "u", "x" * 200)]), folder, staging=staging)
    content = spark.read.format("binaryFile").load(folder + "/part-*").first().content
    (record,) = warc.frames(memoryview(content))
    fields = warc.parse_record(record)
    assert warc._row(fields)[:2] == (1, 200)
    with pytest.raises(ValueError):
        warc._row(fields | {"block": fields["block"].replace(b"xxx", b"xyx", 1)})
    with pytest.raises(Exception):
        list(warc.frames(memoryview(content[:-30])))


def test_empty_table(spark, staging):
    folder = staging.path("warc")
    warc.archive(pages_of(spark, []).where("false"), folder, staging=staging)
    assert warc.read_archives(spark, folder).count() == 0

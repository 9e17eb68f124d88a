"""Archives against their pages, with record heads inside the payloads and splits of any size."""

import base64
import hashlib
import random

import pytest

from compare import differences, duck
from storeops.llm import warc
from storeops.llm.common import work_folder

SF = "/root/testdata/sf0.001"


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def head(n):
    return f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99{n}>\r\nContent-Length: {n}\r\n\r\n"


def pages_with_heads():
    rng = random.Random(5)
    parts = ["abc é", "\r\n\r\n", "WARC/1.0\r\n", head(5) + "hello\r\n\r\n", head(40), head(10**6), "x" * 60]
    rows = []
    for i in range(24):
        body = "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))
        rows.append((i, f"http://x/{i}" if i % 7 else None, body if i % 11 else None))
    return rows + [(500, "u\r\nv", rows[5][2]), (501, "u", ""), (501, "u", "")]


def expected(rows):
    first, out = {}, []
    for i, _, body in sorted(rows, key=lambda r: r[0]):
        data = (body or "").encode()
        kind = "response" if first.setdefault(data, i) == i else "revisit"
        kept = data if kind == "response" else b""
        out.append((f"<urn:page:{i}>", kind, len(kept), digest(kept), kept))
    return sorted(out)


@pytest.mark.parametrize("split", [1 << 27, 900])
def test_records_in_any_split(spark, split):
    rows = pages_with_heads()
    path = work_folder(spark, "warc-test")
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path)
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    try:
        spark.conf.set(keys[0], split)
        spark.conf.set(keys[1], 1)
        records = warc.read_warc(spark, path, payload=True)
        got = [(r.record_id, r.record_type, r.payload_bytes, r.payload_digest, bytes(r.payload)) for r in records.collect()]
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)
    assert sorted(got) == expected(rows)


def test_split_digests_and_chains():
    """Segments of one split: a nested head is a candidate, and chains leave the split where they must."""
    split = warc._Split("f", 0, True)
    record = head(len(head(3)) + 7)[len(warc.MAGIC) :].encode()
    for segment in (b"", record, head(3)[len(warc.MAGIC) :].encode() + b"abc\r\n\r\n" + b"\r\n\r\n", b"broken", head(9)[len(warc.MAGIC) :].encode() + b"cut"):
        split.add(segment)
    *rows, end = split.rows()
    assert [r[3] for r in rows] == [0, 10 + len(record), rows[2][3]] and end[2] == split.at
    assert rows[0][-1] == head(3).encode() + b"abc\r\n\r\n" and rows[1][-1] == b"abc"
    assert rows[2][-2] is None and rows[2][5] >= split.at  # its payload goes on in the next split
    assert rows[0][5] is None  # a broken head follows


def test_query(spark):
    assert differences(spark, duck(SF), SF, warc.op1_warc, warc.OP1_SQL) == []


def test_awkward_pages(spark, tmp_path):
    rows = [(1, "a", "x"), (2, None, "x"), (3, "b", None), (4, "b", ""), (None, "c", "x"), (5, "d", "y" * 300_000)]
    frame = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, record_type string")
    frame.write.parquet(str(tmp_path / "a" / "pages.parquet"))
    got = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in warc.op1_warc(spark, str(tmp_path / "a")).collect()}
    assert got == {
        1: (1, "response", None), 2: (1, "revisit", 1), 3: (0, "response", None), 4: (0, "revisit", 3),
        None: (1, "response", None), 5: (300_000, "response", None),
    }
    frame.limit(0).write.parquet(str(tmp_path / "b" / "pages.parquet"))
    assert warc.op1_warc(spark, str(tmp_path / "b")).count() == 0


def test_an_id_that_repeats_with_unlike_payloads(spark, tmp_path):
    rows = [(1, "a"), (5, "a"), (5, "b"), (1, "c"), (7, "c"), (7, "b"), (7, "d"), (5, "b")]
    spark.createDataFrame([(i, "u", h) for i, h in rows], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted((r.page_id, r.payload_digest, r.record_type, r.refers_to or 0) for r in warc.op1_warc(spark, str(tmp_path)).collect())
    first = {h: min(i for i, x in rows if x == h) for _, h in rows}
    assert got == sorted((i, digest(h.encode()), *(("response", 0) if first[h] == i else ("revisit", first[h]))) for i, h in rows)

"""Round trips through archives, revisits against a plain grouping, and broken archives."""

import base64
import gzip
import hashlib
import io
import time

from pyspark.sql import functions as F

from recordloom.llm.warc import gzip_member, read_records, read_warc, record_bytes, write_warc
from recordloom.llm.work import work_folder


def test_round_trip(spark):
    long = "päge " * 300_000
    data = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, None, "same"), (4, "http://a/4\r\nX: y", None), (5, "http://a/5", ""),
            (6, "http://a/6", long), (7, "http://a/7", "alone\r\n\r\nbody"), (None, "http://a/8", "same"), (None, "u", "no id"), (2, "http://a/2", "same"),
            (None, "u", "no id")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").withColumns({n: F.lit(n) for n in ("digest", "leader", "payload")})
    got = read_warc(write_warc(pages.repartition(3), work_folder(spark), archive_bytes=200)).collect()
    assert {r.status for r in got} == {"ok"}
    largest = {}
    for i, _, t in data:
        t = (t or "").encode()
        largest[t] = max(largest.get(t, -1), -1 if i is None else i)
    want = []
    for i, _, t in data:
        t = (t or "").encode()
        revisit = largest[t] >= 0 and i != largest[t]
        want.append((f"urn:page:{'' if i is None else i}", "revisit" if revisit else "response", len(t), base64.b32encode(hashlib.sha1(t).digest()).decode(),
                     f"urn:page:{largest[t]}" if revisit else None, None if revisit else t))
    assert sorted(((r.record_id, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to, r.payload) for r in got), key=str) == sorted(want, key=str)
    assert {r.target_uri for r in got if r.record_id == "urn:page:4"} == {"http://a/4%0D%0AX:%20y"}


def test_least_bytes_and_no_rows(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    got = read_warc(write_warc(pages, work_folder(spark), least_revisit_bytes=3)).collect()
    assert sorted((r.record_id[-1], r.record_type) for r in got) == [("1", "response"), ("2", "response"), ("3", "revisit"), ("4", "response")]
    assert read_warc(write_warc(pages.limit(0), work_folder(spark))).count() == 0


def test_members_and_faults():
    plain = [record_bytes(f"urn:page:{k}", "u", b"x" * k * 50_000, "1970-01-01T00:00:00Z") for k in range(4)]
    data = [gzip_member(p, 6) for p in plain]
    assert gzip.decompress(b"".join(data)) == b"".join(plain)
    whole = list(read_records(io.BytesIO(b"".join(data))))
    assert [len(r.payload) for r in whole] == [0, 50_000, 100_000, 150_000] and {r.status for r in whole} == {"ok"}
    cut = list(read_records(io.BytesIO(b"".join(data)[:-20])))
    assert [r.status for r in cut] == ["ok", "ok", "ok", "truncated"]
    changed = gzip_member(plain[1].replace(b"xxx", b"xyx", 1), 6)
    assert [r.status for r in read_records(io.BytesIO(changed + data[2]))] == ["digest", "ok"]
    short = gzip_member(plain[1].replace(b"Content-Length: 50", b"Content-Length: 40"), 6)
    assert [r.status for r in read_records(io.BytesIO(short + data[2]))][0] == "framing"
    assert [r.status for r in read_records(io.BytesIO(b"not gzip"))] == ["framing"]
    assert list(read_records(io.BytesIO(b""))) == []


def test_blocks_with_and_without_an_empty_line():
    """Searched once as they come, wherever the end of the head lies between two pieces."""
    record = lambda block: gzip_member(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n", 1)
    for size in range(65_480, 65_540):
        head = b"H: " + b"x" * size + b"\r\n\r\n"
        (got,) = read_records(io.BytesIO(record(head + b"body")))
        assert (got.status, got.payload) == ("ok", b"body")
    block = b"no head " * 8_000_000
    begun = time.monotonic()
    (got,) = read_records(io.BytesIO(record(block)))
    assert got.status == "ok" and got.payload == block and time.monotonic() - begun < 30

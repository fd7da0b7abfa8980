"""Archives: what is written comes back, and records find their transactions."""

import base64
import gzip
import hashlib

import pytest

from shelfmark.llm import warc
from shelfmark.llm.common import prepared

HTML = [None, "", "<p>one", "<p>one", "<p>one", "a\r\n\r\nb\r\n", "\r\n\r\n", "\r\n\r\n\r\n\r", "x\r",
        "é漢\U0001d518\u0000", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "y" * 300_000,
        "\r\n\r\n" * 20_000, "\r\n" * 7 + "z", "tail\r\n\r"]
SCHEMA = "page_id bigint, url string, html string, type string, payload int, record_id int"


@pytest.fixture
def pages(spark):
    prepared(spark)
    rows = [(40 - n, f"http://h.example/{n}?q=a b\r\n" if n % 4 else None, html, "t", 1, 2)
            for n, html in enumerate(HTML)]
    rows += [rows[2], (None, "bad://[", "<p>one", "t", 1, 2), (None, "odd", "lonely", "t", 1, 2)]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_round_trip(spark, pages, tmp_path):
    rows, df = pages
    warc.write(df, str(tmp_path / "w"))
    records = warc.read(spark, str(tmp_path / "w"))
    assert {r.type: r.n for r in records.groupBy("type").count().withColumnRenamed("count", "n")
            .collect()}.keys() == {"response", "revisit", "request", "metadata"}
    found = warc.captures(records).collect()
    assert len(found) == len(rows)
    smallest = {}
    for page, _, html, *_ in rows:
        smallest.setdefault(html or "", []).append(page)
    smallest = {h: min((p for p in ps if p is not None), default=None) for h, ps in smallest.items()}
    want = sorted(str((page, len((html or "").encode()), smallest[html or ""] == page,
                       (html or "").encode() if smallest[html or ""] == page else None))
                  for page, _, html, *_ in rows)
    got = [(r.metadata.fields.get("page-id"), r.payload_bytes, r.record_type == "response",
            bytes(r.payload) if r.payload is not None else None) for r in found]
    assert sorted(str((int(p) if p else None, *rest)) for p, *rest in got) == want
    assert all(r.request.first_line.startswith("GET /") for r in found)
    assert all(r.intact for r in found if r.record_type == "response")
    assert warc.unattached(records).count() == 0


def test_report(spark, pages, tmp_path):
    rows, df = pages
    warc.write(df, str(tmp_path / "w"), least_bytes=3)
    got = warc.report(warc.captures(warc.read(spark, str(tmp_path / "w"), with_payload=False)))
    by_page = {r.page_id: r for r in got.collect() if r.page_id is not None}
    assert len(by_page) == len(HTML)
    for n, html in enumerate(HTML):
        row, data = by_page[40 - n], (html or "").encode()
        assert (row.payload_bytes, row.payload_digest) == (
            len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        revisit = html == "<p>one" and 40 - n != 36
        assert (row.record_type, row.refers_to) == (
            ("revisit", 36) if revisit else ("response", None))


def test_empty_table(spark, pages, tmp_path):
    warc.write(pages[1].limit(0), str(tmp_path / "w"))
    found = warc.report(warc.captures(warc.read(spark, str(tmp_path / "w"))))
    assert found.count() == 0 and found.columns == [
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def record(kind, record_id, block=b"", **fields):
    fields = {"WARC-Type": kind, "WARC-Record-ID": record_id, **fields, "Content-Length": len(block)}
    head = "WARC/1.0\r\n" + "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in fields.items())
    return head.encode() + b"\r\n" + block + b"\r\n\r\n"


def test_foreign_archives(spark, tmp_path):
    """Records in any order, in members of their own, named from either side, alone or broken."""
    http = b"HTTP/1.1 200 OK\r\nServer: s\r\n\r\nbody"
    parts = [record("warcinfo", "i", b"software: s\r\n", Content_Type="application/warc-fields"),
             record("request", "q1", b"GET / HTTP/1.1\r\n\r\n", Content_Type="application/http"),
             record("metadata", "m1", b"a: 1\r\nb: 2\r\n", Content_Type="application/warc-fields",
                    WARC_Concurrent_To="r1"),
             record("response", "r1", http, Content_Type="application/http",
                    WARC_Concurrent_To="q1", WARC_Payload_Digest="sha1:WRONG"),
             record("metadata", "m2", b"", WARC_Concurrent_To="gone"),
             record("response", "r2", b"no http")]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, parts)))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(parts[3].replace(b"r1", b"r3") + b"junk\r\n\r\n"))
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(parts[5].replace(b"r2", b"r4") + parts[3][:-9]))
    records = warc.read(spark, str(tmp_path))
    found = {r.record_id: r for r in warc.captures(records).collect()}
    assert sorted(found) == ["r1", "r2", "r3", "r4"]
    one = found["r1"]
    assert (bytes(one.payload), one.intact, one.request.record_id, one.metadata.fields) == (
        b"body", False, "q1", {"a": "1", "b": "2"})
    assert found["r2"].request is None and bytes(found["r2"].payload) == b"no http"
    assert [r.record_id for r in warc.unattached(records).collect()] == ["m2"]
    broken = sorted(r.first_line for r in records.where("type = 'broken'").collect())
    assert len(broken) == 2 and broken[1] == "the last record is cut off"

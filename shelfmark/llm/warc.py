"""WARC archives written from pages, read back, and assembled into captures.

``write`` makes three records of every page: the response (or a revisit, if another page had the
same payload), the request and a metadata record that carries the page's id; the latter two name
the first by ``WARC-Concurrent-To``. Spark's text writer ends each row with the two line breaks
that end a WARC record, so that its files are plain gzip'd WARC/1.1 files in any store it can
write to. ``read`` streams files back: a task takes the pieces between double line breaks in their
order and puts records together by their ``Content-Length``, holding one record at a time.
``captures`` joins the records of each transaction by their identifiers into one nested row.

Of pages with equal payloads of at least ``least_bytes`` the one of the smallest id is the
response, null ids last; all rows that share this id and payload are responses. A null page is an
empty payload, a null address is left out, control characters in one are percent-encoded. Pages
may be of any length that a row can hold. Repeated rows are captures of their own. An empty table
gives no records. Only the columns named are read; further ones do no harm. What follows a broken
record in its file cannot be read; a record of type ``broken`` says so.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import map_batches, stored

END = b"\r\n\r\n"
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("file string, type string, record_id string, concurrent_to array<string>, "
          "target_uri string, date string, payload_digest string, payload_bytes bigint, "
          "intact boolean, first_line string, fields map<string,string>, payload binary")
_ARROW = pa.schema([
    ("file", pa.string()), ("type", pa.string()), ("record_id", pa.string()),
    ("concurrent_to", pa.list_(pa.string())), ("target_uri", pa.string()), ("date", pa.string()),
    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("intact", pa.bool_()),
    ("first_line", pa.string()), ("fields", pa.map_(pa.string(), pa.string())),
    ("payload", pa.binary())])


def digest(payload: bytes) -> str:
    """The SHA-1 of a payload in base32, as archives label it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _safe(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode())
                   for c in url)


def _record(kind: str, record_id: str, date: str, fields: dict[str, str | None],
            block: bytes) -> bytes:
    fields = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{record_id}>", "WARC-Date": date,
              **fields, "Content-Length": str(len(block))}
    head = [VERSION, *[f"{k}: {v}" for k, v in fields.items() if v is not None]]
    return "\r\n".join(head).encode() + END + block


def capture(page_id: str | None, url: str | None, payload: bytes, first_url: str | None,
            is_revisit: bool, date: str) -> list[bytes]:
    """The records of one page."""
    ids = [str(uuid.uuid4()) for _ in range(3)]
    uri = _safe(url) if url is not None else None
    parts = urlsplit(uri) if uri and "[" not in uri else None
    path = f"/{parts.path.lstrip('/')}" if parts else "/"
    path += f"?{parts.query}" if parts and parts.query else ""
    concurrent = {"WARC-Target-URI": uri, "WARC-Concurrent-To": f"<urn:uuid:{ids[0]}>"}
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}").encode() + END
    told = {"WARC-Target-URI": uri, "WARC-Payload-Digest": f"sha1:{digest(payload)}"}
    if is_revisit:
        told |= {"WARC-Profile": SAME_PAYLOAD, "WARC-Refers-To-Target-URI":
                 _safe(first_url) if first_url is not None else None}
    told["Content-Type"] = "application/http; msgtype=response"
    return [
        _record("revisit" if is_revisit else "response", ids[0], date, told,
                head if is_revisit else head + payload),
        _record("request", ids[1], date,
                concurrent | {"Content-Type": "application/http; msgtype=request"},
                f"GET {path} HTTP/1.1\r\nHost: {parts.netloc if parts else ''}\r\n\r\n".encode()),
        _record("metadata", ids[2], date, concurrent | {"Content-Type": "application/warc-fields"},
                f"page-id: {page_id}\r\n".encode() if page_id is not None else b"")]


def write(pages: DataFrame, folder: str, least_bytes: int = 0, date: str | None = None,
          id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """The pages as gzip'd WARC files in a new folder, one file per task."""
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        html.alias("html"), F.sha1(html).alias("_sha1"))
    order = F.struct(F.col("page_id").isNull(), "page_id")
    # Stored, so that its size is known: a small one is broadcast and pages stay where they are.
    shared = stored(rows.where(F.octet_length("html") >= least_bytes).groupBy("_sha1").agg(
        F.count("*").alias("_n"), F.min_by(F.struct("page_id", "url"), order).alias("_first"))
        .where("_n > 1").select(F.col("_sha1").alias("_same"), "_first"), "shared")
    dealt = rows.join(shared, F.col("_sha1") == F.col("_same"), "left").select(
        F.col("page_id").cast("string").alias("page_id"), "url", "html",
        F.col("_first.url").alias("first_url"),
        (F.col("_same").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first.page_id"))
         ).alias("is_revisit"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = [batch.column(c).to_pylist() for c in ("page_id", "url")]
        columns.append(batch.column("html").view(pa.binary()).to_pylist())
        columns += [batch.column(c).to_pylist() for c in ("first_url", "is_revisit")]
        records = [r for row in zip(*columns, strict=True) for r in capture(*row, date)]
        return pa.RecordBatch.from_arrays(
            [pa.array(records, pa.binary()).view(pa.string())], ["value"])
    (map_batches(dealt, dealt.columns, "value string", work).write
     .option("lineSep", END.decode()).option("compression", "gzip").text(folder))


class _Pieces:
    """The bytes of one file, from its pieces between double line breaks."""

    def __init__(self) -> None:
        self.buffer = bytearray()
        self.head: dict[str, list[str]] | None = None  # of the record whose block comes next
        self.length = 0                                # of that block

    def add(self, piece: bytes) -> None:
        self.buffer += piece
        self.buffer += END

    def blank(self) -> bool:
        """Whether nothing but line breaks is left over."""
        return self.head is None and not self.buffer.strip(b"\r\n")

    def records(self) -> Iterator[tuple[dict[str, list[str]], bytes]]:
        """Takes whole records (their header and block) out of what has been added."""
        while True:
            if self.head is None:
                # A block that ends with a line break leaves one behind at the end of a file.
                blank = len(self.buffer) - len(self.buffer.lstrip(b"\r\n"))
                end = self.buffer.find(END, blank)
                if end < 0:
                    return
                self.head = _header(bytes(self.buffer[blank:end]))
                self.length = int(self.head["content-length"][-1])
                del self.buffer[:end + len(END)]
            if len(self.buffer) < self.length + len(END):
                return
            if self.buffer[self.length:self.length + len(END)] != END:
                raise ValueError("a record does not end where its header says")
            found = self.head, bytes(self.buffer[:self.length])
            del self.buffer[:self.length + len(END)]
            self.head = None
            yield found


def _header(text: bytes) -> dict[str, list[str]]:
    first, *lines = text.decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("a record does not begin with its version")
    return _fields(lines)


def _fields(lines: list[str]) -> dict[str, list[str]]:
    found: dict[str, list[str]] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if colon:
            found.setdefault(name.strip().lower(), []).append(value.strip())
    if "content-length" in found and not found["content-length"][-1].isdigit():
        raise ValueError("a length is no number")
    return found


def _row(file: str, head: dict[str, list[str]], block: bytes, with_payload: bool) -> dict:
    def last(name: str) -> str | None:
        return head.get(name, [None])[-1]
    kind, content = last("warc-type"), last("content-type") or ""
    label = last("warc-payload-digest")
    row = {"file": file, "type": kind, "record_id": last("warc-record-id"),
           "concurrent_to": head.get("warc-concurrent-to", []),
           "target_uri": last("warc-target-uri"), "date": last("warc-date"),
           "payload_digest": label.removeprefix("sha1:") if label else None}
    if content.startswith("application/http"):
        top, _, payload = block.partition(END)
        first, *lines = top.decode("utf-8", "replace").split("\r\n")
        fields = _fields(lines)
        row["first_line"] = first
    else:
        payload = block
        fields = _fields(block.decode("utf-8", "replace").split("\r\n")) \
            if content.startswith("application/warc-fields") else {}
    if kind == "revisit":
        row["payload_bytes"] = int(fields.get("content-length", ["0"])[-1])
    else:
        row["payload_bytes"] = len(payload)
        if kind == "response":
            own = digest(payload)
            row["intact"] = row["payload_digest"] in (None, own)
            row["payload_digest"] = own
            row["payload"] = payload if with_payload else None
    return row | {"fields": [(k, v[-1]) for k, v in fields.items()]}


def read(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives in a folder, as ``RECORD`` has it.

    A digest given as SHA-1 is compared with the payload (``intact``). A gzip'd file is one task's
    work, whatever its length, and is never held whole; one without compression must fit into one
    split of the reader, which would cut it within a record.
    """
    lines = spark.read.option("lineSep", END.decode()).text(folder).select(
        "value", F.col("_metadata.file_path").alias("file"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, pieces, broken, out = None, _Pieces(), False, []

        def failed(why: str) -> dict:
            return {"file": current, "type": "broken", "first_line": why, "concurrent_to": [],
                    "fields": []}
        for batch in batches:
            values = batch.column("value").view(pa.binary()).to_pylist()
            for value, file in zip(values, batch.column("file").to_pylist(), strict=True):
                if file != current:
                    if not pieces.blank() and not broken:
                        out.append(failed("the last record is cut off"))
                    current, pieces, broken = file, _Pieces(), False
                if broken:
                    continue
                pieces.add(value)
                try:
                    for head, block in pieces.records():
                        out.append(_row(file, head, block, with_payload))
                except (ValueError, KeyError) as error:
                    broken = True
                    out.append(failed(f"{type(error).__name__}: {error}"))
            if out:
                yield pa.RecordBatch.from_pylist(out, _ARROW)
                out = []
        if not pieces.blank() and not broken:
            yield pa.RecordBatch.from_pylist([failed("the last record is cut off")], _ARROW)
    return lines.mapInArrow(work, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per response or revisit, with its ``request`` and ``metadata``.

    Records belong together if either names the other as concurrent. Of several requests, or
    metadata records, of one response the first by id stands.
    """
    is_main = F.col("type").isin("response", "revisit")
    main = records.where(is_main)
    rest = records.where(F.col("type").isin("request", "metadata")).select(
        "type", "concurrent_to", F.struct("record_id", "first_line", "fields").alias("record"))
    named = rest.select("type", "record", F.explode("concurrent_to").alias("capture"))
    naming = main.select(F.col("record_id").alias("capture"),
                         F.explode("concurrent_to").alias("_other"))
    named = named.unionByName(
        rest.join(naming, F.col("record.record_id") == F.col("_other"))
        .select("type", "record", "capture"))

    def first(kind: str) -> Column:
        return F.min_by(F.when(F.col("type") == kind, F.col("record")),
                        F.when(F.col("type") == kind, F.col("record.record_id"))).alias(kind)
    attached = named.groupBy("capture").agg(first("request"), first("metadata"))
    return main.join(attached, main.record_id == attached.capture, "left").select(
        "record_id", F.col("type").alias("record_type"), "target_uri", "date", "payload_digest",
        "payload_bytes", "intact", F.col("first_line").alias("status_line"),
        F.col("fields").alias("http_fields"), "payload", "request", "metadata")


def unattached(records: DataFrame) -> DataFrame:
    """Requests and metadata that name no response or revisit there is, nor are named by one."""
    main = records.where(F.col("type").isin("response", "revisit"))
    rest = records.where(F.col("type").isin("request", "metadata"))
    linked = rest.select("record_id", F.explode("concurrent_to").alias("_id")).join(
        main.select(F.col("record_id").alias("_id")), "_id", "left_semi").select("record_id")
    linked = linked.unionAll(main.select(F.explode("concurrent_to").alias("record_id")))
    return rest.join(linked, "record_id", "left_anti")


def report(found: DataFrame, id_type: str = "bigint") -> DataFrame:
    """Per capture the page, its payload's size and digest, and where a revisit leads: to the page
    whose response has its digest."""
    page = F.col("metadata.fields")["page-id"].cast(id_type)
    rows = found.select(page.alias("page_id"), "payload_bytes", "payload_digest", "record_type")
    firsts = rows.where("record_type = 'response'").groupBy(
        F.col("payload_digest").alias("_digest")).agg(F.min("page_id").alias("_first"))
    is_revisit = F.col("record_type") == "revisit"
    return rows.join(firsts, is_revisit & (F.col("payload_digest") == F.col("_digest")), "left"
                     ).select("page_id", "payload_bytes", "payload_digest", "record_type",
                              F.col("_first").alias("refers_to"))


ORACLE = r"""
with hashed as (select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes,
    sha1(coalesce(html, '')) as hex from pages),
digests as (select page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
    substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((
      (instr('0123456789abcdef', substring(hex, 1 + (5 * i) // 4, 1)) - 1) * 16
      + greatest(instr('0123456789abcdef', substring(hex || '0', 2 + (5 * i) // 4, 1)) - 1, 0))
      >> (3 - (5 * i) % 4)) & 31)::integer, 1)), '') as payload_digest from hashed),
firsts as (select payload_digest, min(page_id) as first from digests group by 1)
select page_id, payload_bytes, d.payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to
from digests d join firsts f on f.payload_digest = d.payload_digest"""

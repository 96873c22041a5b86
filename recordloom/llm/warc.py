"""WARC archives: written with one gzip member per record, read back one record after the other.

The reader inflates piece by piece, takes exactly the bytes that ``Content-Length`` names,
and checks both digests while it reads; it never holds more than one record. Archives are
opened on the executors through ``pyarrow.fs`` and must lie where all executors can reach them.

Files of a task that failed or ran twice do no harm: an archive counts only if the list that
Spark commits at the end names it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import work_table

ARCHIVE_BYTES = 1_000_000_000  # compressed; the next record begins a new file
_CHUNK = 1 << 16
_BATCH_BYTES = 8 << 20
_END = b"\r\n\r\n"
_CONTROLS = re.compile(r"[\x00-\x20\x7f]")
_RECORD = ("record_id string, record_type string, target_uri string, refers_to string, payload binary, payload_bytes long, "
           "payload_digest string, status string")
_RECORD_ARROW = pa.schema([
    *((n, pa.string()) for n in ("record_id", "record_type", "target_uri", "refers_to")), ("payload", pa.binary()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("status", pa.string())])


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _open(path: str) -> tuple[fs.FileSystem, str]:
    local = re.match(r"file:/*(/.*)", path)
    return (fs.LocalFileSystem(), local[1]) if local else fs.FileSystem.from_uri(path)


def record_bytes(
    record_id: str, target_uri: str | None, payload: bytes, date: str, refers_to: str | None = None
) -> bytes:
    """One record, uncompressed: a response with its payload, or a revisit with its HTTP head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to else head + payload
    fields = [
        ("WARC-Type", "revisit" if refers_to else "response"),
        ("WARC-Record-ID", f"<{record_id}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", _CONTROLS.sub(lambda m: f"%{ord(m[0]):02X}", target_uri) if target_uri else None),
        ("WARC-Refers-To", f"<{refers_to}>" if refers_to else None),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if refers_to else None),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + _END


def gzip_member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


@dataclass
class Record:
    """What was read of a record; ``status`` is ``ok``, ``digest`` or the reason why reading ended."""

    fields: dict[str, str] = field(default_factory=dict)
    http_length: int | None = None
    payload: bytes | None = None
    status: str = "ok"


class Members:
    """The inflated bytes of a stream of gzip members, a little at a time, never across a member's end."""

    def __init__(self, stream):
        self.stream, self.raw, self.ready, self.inflate = stream, b"", bytearray(), None

    def begin(self) -> bool:
        """Start at the next member; False at the end of the stream."""
        self.raw = self.raw or self.stream.read(_CHUNK)
        self.inflate, self.ready = zlib.decompressobj(31), bytearray()
        return bool(self.raw)

    def more(self) -> bool:
        """Inflate another piece; False when the member has ended."""
        while not self.inflate.eof:
            self.raw = self.raw or self.stream.read(_CHUNK)
            if not self.raw:
                raise EOFError("truncated")
            piece = self.inflate.decompress(self.raw, _CHUNK)
            self.raw = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            if piece:
                self.ready += piece
                return True
        return False

    def upto(self, mark: bytes) -> bytes:
        """Everything before ``mark``, which is dropped."""
        begin = 0
        while (at := self.ready.find(mark, begin)) < 0:
            begin = max(0, len(self.ready) - len(mark) + 1)
            if not self.more():
                raise ValueError("framing")
        found = bytes(self.ready[:at])
        del self.ready[: at + len(mark)]
        return found

    def take(self, size: int) -> Iterator[bytes]:
        """Exactly ``size`` bytes, in pieces."""
        while size:
            if not self.ready and not self.more():
                raise ValueError("framing")
            piece = bytes(self.ready[:size])
            del self.ready[: len(piece)]
            size -= len(piece)
            yield piece


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("framing")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def read_records(stream) -> Iterator[Record]:
    """The records of an archive in order; after a fault in the framing one row tells it and reading ends."""
    members = Members(stream)
    while True:
        record = Record()
        try:
            if not members.begin():
                return
            record.fields = _fields(members.upto(_END))
            whole, body = hashlib.sha1(), hashlib.sha1()
            block, split = bytearray(), None
            for piece in members.take(int(record.fields["content-length"])):
                whole.update(piece)
                block += piece
                if split is None and (at := block.find(_END, max(0, len(block) - len(piece) - len(_END)))) >= 0:
                    split = at + len(_END)
                    body.update(block[split:])
                elif split is not None:
                    body.update(piece)
            if b"".join(members.take(len(_END))) != _END or members.ready or members.more():
                raise ValueError("framing")
            if split is not None:
                known = re.search(rb"(?im)^content-length:\s*(\d+)", block[:split])
                record.http_length = int(known[1]) if known else None
            revisit = record.fields.get("warc-type") == "revisit"
            record.payload = None if revisit else bytes(block[split or 0 :])
            stated = [("warc-block-digest", whole)] + [("warc-payload-digest", body)] * (not revisit and split is not None)
            for name, digest in stated:
                if name in record.fields and record.fields[name] != "sha1:" + base64.b32encode(digest.digest()).decode():
                    record.status = "digest"
        except (EOFError, ValueError, KeyError, zlib.error) as fault:
            record.status = str(fault) if isinstance(fault, EOFError) else "framing"
            yield record
            return
        yield record


def _writer(folder: str, date: str, archive_bytes: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        store.create_dir(root)
        done, out, size, count, name = [], None, 0, 0, ""
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4()}.warc.gz"
                    out, size, count = store.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                data = gzip_member(record_bytes(row["record_id"], row["target_uri"], row["payload"], date, row["refers_to"]), level)
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= archive_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", count, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["path", "records", "bytes"])

    return run


def write_warc(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    least_revisit_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES, level: int = 6,
) -> DataFrame:
    """Write a record per row of ``pages`` into archives below ``folder`` and return ``path, records, bytes``.

    A text payload is written in UTF-8, null as no bytes. Of rows with equal payloads of
    ``least_revisit_bytes`` or more, that with the largest id is a response, the others are
    revisits that refer to it; rows that repeat the largest id, and groups without any id,
    are responses. A record's id is ``urn:page:`` and the row's; a null id leaves it empty.
    Control characters and spaces in urls are percent-encoded, a null url has no field. Other columns are not
    read. The rows are written when this is called; no rows make no archives.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("target_uri"),
                        payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= least_revisit_bytes
    leaders = rows.where(large).groupBy("digest").agg(F.max("id").alias("leader"), F.count("*").alias("n")).where("n > 1")
    joined = rows.join(leaders.select("digest", "leader"), "digest", "left")
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    refers = F.when(F.col("leader").isNotNull() & ~F.col("id").eqNullSafe(F.col("leader")), urn("leader"))
    records = joined.select(urn("id").alias("record_id"), "target_uri", "payload", refers.alias("refers_to"))
    return work_table(records.mapInArrow(_writer(folder, date, archive_bytes, level), "path string, records long, bytes long"))


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch["path"].to_pylist():
            rows, held = [], 0
            store, name = _open(path)
            with store.open_input_stream(name, compression=None) as stream:
                for r in read_records(stream):
                    get = lambda key: r.fields.get(key, "").strip("<>") or None  # noqa: B023, E731
                    digest = (get("warc-payload-digest") or "").removeprefix("sha1:") or None
                    size = len(r.payload) if r.payload is not None else r.http_length
                    rows.append((get("warc-record-id"), get("warc-type"), get("warc-target-uri"), get("warc-refers-to"),
                                 r.payload, size, digest, r.status))
                    held += len(r.payload or b"")
                    if held >= _BATCH_BYTES or len(rows) >= 1000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _RECORD_ARROW)], schema=_RECORD_ARROW)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _RECORD_ARROW)], schema=_RECORD_ARROW)


def read_warc(archives: DataFrame) -> DataFrame:
    """Every record of the archives that the column ``path`` names, a task for each archive.

    ``payload`` and its ``payload_bytes`` are of the HTTP body; a revisit has no payload, its
    bytes are those that its HTTP head states. ``payload_digest`` is the base32 SHA-1 stated.
    ``status`` is ``ok``; ``digest`` where a digest is not that of the bytes; ``truncated`` or
    ``framing`` in a last row with what was read of a broken record. No archives give no rows.
    """
    paths = archives.select("path")
    return paths.repartition(max(1, paths.count())).mapInArrow(_reader, _RECORD)

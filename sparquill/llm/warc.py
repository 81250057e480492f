"""WARC archives of pages: one gzip member a record, written by tasks and read back sequentially.

Payloads are the pages' html in UTF-8. Of records with equal payloads of at least `least` bytes the one of the smallest
page_id is a response and the others are revisits of it, which hold the HTTP head only; smaller payloads are always
responses. The reader inflates a member piece by piece, takes the block by its Content-Length, and hashes the payload as
it comes; a wrong length, a wrong digest or bytes after a record raise ValueError.

Files carry a random name and only those in the manifest of finished tasks count, so retried tasks do no harm.

Ids may be of any type that Spark casts to text and back; they stand percent-encoded in the records.

Defined results: a null html is an empty payload; a null url gives no target, any other is given back as it was; of rows that share the smallest page_id and
payload all are responses; a null page_id never is the response that others refer to while another has an id, and where
all are null each is a response; an empty table gives no file.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparquill.llm.common import fresh_path, open_fs, stage, text_bytes

LEAST_BYTES, FILE_BYTES, CHUNK, MAX_READERS = 100, 1 << 30, 1 << 16, 20_000
DATE = "1970-01-01T00:00:00Z"
#: A field of records whose target is percent-encoded, since it holds line ends, outer blanks or other unprintable signs.
QUOTED = "Target-URI-Quoted"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: object, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def member(page_id: object, url: str | None, payload: bytes, digest: str, refers_to: object, date: str = DATE) -> bytes:
    """One record as a gzip member."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    revisit = refers_to is not None
    if not revisit:
        block += payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        plain = url.isprintable() and url == url.strip()
        head += [f"WARC-Target-URI: {url}"] if plain else [f"WARC-Target-URI: {quote(url, safe='/:?&=#')}", f"{QUOTED}: yes"]
    if page_id is not None:
        head.append(f"Page-ID: {quote(str(page_id))}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"Refers-To-Page-ID: {quote(str(refers_to))}"]
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + press.flush()


class _Member:
    """The inflated bytes of one gzip member after another."""

    def __init__(self, stream: BinaryIO) -> None:
        self.stream, self.raw, self.data, self.inflate = stream, b"", b"", None

    def next(self) -> bool:
        """Goes to the next member; false at the end of the file."""
        self.raw = self.raw or self.stream.read(CHUNK)
        self.inflate, self.data = zlib.decompressobj(31), b""
        return bool(self.raw)

    def more(self) -> bool:
        """Inflates a piece into data; false at the member's end."""
        while not self.inflate.eof:
            self.raw = self.raw or self.stream.read(CHUNK)
            if not self.raw:
                raise ValueError("the file ends within a record")
            piece = self.inflate.decompress(self.raw, CHUNK)
            self.raw = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            if piece:
                self.data += piece
                return True
        return False

    def head(self) -> list[str]:
        """Lines up to an empty one."""
        while (at := self.data.find(b"\r\n\r\n")) < 0:
            if not self.more():
                raise ValueError("a head without end")
        lines, self.data = self.data[:at].decode().split("\r\n"), self.data[at + 4 :]
        return lines

    def body(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.data and not self.more():
                raise ValueError("a block shorter than its Content-Length")
            piece, self.data = self.data[:n], self.data[n:]
            n -= len(piece)
            yield piece


def _fields(lines: list[str]) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def read_records(stream: BinaryIO, keep_payload: bool = False) -> Iterator[tuple[dict[str, str], int, str, bytes]]:
    """(fields, full payload's bytes, its SHA-256, payload if kept) of each record, checked, in file order."""
    got = _Member(stream)
    while got.next():
        lines = got.head()
        if lines[0] != "WARC/1.1":
            raise ValueError(f"not a WARC record: {lines[0]!r}")
        fields = _fields(lines)
        block, payload, kept, size, seen, http = hashlib.sha256(), hashlib.sha256(), [], 0, 0, b""
        length, in_head = int(fields["content-length"]), True
        for piece in got.body(length):
            block.update(piece)
            if in_head:
                http += piece
                head, end, piece = http.partition(b"\r\n\r\n")
                in_head = not end
                if in_head:
                    continue
                size = int(_fields(head.decode().split("\r\n"))["content-length"])
            payload.update(piece)
            seen += len(piece)
            if keep_payload:
                kept.append(piece)
        while got.more():
            pass
        if got.data != b"\r\n\r\n":
            raise ValueError("a record that does not end with its block")
        if fields["warc-type"] == "response" and seen != size:
            raise ValueError(f"an HTTP Content-Length of {size} before {seen} bytes in {fields['warc-record-id']}")
        claimed = fields["warc-payload-digest"].removeprefix("sha256:")
        if block.hexdigest() != fields["warc-block-digest"].removeprefix("sha256:") or fields["warc-type"] == "response" and payload.hexdigest() != claimed:
            raise ValueError(f"wrong digest in {fields['warc-record-id']}")
        yield fields, size, claimed, b"".join(kept)


def write_archives(pages: DataFrame, least: int = LEAST_BYTES, file_bytes: int = FILE_BYTES, folder: str | None = None) -> DataFrame:
    """Writes one record a row of pages (page_id, url, html); returns the staged manifest (path, n_records, first_id)."""
    folder = folder or fresh_path(pages.sparkSession, "warc")
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", F.sha2("html", 256))
    shared = rows.filter(F.octet_length("html") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null").select("digest", "first")
    shared = stage(shared, "shared")  # as a table of its own, so that a join on a hot payload can be split
    plan = rows.join(shared, "digest", "left").select("page_id", "url", "html", "digest", F.when(F.col("page_id").eqNullSafe(F.col("first")), None).otherwise(F.col("first")).alias("refers_to"))

    kind = rows.schema["page_id"].dataType.simpleString()
    plan = plan.select(F.col("page_id").cast("string").alias("page_id"), "url", "html", "digest", F.col("refers_to").cast("string").alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, size, records, first = None, "", 0, 0, None
        fs, root = open_fs(folder)
        fs.create_dir(root, recursive=True)

        def close() -> pa.RecordBatch:
            out.close()
            fs.move(f"{root}/.{path}", f"{root}/{path}")
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{path}"], "n_records": [records], "first_id": pa.array([first], pa.string())})

        for batch in batches:
            cells = [batch.column(i).to_pylist() for i in (0, 1, 3, 4)]
            for payload, page_id, url, digest, refers_to in zip(text_bytes(batch.column(2)), *cells, strict=True):
                if out is None:
                    path, size, records, first = f"{uuid.uuid4().hex}.warc.gz", 0, 0, page_id
                    out = fs.open_output_stream(f"{root}/.{path}", compression=None)
                data = member(page_id, url, payload, digest, refers_to)
                out.write(data)
                size, records = size + len(data), records + 1
                if size >= file_bytes:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    written = plan.mapInArrow(run, "path string, n_records long, first_id string")
    return stage(written.withColumn("first_id", F.col("first_id").cast(kind)), "archives")


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """A row a record: page_id (of the type it was written with), url, payload_bytes, payload_digest, record_type, refers_to, and the html if asked for
    (null for revisits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, at = open_fs(path)
                with fs.open_input_stream(at, compression=None) as stream:
                    rows: list[tuple] = []
                    held = 0
                    for fields, size, digest, payload in read_records(stream, with_payload):
                        named = lambda k: unquote(fields[k]) if k in fields else None  # noqa: E731, B023
                        kind = fields["warc-type"]
                        url = fields.get("warc-target-uri")
                        rows.append((named("page-id"), unquote(url) if QUOTED.lower() in fields else url, size, digest, kind, named("refers-to-page-id"), payload.decode() if with_payload and kind == "response" else None))
                        held += len(payload)
                        if len(rows) >= 10_000 or held > 1 << 23:
                            yield _batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows)

    schema = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, html string"
    readers = max(1, min(manifest.count(), MAX_READERS))
    out = manifest.select("path").repartition(readers, "path").mapInArrow(run, schema)
    kind = manifest.schema["first_id"].dataType
    out = out.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})
    return out if with_payload else out.drop("html")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"page_id": pa.string(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.string(), "html": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds.values())], list(kinds))

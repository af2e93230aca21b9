"""WARC archives: pages out as records, monolithic gzip files normalised to one member per record, records back in.

A monolithic file is one gzip stream over many records, so nothing in it can be reached without inflating all before
it. The normaliser inflates such a stream once, piece by piece, writes each record as a gzip member of its own, and
puts an index of offsets and lengths beside the archive. Files are written by the tasks, under names of their own, to
the shared folder; only files whose names a finished task returned are read, so a task that is run again does no harm.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftloom.llm.store import map_arrow, shared_folder, small_side, stored

#: Bytes of records in one archive before the next one begins, and bytes read or inflated at once.
ARCHIVE_BYTES, PIECE = 64_000_000, 1 << 20
LEVEL = 6
RECORD = "urn:siftloom:page:"
DATE = "1970-01-01T00:00:00Z"
_GZIP = 31


def _files(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path; ``s3a`` is what Spark calls ``s3``."""
    if "://" not in uri and not uri.startswith("file:"):
        return pa.fs.LocalFileSystem(), uri
    return pa.fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def digest_of(payload: bytes) -> str:
    """SHA-1 in base32, upper case."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(value: str | None) -> str:
    """A header value: control characters are written as in URLs."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value or "")


def record(page_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """A response record, or a revisit of ``refers_to`` whose block has the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{RECORD}{_line(page_id)}>",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {_line(url)}", f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if page_id is None:
        head.append("X-No-Page-ID: true")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <{RECORD}{_line(refers_to)}>"]
    return ("WARC/1.0\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def marked(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Add ``refers_to``: the largest page id with an equal payload of at least ``min_bytes``, unless it is the page's own.

    Equal means equal SHA-1. Null html is an empty payload; null ids are below all others. Rows that share the largest
    id are all responses.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("sha"))
    groups = stored(rows.where(F.octet_length("html") >= min_bytes).groupBy("sha")
                    .agg(F.count("*").alias("n"), F.max("page_id").alias("holder")).where("n > 1").select("sha", "holder"))
    found = rows.join(small_side(groups), "sha", "left")
    own = F.col("page_id").eqNullSafe(F.col("holder")) | F.col("holder").isNull()
    return found.select("page_id", "url", "html", F.when(~own, F.col("holder")).alias("refers_to"))


def write_monolithic(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write the pages (``page_id``, ``url``, ``html``) as records, each archive one gzip stream; returns the archives'
    ``path`` and number of ``records``, stored."""
    rows = marked(pages, min_bytes).select(F.col("page_id").cast("string").alias("page_id"), "url", "html",
                                           F.col("refers_to").cast("string").alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _files(folder)
        files.create_dir(base, recursive=True)
        out = None
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = f"mono-{uuid.uuid4().hex}.warc.gz"
                    out, squeeze, size, n = files.open_output_stream(f"{base}/{name}", compression=None), zlib.compressobj(LEVEL, zlib.DEFLATED, _GZIP), 0, 0
                payload = row["html"].encode()
                one = record(row["page_id"], row["url"], payload, digest_of(payload), row["refers_to"])
                out.write(squeeze.compress(one))
                size, n = size + len(one), n + 1
                if size >= ARCHIVE_BYTES:
                    out.write(squeeze.flush())
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [n]})
        if out is not None:
            out.write(squeeze.flush())
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [n]})

    return stored(map_arrow(rows, run, "path string, records bigint"))


class _Members:
    """Cuts an inflated stream into records and writes each as a gzip member."""

    def __init__(self, out, level: int):
        self.out, self.level, self.at, self.held = out, level, 0, bytearray()
        self.left, self.member, self.start, self.name, self.kind, self.index = 0, None, 0, "", "", []

    def _put(self, data: bytes) -> None:
        self.at += len(data)
        self.out.write(data)

    def feed(self, data: bytes) -> None:
        self.held += data
        while self.held:
            if self.member is None:
                end = self.held.find(b"\r\n\r\n")
                if end < 0:
                    return
                head = bytes(self.held[:end + 4])
                fields = parse_head(head)
                self.name, self.kind = fields.get("warc-record-id", ""), fields.get("warc-type", "")
                self.left = len(head) + int(fields["content-length"]) + 4
                self.member, self.start = zlib.compressobj(self.level, zlib.DEFLATED, _GZIP), self.at
            part = bytes(self.held[:self.left])
            del self.held[:self.left]
            self.left -= len(part)
            self._put(self.member.compress(part))
            if self.left:
                return
            self._put(self.member.flush())
            self.member = None
            self.index.append((self.start, self.at - self.start, self.name, self.kind))


def parse_head(head: bytes) -> dict[str, str]:
    """Header fields of a record, names in lower case."""
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def normalise_stream(source, out, level: int = LEVEL) -> list[tuple[int, int, str, str]]:
    """Inflate ``source`` (binary, one or more members) once; write its records as members; offset, length, id, type of each.

    Neither the stream nor a record is held whole. A stream that ends within a record or member is an error.
    """
    cut, inflate = _Members(out, level), zlib.decompressobj(_GZIP)
    while data := source.read(PIECE):
        while data:
            cut.feed(inflate.decompress(data, PIECE))
            data = inflate.unconsumed_tail
            if inflate.eof:
                data, inflate = inflate.unused_data, zlib.decompressobj(_GZIP)
                fresh = True
            else:
                fresh = False
    if cut.member is not None or cut.held or not fresh:
        raise ValueError("the stream ends within a record")
    return cut.index


def normalise(archives: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """Rewrite each archive (column ``path``) to ``folder`` with one member per record, and an index ``.idx`` beside it:
    a JSON line with offset, length, id and type per record. Returns ``archive``, ``records``, stored.

    One archive is one task, as its stream has no entry points; archives are spread evenly. No archives, no rows.
    """
    n = max(1, min(archives.count(), 100_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _files(folder)
        files.create_dir(base, recursive=True)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                name = f"norm-{uuid.uuid4().hex}.warc.gz"
                before, inner = _files(path)
                with before.open_input_stream(inner, compression=None) as source, files.open_output_stream(f"{base}/{name}", compression=None) as out:
                    index = normalise_stream(source, out, level)
                with files.open_output_stream(f"{base}/{name}.idx", compression=None) as out:
                    for offset, length, record_id, kind in index:
                        out.write((json.dumps({"offset": offset, "length": length, "id": record_id, "type": kind}) + "\n").encode())
                yield pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}"], "records": [len(index)]})

    return stored(map_arrow(archives.select("path").repartition(n), run, "archive string, records bigint"))


def _page(name: str, fields: dict[str, str]) -> str | None:
    value = fields.get(name)
    return None if value is None or "x-no-page-id" in fields and name == "warc-record-id" else value.strip("<>")[len(RECORD):]


def read_records(archives: DataFrame) -> DataFrame:
    """Records of normalised archives (column ``archive``) by their index: ``page_id``, ``url``, ``record_type``,
    ``refers_to``, ``payload_bytes``, ``payload_digest``, ``payload`` (null for revisits). A payload that does not have
    the digest of its header is an error."""
    n = max(1, min(archives.count(), 100_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
        kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, inner = _files(path)
                with files.open_input_stream(f"{inner}.idx", compression=None) as source:
                    index = [json.loads(x) for x in source.read().decode().splitlines()]
                rows, size = [], 0
                with files.open_input_file(inner) as source:
                    for entry in index:
                        source.seek(entry["offset"])
                        raw = zlib.decompress(source.read(entry["length"]), _GZIP)
                        head, _, rest = raw.partition(b"\r\n\r\n")
                        fields = parse_head(head)
                        http, _, payload = rest[:int(fields["content-length"])].partition(b"\r\n\r\n")
                        length = int(http.decode().lower().partition("content-length:")[2].split("\r\n")[0])
                        digest = fields["warc-payload-digest"].removeprefix("sha1:")
                        own = fields["warc-type"] == "response"
                        if own and (digest_of(payload) != digest or len(payload) != length):
                            raise ValueError(f"{path} at {entry['offset']}: payload and digest differ")
                        rows.append((_page("warc-record-id", fields), fields["warc-target-uri"], fields["warc-type"],
                                     _page("warc-refers-to", fields), length, digest, payload if own else None))
                        size += len(raw)
                        if size > PIECE * 8:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    shape = "page_id string, url string, record_type string, refers_to string, payload_bytes bigint, payload_digest string, payload binary"
    return map_arrow(archives.select("archive").repartition(n), run, shape)


def through_archives(spark: SparkSession, pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write pages as monolithic archives, normalise these, and read the records back (see :func:`read_records`).

    One record per row of ``pages``; repeated rows give repeated records, extra columns are not read, an empty table
    gives no rows. Without ``folder`` the archives go to the session's shared folder.
    """
    folder = folder or shared_folder(spark)
    return read_records(normalise(write_monolithic(pages, f"{folder}/monolithic", min_bytes), f"{folder}/normalised"))

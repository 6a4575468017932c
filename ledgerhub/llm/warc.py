"""WARC archives: one gzip member per record, written by tasks and read back sequentially.

Every task writes archives of its own under unused names; the manifest of finished archives
is a stored table, so an archive that a lost task left unfinished is never read. The reader
inflates piece by piece, frames each record by its content length and verifies its digests.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerhub.llm.common import run_folder, written_once

#: Payloads below this many bytes are always stored, never referred to.
LEAST_SHARED_BYTES = 1000
ARCHIVE_BYTES = 256 << 20
PIECE = 1 << 16
#: Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_PREFIX = "urn:x-page:"

MANIFEST = "archive string, records long, archive_bytes long"
RECORD = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("payload", pa.binary()), ("problem", pa.string()),
])
RECORD_DDL = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, payload binary, problem string"
)


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a folder or file named by URI or plain path, and its path there."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def base32_sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def page_urn(page_id: int | None) -> str:
    return f"<{RECORD_PREFIX}{'' if page_id is None else page_id}>"


def page_of(urn: str | None) -> int | None:
    number = (urn or "").strip("<>").removeprefix(RECORD_PREFIX)
    return int(number) if number.lstrip("-").isdigit() else None


def record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str
) -> bytes:
    """One gzip member: a response with its payload, or a revisit that names the response."""
    revisit = refers_to is not None
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", page_urn(page_id)),
        ("WARC-Date", date),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", page_urn(refers_to))]
    fields += [
        ("WARC-Payload-Digest", base32_sha1(payload)),
        ("WARC-Block-Digest", base32_sha1(block)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields) + b"\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def fields_of(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name, without the first line."""
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs if name}


class Members:
    """Bytes of an archive, inflated piece by piece; ``next_member`` moves to the next gzip member."""

    def __init__(self, source: BinaryIO):
        self.source, self.raw, self.ready = source, b"", bytearray()
        self.unpack = None

    def next_member(self) -> bool:
        self.raw = self.raw or self.source.read(PIECE)
        self.unpack, self.ready = zlib.decompressobj(31), bytearray()
        return bool(self.raw)

    def more(self) -> bool:
        """Inflate another piece of the member; False at its end."""
        if self.unpack.eof:
            return False
        self.raw = self.raw or self.source.read(PIECE)
        if not self.raw:
            raise ValueError("archive ends inside a record")
        self.ready += self.unpack.decompress(self.raw, PIECE)
        self.raw = self.unpack.unused_data if self.unpack.eof else self.unpack.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes:
        start = 0
        while (at := self.ready.find(mark, start)) < 0:
            start = max(0, len(self.ready) - len(mark) + 1)
            if not self.more():
                raise ValueError("record without end of header")
        head = bytes(self.ready[:at])
        del self.ready[:at + len(mark)]
        return head

    def exactly(self, size: int) -> bytes:
        while len(self.ready) < size:
            if not self.more():
                raise ValueError("record shorter than its content length")
        data = bytes(self.ready[:size])
        del self.ready[:size]
        return data

    def finish(self) -> None:
        while self.more():
            pass


def one_record(members: Members) -> dict:
    head = members.until(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = fields_of(head)
    block = members.exactly(int(fields["content-length"]))
    tail = members.exactly(4)
    members.finish()
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields.get("warc-type")
    wanted = fields.get("warc-payload-digest", "")
    problem = None
    if tail != b"\r\n\r\n" or members.ready:
        problem = "record does not end after its content length"
    elif fields.get("warc-block-digest") != base32_sha1(block):
        problem = "block digest differs"
    elif kind != "revisit" and wanted != base32_sha1(payload):
        problem = "payload digest differs"
    length = int(fields_of(http).get("content-length", len(payload)))
    return {
        "page_id": page_of(fields.get("warc-record-id")),
        "url": fields.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": page_of(fields.get("warc-refers-to")),
        "payload_bytes": length if kind == "revisit" else len(payload),
        "payload_digest": base64.b32decode(wanted.removeprefix("sha1:")).hex() if wanted else None,
        "payload": None if kind == "revisit" else payload,
        "problem": problem,
    }


def records(source: BinaryIO) -> Iterator[dict]:
    """Records in order; what can't be read ends the archive with one row that says why."""
    members = Members(source)
    while members.next_member():
        try:
            yield one_record(members)
        except (ValueError, KeyError, zlib.error) as error:
            yield dict.fromkeys(RECORD.names) | {"problem": f"unreadable: {error}"}
            return


def with_responses(pages: DataFrame) -> DataFrame:
    """``pages`` with ``refers_to``: the largest page_id with an equal payload, null for that page itself.

    Only page ids and digests are grouped; the groups of two and more are stored, and pages meet
    them in one join, which Spark makes a broadcast when their files are small and splits at a
    hot digest otherwise.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    keyed = pages.drop("refers_to", "digest_", "size_").withColumns(
        {"digest_": F.sha1(payload), "size_": F.octet_length(payload)}
    )
    groups = written_once(
        keyed.where(F.col("size_") >= LEAST_SHARED_BYTES)
        .groupBy("digest_", "size_")
        .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n_"))
        .where("n_ > 1 and refers_to is not null").drop("n_"),
        "warc-groups",
    )
    other = ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return keyed.join(groups, ["digest_", "size_"], "left").withColumn(
        "refers_to", F.when(other, F.col("refers_to"))
    ).drop("digest_", "size_")


def write_archives(
    pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Writes a record per row of (page_id, url, html) below ``folder``; the stored manifest.

    A null html is an empty payload, a null url gives no target field, a null page_id an empty
    record id. Repeated rows give a record each. Of equal payloads of LEAST_SHARED_BYTES and more
    that with the largest page_id is the response (all of them, if rows repeat it), others are
    revisits. Other columns are left out. An empty frame gives no archive.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = opened(folder)
        out, name, count = None, "", 0

        def done() -> pa.RecordBatch:
            size = out.tell()
            out.close()
            return pa.RecordBatch.from_pylist(
                [{"archive": name, "records": count, "archive_bytes": size}],
                pa.schema([("archive", pa.string()), ("records", pa.int64()), ("archive_bytes", pa.int64())]),
            )

        for batch in batches:
            for page_id, url, html, refers_to in zip(*batch.columns, strict=True):
                if out is None:
                    name, count = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                    store.create_dir(place, recursive=True)
                    out = store.open_output_stream(
                        f"{place}/{name.rpartition('/')[2]}", compression=None
                    )
                payload = (html.as_py() or "").encode()
                out.write(record(page_id.as_py(), url.as_py(), payload, refers_to.as_py(), date))
                count += 1
                if out.tell() >= archive_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    wanted = with_responses(pages.select(F.col("page_id").cast("long"), "url", "html"))
    return written_once(
        wanted.select("page_id", "url", "html", "refers_to").mapInArrow(write, MANIFEST), "warc-manifest"
    )


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """All records of the archives a manifest names, each archive read once from start to end.

    ``problem`` is null for sound records. Payloads can be left out, they are verified all the same.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                store, path = opened(name)
                rows: list[dict] = []
                held = 0
                with store.open_input_stream(path, compression=None) as source:
                    for row in records(source):
                        if not with_payload:
                            row["payload"] = None
                        rows.append(row)
                        held += len(row["payload"] or b"") + 200
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, RECORD)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, RECORD)

    archives = manifest.select("archive")
    spread = archives.repartition(max(1, min(10_000, manifest.count())))
    return spread.mapInArrow(read, RECORD_DDL)


def archived(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Records of ``pages``, written to the shared folder and read back."""
    manifest = write_archives(pages, run_folder(spark, "warc"))
    return read_archives(manifest, with_payload=False)

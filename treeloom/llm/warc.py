"""Web archives of one Zstandard frame per record.

An archive starts with a skippable frame that holds the dictionary its other frames need (an
empty one means none). Each further frame is one WARC/1.1 record. Archives are written and
read by tasks, record by record, on any file system that Arrow opens by its address; a task
holds one record, and while it writes up to SAMPLE bytes that train the dictionary.

The list of archives is the writer's result, so what a failed or repeated task has left is
never read.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeloom.session import stage, staging_path

#: Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
VERSION = b"WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payloads of fewer bytes are always stored.
REVISIT_BYTES = 1000
ARCHIVE_BYTES = 256 << 20
SAMPLE = 1 << 20
DICTIONARY_BYTES = 32 << 10
LEVEL = 3
READ_BYTES = 32 << 10
DATE = "1970-01-01T00:00:00Z"

_ID = re.compile(r"<urn:x-page:(-?\d+)>\Z")
_RECORD = (
    "page_id long, record_type string, refers_to long, target_uri string, payload_bytes long, "
    "payload_digest string, payload binary, error string"
)
_RECORD_SCHEMA = pa.schema(
    [("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("target_uri", pa.string()),
     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("error", pa.string())]
)


def _open(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path)


def record(row: dict) -> bytes:
    """One WARC record: an HTTP response, or a revisit that has only its head."""
    payload = row["payload"] or b""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n"
    block = head.encode() + (payload if row["record_type"] == "response" else b"")
    fields = [("WARC-Type", row["record_type"])]
    if row["page_id"] is not None:
        fields.append(("WARC-Record-ID", f"<urn:x-page:{row['page_id']}>"))
    else:
        fields.append(("WARC-Record-ID", f"<{uuid.uuid4().urn}>"))
    fields.append(("WARC-Date", DATE))
    if row["url"] is not None:
        # A header ends at the line's end, so control characters of a URL are percent-encoded.
        url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", row["url"])
        fields.append(("WARC-Target-URI", url))
    fields.append(("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"))
    if row["refers_to"] is not None:
        fields += [("WARC-Refers-To", f"<urn:x-page:{row['refers_to']}>"), ("WARC-Profile", REVISIT)]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8", "replace")
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def _dictionary(samples: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:  # too few or too small records to learn from
        return b""


class ArchiveWriter:
    """Writes records to one archive; the dictionary is trained on the first ones."""

    def __init__(self, path: str):
        self.path, self.held, self.size, self.records = path, [], 0, 0
        system, at = _open(path)
        system.create_dir(at.rpartition("/")[0], recursive=True)
        self.out = system.open_output_stream(at, compression=None)
        self.compressor = None

    def add(self, data: bytes) -> None:
        self.size += len(data)
        self.records += 1
        if self.compressor:
            self.out.write(self.compressor.compress(data))
            return
        self.held.append(data)
        if self.size >= SAMPLE:
            self._begin()

    def _begin(self) -> None:
        dictionary = _dictionary(self.held)
        self.out.write(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)
        learned = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=learned, write_checksum=True)
        held, self.held = self.held, []
        for data in held:
            self.out.write(self.compressor.compress(data))

    def close(self) -> None:
        if not self.compressor:
            self._begin()
        self.out.close()


def frames(stream) -> Iterator[bytes]:
    """The content of each frame of an archive, by the dictionary of its leading frame."""
    head = stream.read(8)
    if not head:
        return
    if len(head) < 8 or struct.unpack("<I", head[:4])[0] != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame at the start")
    size = struct.unpack("<I", head[4:])[0]
    dictionary = stream.read(size)
    if len(dictionary) != size:
        raise ValueError("the dictionary frame is cut off")
    if dictionary[:4] == b"\x28\xb5\x2f\xfd":  # a dictionary may itself be compressed
        dictionary = zstandard.ZstdDecompressor().decompress(dictionary, max_output_size=1 << 30)
    learned = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    decompressor = zstandard.ZstdDecompressor(dict_data=learned)
    data = stream.read(READ_BYTES)
    while data:
        frame, parts = decompressor.decompressobj(), []
        while True:
            parts.append(frame.decompress(data))
            data = frame.unused_data
            if frame.eof:
                break
            data = stream.read(READ_BYTES)
            if not data:
                raise ValueError("the last frame is cut off")
        data = data or stream.read(READ_BYTES)
        yield b"".join(parts)


def parse(data: bytes) -> dict:
    """The parts of a record; raises ValueError where a header or a length is not as it must be."""
    head, found, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not found or not re.fullmatch(rb"WARC/1\.[01]", version):
        raise ValueError("not a WARC record")
    fields = {}
    for line in lines:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"not a header: {line[:80]!r}")
        fields[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"no {name}")
    if not fields["content-length"].isdecimal():
        raise ValueError("the content length is no number")
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"the block has {len(rest) - 4} bytes, not {size}")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    length = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
    if not length:
        raise ValueError("the response has no length")
    kind, digest = fields["warc-type"], fields.get("warc-payload-digest", "")
    if not digest.startswith("sha1:"):
        raise ValueError("no SHA-1 digest")
    digest = digest[5:].lower()
    page, refers = _ID.match(fields["warc-record-id"]), _ID.match(fields.get("warc-refers-to", ""))
    if kind == "response":
        if len(payload) != int(length[1]) or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError("the payload differs from its length or digest")
    elif kind == "revisit":
        if not refers or payload:
            raise ValueError("a revisit must name another record and have no payload")
    else:
        raise ValueError(f"unknown type {kind[:40]!r}")
    return {
        "page_id": int(page[1]) if page else None, "record_type": kind,
        "refers_to": int(refers[1]) if refers else None, "target_uri": fields.get("warc-target-uri"),
        "payload_bytes": int(length[1]), "payload_digest": digest,
        "payload": payload if kind == "response" else None, "error": None,
    }


def as_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to`` for each row.

    The payload is the text in UTF-8, empty for null. Of rows with equal payloads of at least
    REVISIT_BYTES bytes, those with the largest id are responses and the others revisit it. Rows
    without an id are always responses. Repeated rows are records of their own.
    """
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    rows = rows.withColumns({"payload_bytes": F.length("payload").cast("long"), "payload_digest": F.sha1("payload")})
    large = rows.filter(f"payload_bytes >= {REVISIT_BYTES} and page_id is not null")
    last = large.groupBy("payload_digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
    rows = rows.join(last.filter("n > 1").drop("n"), "payload_digest", "left")
    refers = F.when(F.col("page_id") < F.col("last"), F.col("last"))
    return rows.withColumn("refers_to", refers).select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(refers.isNull(), "response").otherwise("revisit").alias("record_type"), "refers_to",
    )


def write(records: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the records of ``as_records``; ``path, records, bytes`` of each archive.

    Without a folder they go to one of their own in the shared folder of the session.
    """
    folder = folder or staging_path(records.sparkSession, "warc")

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None

        def close() -> pa.RecordBatch:
            writer.close()
            return pa.record_batch([[writer.path], [writer.records], [writer.size]], names=["path", "records", "bytes"])

        for batch in batches:
            for row in batch.to_pylist():
                writer = writer or ArchiveWriter(f"{folder}/{uuid.uuid4().hex}.warc.zst")
                writer.add(record(row))
                if writer.size >= ARCHIVE_BYTES:
                    yield close()
                    writer = None
        if writer:
            yield close()

    return stage(records.mapInArrow(archives, "path string, records long, bytes long"), "warc-list")


def read(archives: DataFrame, payload: bool = True, strict: bool = True) -> DataFrame:
    """The records of the archives named by the column ``path``.

    page_id, record_type, refers_to, target_uri, payload_bytes and payload_digest (both of the
    full payload), payload (null for revisits, or throughout if not asked for) and error. A
    record that is not valid stops a strict read; otherwise it is a row with only an error, and
    an archive that cannot be read on ends with such a row.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for found in _records(path, strict):
                    size += len(found.get("payload") or b"")
                    rows.append(found if payload else found | {"payload": None})
                    if len(rows) >= 5000 or size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, _RECORD_SCHEMA)
                        rows, size = [], 0
        yield pa.RecordBatch.from_pylist(rows, _RECORD_SCHEMA)

    # An archive is the unit of reading, so each has a task of its own as far as there are tasks.
    paths = archives.select("path")
    n = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return paths.repartition(n, "path").mapInArrow(records, _RECORD)


def _records(path: str, strict: bool) -> Iterator[dict]:
    system, at = _open(path)
    with system.open_input_stream(at, compression=None) as stream:
        try:
            for data in frames(stream):
                try:
                    yield parse(data)
                except ValueError as e:
                    if strict:
                        raise
                    yield {"error": str(e)}
        except (ValueError, zstandard.ZstdError) as e:
            if strict:
                raise ValueError(f"{path}: {e}") from e
            yield {"error": str(e)}

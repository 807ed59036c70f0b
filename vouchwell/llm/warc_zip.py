"""WARC records in ZIP-packaged archives: a writer and a range reader.

Every writing task makes archives of its own in the shared folder. An archive is a ZIP file
with two stored (uncompressed) members, the records and their index:

    archive/data.warc.gz    one gzip member per record
    indexes/index.jsonl     one JSON line per record: offset and length in the data member

The reader parses the end record, the ZIP64 end record and the central directory, finds the
members by their local headers, and reads records by byte ranges, so that one large archive
is read by many tasks and nothing is extracted. Files are opened through ``pyarrow.fs`` by
the URI of the shared folder.

Defined results: null html is an empty payload; of records with equal payloads of at least
``min_bytes`` bytes that with the largest page_id is the response, the others are revisits
that refer to it; rows that repeat both page_id and payload have equal types; rows whose
page_id is null are responses if their whole group has none; null url: no target header;
an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouchwell.storage import materialize, shared_folder

DATA, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"
ARCHIVE_BYTES = 256 << 20
RANGE_BYTES = 8 << 20
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, refers_to: the page whose response a revisit refers to."""
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("key", F.when(F.length("payload") >= min_bytes, F.sha2("payload", 256)))
    several = rows.groupBy("key").agg(F.max("page_id").alias("lead"), F.count("*").alias("n")).where("n > 1")
    joined = rows.join(several.select("key", "lead"), "key", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("lead")), F.col("lead"))
    return joined.select("page_id", "url", "payload", refers.alias("refers_to"))


def _record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    revisit = refers_to is not None
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(c if c >= " " else f"%{ord(c):02X}" for c in url)))
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("X-Refers-To-Page-Id", str(refers_to)),
        ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


class _Stream(io.RawIOBase):
    """A write-only file that zipfile takes as one without seek."""

    def __init__(self, out: pa.NativeFile) -> None:
        self._out = out

    def writable(self) -> bool:
        return True

    def write(self, data: bytes) -> int:
        self._out.write(data)
        return len(data)


class _Archive:
    def __init__(self, uri: str) -> None:
        self.uri, self.records, self.size, self._index = uri, 0, 0, []
        system, path = fs.FileSystem.from_uri(uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self._file = system.open_output_stream(path)
        self._zip = zipfile.ZipFile(_Stream(self._file), "w", zipfile.ZIP_STORED, allowZip64=True)
        self._data = self._zip.open(DATA, "w", force_zip64=True)

    def add(self, page_id: int | None, record: bytes) -> None:
        pack = zlib.compressobj(3, zlib.DEFLATED, 31)
        packed = pack.compress(record) + pack.flush()
        self._data.write(packed)
        self._index.append(json.dumps({"page_id": page_id, "offset": self.size, "length": len(packed)}))
        self.size += len(packed)
        self.records += 1

    def close(self) -> dict:
        self._data.close()
        with self._zip.open(INDEX, "w", force_zip64=True) as index:
            index.write("".join(f"{line}\n" for line in self._index).encode())
        self._zip.close()
        self._file.close()
        return {"path": self.uri, "records": self.records, "bytes": self.size}


def write(
    pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "2025-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write one record per row of ``pages``; returns the written list of archives (path, records, bytes)."""

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, now = [], None
        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(c for c in batch.columns), strict=True):
                now = now or _Archive(f"{folder}/{uuid.uuid4().hex}.wacz")
                page = page_id.as_py()
                now.add(page, _record(page, url.as_py(), payload.as_py(), refers_to.as_py(), date))
                if now.size >= archive_bytes:
                    made.append(now.close())
                    now = None
        if now:
            made.append(now.close())
        if made:
            yield pa.RecordBatch.from_pylist(made)

    rows = with_revisits(pages, min_bytes).mapInArrow(archives, "path string, records long, bytes long")
    # Only archives of tasks that ended well are in the list; files of lost tasks are never read.
    return materialize(rows, "archives")


def members(file: pa.NativeFile) -> dict[str, tuple[int, int]]:
    """Name -> (offset, size) of the stored members of a ZIP or ZIP64 file."""

    def at(offset: int, size: int) -> bytes:
        file.seek(offset)
        return file.read(size)

    size = file.size()
    tail = at(max(0, size - 65_557), min(size, 65_557))
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<10xHLL", tail, end)[:3]
    locator = tail[end - 20 : end] if end >= 20 else b""
    if locator[:4] == b"PK\x06\x07":
        (place,) = struct.unpack_from("<8xQ", locator)
        count, length, start = struct.unpack_from("<32xQQQ", at(place, 56))
    directory, found, pos = at(start, length), {}, 0
    for _ in range(count):
        if directory[pos : pos + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method, packed, whole = struct.unpack_from("<10xH8xLL", directory, pos)
        n_name, n_extra, n_comment = struct.unpack_from("<28xHHH", directory, pos)
        (offset,) = struct.unpack_from("<42xL", directory, pos)
        name = directory[pos + 46 : pos + 46 + n_name].decode()
        extra, more = directory[pos + 46 + n_name : pos + 46 + n_name + n_extra], 0
        while more + 4 <= len(extra):
            tag, held = struct.unpack_from("<HH", extra, more)
            if tag == 1:  # the 64-bit values of those fields that are all ones, in this order
                wide = list(struct.unpack_from(f"<{held // 8}Q", extra, more + 4))
                whole = wide.pop(0) if whole == 0xFFFFFFFF else whole
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                offset = wide.pop(0) if offset == 0xFFFFFFFF else offset
            more += 4 + held
        if method == zipfile.ZIP_STORED:
            local = at(offset, 30)
            if local[:4] != b"PK\x03\x04":
                raise ValueError("broken local header")
            found[name] = (offset + 30 + sum(struct.unpack_from("<26xHH", local)), whole)
        pos += 46 + n_name + n_extra + n_comment
    return found


def _parsed(record: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    return fields, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


def read(archives: DataFrame, payloads: bool = False, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per record of the listed archives; with ``payloads`` also url and the record's own payload."""

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                system, path = fs.FileSystem.from_uri(uri)
                with system.open_input_file(path) as file:
                    found = members(file)
                    start, size = found[INDEX]
                    file.seek(start)
                    lines = file.read(size).splitlines()
                base, held, out = found[DATA][0], [0, 0], []
                for line in map(json.loads, lines):
                    if held[1] and held[1] + line["length"] > range_bytes:
                        out.append((uri, base + held[0], held[1]))
                        held = [line["offset"], 0]
                    held[1] += line["length"]
                if held[1]:
                    out.append((uri, base + held[0], held[1]))
                names = ("path", "start", "length")
                yield pa.RecordBatch.from_pylist([dict(zip(names, x, strict=True)) for x in out])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                system, path = fs.FileSystem.from_uri(part["path"])
                with system.open_input_file(path) as file:
                    file.seek(part["start"])
                    data = file.read(part["length"])
                out = []
                while data:
                    unpack = zlib.decompressobj(31)
                    fields, http, payload = _parsed(unpack.decompress(data) + unpack.flush())
                    data = unpack.unused_data
                    said = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind = fields["WARC-Type"]
                    if kind == "response" and digest(payload) != said:
                        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
                    numbers = [fields.get("X-Page-Id"), http["Content-Length"], fields.get("X-Refers-To-Page-Id")]
                    page, size, refers = (None if x is None else int(x) for x in numbers)
                    row = {"page_id": page, "payload_bytes": size, "payload_digest": said, "record_type": kind, "refers_to": refers}
                    out.append(row | ({"url": fields.get("WARC-Target-URI"), "payload": payload} if payloads else {}))
                yield pa.RecordBatch.from_pylist(out, schema=types)

    types = pa.schema(
        [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
         ("record_type", pa.string()), ("refers_to", pa.int64())]
        + ([("url", pa.string()), ("payload", pa.binary())] if payloads else [])
    )
    found = archives.select("path").mapInArrow(ranges, "path string, start long, length long")
    parts = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return found.repartition(parts).mapInArrow(records, RECORDS + (", url string, payload binary" if payloads else ""))


def archive_folder(pages: DataFrame) -> str:
    """A new folder of the shared place, as a URI that pyarrow opens."""
    folder = shared_folder(pages.sparkSession)
    return f"{folder if '://' in folder else f'file://{folder}'}/{uuid.uuid4().hex}/warc".replace("file:////", "file:///")

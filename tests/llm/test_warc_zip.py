import gzip
import io
import zipfile

import pyarrow as pa
import pytest

from vouchwell.llm import warc_zip


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(n, f"http://a.example/{n}", f"<p>{n % 7}</p>") for n in range(60)]
    rows += [(100, None, None), (101, "http://b\r\nx: y", ""), (102, "u", "é\r\n\r\n" * 50_000), (103, "u", "\0\x01"), (None, "n", "only null"), (None, "n", "<p>3</p>")]
    return spark.createDataFrame([(*r, "clash", 5) for r in rows], "page_id long, url string, html string, key string, n int"), rows


def test_round_trip_of_records(pages):
    frame, rows = pages
    archives = warc_zip.write(frame, warc_zip.archive_folder(frame), archive_bytes=2_000)
    assert archives.count() > 1
    found = warc_zip.read(archives, payloads=True, range_bytes=700).collect()
    groups = {}
    for i, _, html in rows:
        groups.setdefault(html or "", []).append(i)
    lead = {h: max((i for i in ids if i is not None), default=None) for h, ids in groups.items()}
    expected = []
    for i, _, html in rows:
        payload = (html or "").encode()
        refers = lead[html or ""] if lead[html or ""] != i else None
        expected.append((i, len(payload), warc_zip.digest(payload), "revisit" if refers is not None else "response", refers))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=key) == sorted(expected, key=key)
    own = {r.page_id: bytes(r.payload) for r in found if r.record_type == "response"}
    assert own[102] == ("é\r\n\r\n" * 50_000).encode() and own[103] == b"\0\x01"


def test_small_payloads_are_all_responses(pages):
    frame, _ = pages
    archives = warc_zip.write(frame, warc_zip.archive_folder(frame), min_bytes=9)
    assert {r.record_type for r in warc_zip.read(archives).where("payload_bytes < 9").collect()} == {"response"}


def test_archives_open_with_the_standard_library(pages):
    frame, rows = pages
    (path,) = {r.path for r in warc_zip.write(frame.coalesce(1), warc_zip.archive_folder(frame)).collect()[:1]}
    with zipfile.ZipFile(path.removeprefix("file://")) as archive:
        assert {i.compress_type for i in archive.infolist()} == {zipfile.ZIP_STORED}
        text = gzip.decompress(archive.read(warc_zip.DATA))
    assert text.startswith(b"WARC/1.1\r\n") and b"WARC-Type: r" in text


def test_directories_of_zip64_files(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
        for name, size in ((warc_zip.DATA, 3_000), (warc_zip.INDEX, 50), ("other", 7)):
            with archive.open(name, "w", force_zip64=True) as member:
                member.write(name[:1].encode() * size)
    data = out.getvalue()
    assert b"PK\x06\x06" in data and b"PK\x06\x07" in data
    found = warc_zip.members(pa.BufferReader(data))
    assert {k: data[a : a + n] for k, (a, n) in found.items()} == {warc_zip.DATA: b"a" * 3_000, warc_zip.INDEX: b"i" * 50, "other": b"o" * 7}
    with pytest.raises(ValueError, match="central directory"):
        warc_zip.members(pa.BufferReader(b"no archive"))


def test_empty_table(pages):
    frame, _ = pages
    assert warc_zip.read(warc_zip.write(frame.where("false"), warc_zip.archive_folder(frame))).count() == 0

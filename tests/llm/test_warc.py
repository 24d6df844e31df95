import hashlib
import io
import struct

import pytest

from treeloom.llm import warc

PAGES = "page_id long, url string, html string, payload string, last long"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES)


def test_round_trip_and_revisits(spark):
    long = "é" * 600
    rows = [
        (1, "http://a/x", long), (2, "http://b", long), (3, None, long), (4, "u\r\nv", "s" * 999), (5, "u", "s" * 999),
        (6, "u", None), (7, "u", ""), (None, "u", long), (3, None, long), (8, "u", "z" * 1000), (9, "u", "\r\n\r\nWARC/1.1\r\n"),
    ]
    got = warc.read(warc.write(warc.as_records(pages(spark, rows).repartition(3)))).collect()
    assert len(got) == len(rows) and not any(r.error for r in got)
    seen = sorted((str(r.page_id), r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in got)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        again = html == long and i in (1, 2)
        want.append((str(i), "revisit" if again else "response", 3 if again else None, len(data), hashlib.sha1(data).hexdigest()))
    assert seen == sorted(want, key=lambda x: (x[0], x[1], str(x[2])))
    assert {r.payload.decode() for r in got if r.payload is not None} == {h or "" for _, _, h in rows}
    assert {r.target_uri for r in got if r.page_id == 4} == {"u%0D%0Av"}


def test_empty_table(spark):
    assert warc.read(warc.write(warc.as_records(pages(spark, [])))).count() == 0


def archive(tmp_path, records):
    path = str(tmp_path / "a.warc.zst")
    writer = warc.ArchiveWriter(path)
    for data in records:
        writer.add(data)
    writer.close()
    return path


def row(i, payload=b"body"):
    return {
        "page_id": i, "url": "u", "payload": payload, "payload_bytes": len(payload), "refers_to": None,
        "payload_digest": hashlib.sha1(payload).hexdigest(), "record_type": "response",
    }


def test_dictionary_and_frames(tmp_path):
    records = [warc.record(row(i, f"<p>page {i} of many</p>".encode() * 40)) for i in range(3000)]
    path = archive(tmp_path, records)
    data = open(path, "rb").read()
    assert struct.unpack("<I", data[:4])[0] == warc.DICTIONARY_MAGIC and struct.unpack("<I", data[4:8])[0] > 0
    assert list(warc.frames(io.BytesIO(data))) == records
    with pytest.raises(ValueError, match="cut off"):
        list(warc.frames(io.BytesIO(data[:-5])))
    with pytest.raises(ValueError, match="no dictionary"):
        list(warc.frames(io.BytesIO(data[8:])))


@pytest.mark.parametrize(
    "old, new",
    [(b"Content-Length: 4\r", b"Content-Length: 5\r"), (b"sha1:", b"sha1:0"), (b"WARC-Date", b"WARC-Dat"),
     (b"WARC/1.1", b"WARC/9.1"), (b"\r\n\r\n", b"\r\n\r"), (b"Type: response", b"Type: other")],
)
def test_invalid_records_are_told(spark, tmp_path, old, new):
    good = warc.record(row(1))
    path = archive(tmp_path, [good.replace(old, new, 1), good])
    paths = spark.createDataFrame([(path,)], "path string")
    found = warc.read(paths, strict=False).collect()
    assert [r.error is None for r in found] == [False, True] and found[1].payload == b"body"
    with pytest.raises(Exception, match="a.warc.zst"):
        warc.read(paths).collect()

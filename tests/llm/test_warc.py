import gzip
import hashlib

import pytest

from accesslens import session
from accesslens.llm import warc

KIND = "page_id long, url string, html string, id string, digest string, bytes string"
BIG = "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n\r\n\r\n<p>é</p>" + "y" * 1200
ROWS = [
    (1, "http://a/", BIG), (7, "http://b/\r\nX: y", BIG), (3, None, BIG), (None, "http://c/", BIG),
    (4, "http://d/", "small"), (5, "http://e/", "small"), (6, "http://f/", None), (8, "http://g/", ""),
    (9, "u", "z" * 1000), (10, "u", "z" * 1000), (11, "u", "z" * 999), (12, "u", "z" * 999),
    (13, "u", "é" * 500), (14, "u", "é" * 500), (15, "u", "t" * 2000), (15, "u", "t" * 2000), (16, "u", "h" * 400_000),
    (None, "u", "n" * 1500), (None, "u", "n" * 1500),
]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], KIND)


def want(rows):
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        ids = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        first = max(ids, default=None)
        revisit = len(body) >= 1000 and first is not None and i != first
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(map(str, out))


def test_round_trip(spark):
    got = warc.round_trip(pages(spark, ROWS)).collect()
    assert sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == want(ROWS)


def test_archives_are_framed_records_without_repeats(spark):
    path = session.scratch(spark, "warc-test")
    warc.write_archives(pages(spark, ROWS), path)
    found = []
    for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect():
        data = gzip.decompress(r.content)
        for headers, block in warc.Reader(bytes(r.content)):
            found.append((headers, block))
            assert int(headers["Content-Length"]) == len(block)
        assert data == b"" or data.endswith(b"\r\n\r\n")
    assert len(found) == len(ROWS)
    assert sum(block.endswith(BIG.encode()) for _, block in found) == 1
    revisits = [h for h, _ in found if h["WARC-Type"] == "revisit"]
    responses = {h["WARC-Record-ID"]: h for h, _ in found if h["WARC-Type"] == "response"}
    # Only the two rows alike with id 15 share a record id.
    assert len({h["WARC-Record-ID"] for h, _ in found}) == len(found) - 1
    for h in revisits:
        of = responses[h["WARC-Refers-To"]]
        assert (of["WARC-Target-URI"], of["WARC-Date"]) == (h["WARC-Refers-To-Target-URI"], h["WARC-Refers-To-Date"])
        assert of["WARC-Payload-Digest"] == h["WARC-Payload-Digest"] and of["X-Page-ID"] != h.get("X-Page-ID")
    assert all(h["WARC-Profile"].endswith("identical-payload-digest") and h["WARC-Refers-To"] for h in revisits)
    assert any(h["WARC-Target-URI"] == "http://b/%0D%0AX: y" for h, _ in found)


def test_archives_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE", 30_000)
    monkeypatch.setattr(warc, "CLASSES", (1000, 6000))
    sizes = [0, 10, 999, 1000, 1001, 3000, 6000, 6001, 50_000] * 9
    rows = [(i, "u", str(i).rjust(size, "x")[-size:] if size else None) for i, size in enumerate(sizes)]
    path = session.scratch(spark, "warc-bytes")
    warc.write_archives(pages(spark, rows).coalesce(1), path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()
    lengths = [[len(block) for _, block in warc.Reader(bytes(f.content))] for f in files]
    assert sum(map(len, lengths)) == len(rows)
    # A payload is some 100 bytes shorter than its block; long ones are alone.
    assert all(sum(found) < 30_000 + 100 * len(found) or len(found) == 1 for found in lengths)
    got = warc.resolved(warc.read_archives(spark, path)).collect()
    assert sorted(str((r.id, r.bytes, r.digest, r.kind, r.refers_to)) for r in got) == want(rows)


def test_each_writing_has_headers_of_its_own(spark):
    ids = []
    for name in ("once", "again"):
        path = session.scratch(spark, name)
        warc.write_archives(pages(spark, ROWS), path)
        ids += [r.record for r in warc.read_archives(spark, path).select("record").distinct().collect()]
    assert len(set(ids)) == 2 * (len(ROWS) - 1)


def test_a_broken_archive_is_told():
    record = b"WARC/1.1\r\nWARC-Record-ID: <a>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    assert [block for _, block in warc.Reader(gzip.compress(record * 2))] == [b"hello"] * 2
    for bad in (record[:-1], record[:30], b"x" + record, record.replace(b": 5", b": 4")):
        with pytest.raises(ValueError):
            list(warc.Reader(bad))


def test_empty_table(spark):
    assert warc.round_trip(pages(spark, [])).collect() == []

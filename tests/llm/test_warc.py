import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from tessera.llm import warc


def record(kind="response", page=1, payload=b"<p>x</p>", refers=None, url="http://a/"):
    return warc._record(kind, page, url, payload, warc.digest(payload), refers)


@pytest.mark.parametrize("n", [1, 3, 400])
def test_archive_round_trip_and_layout(n):
    records = [record(page=k, payload=f"<p>page {k} of a site</p>".encode() * (k % 9), url=f"http://h/{k}") for k in range(n)] + [record("revisit", n, b"abc", 0)]
    archive = warc.encode(records)
    magic, size = struct.unpack_from("<II", archive)
    assert magic == 0x184D2A5D
    got = list(warc.decode(archive))
    assert [r["page_id"] for r in got] == list(range(n + 1))
    assert [r["payload"] for r in got[:-1]] == [f"<p>page {k} of a site</p>".encode() * (k % 9) for k in range(n)]
    assert got[-1]["record_type"] == "revisit" and got[-1]["refers_to"] == 0 and got[-1]["payload_bytes"] == 3 and got[-1]["payload"] is None
    # one frame per record: any reader that knows the dictionary gets the records one by one
    words, rest = zstandard.ZstdCompressionDict(archive[8 : 8 + size]), archive[8 + size :]
    frames = 0
    while rest:
        d = zstandard.ZstdDecompressor(dict_data=words).decompressobj()
        assert d.decompress(rest) == records[frames]
        rest, frames = d.unused_data, frames + 1
    assert frames == n + 1


def bad(data, at=b"", by=b""):
    assert at in data
    return data.replace(at, by, 1)


@pytest.mark.parametrize(
    "data",
    [
        bad(record(), b"WARC/1.1", b"WARC/0.9"),
        bad(record(), b"Content-Length: 8", b"Content-Length: 9"),
        bad(record(), b"<p>x", b"<p>y"),
        bad(record(), b"WARC-Date", b"WARC-Type"),
        bad(record(), b"WARC-Date: ", b"WARC-Dat: "),
        bad(record(), b"WARC-Type: response", b"WARC-Type: request"),
        bad(record(), b"sha1:", b"md5:"),
        bad(record(), b"HTTP/1.1 200", b"FTP 200"),
        bad(record("revisit", 1, b"a", 2), b"WARC-Refers-To", b"WARC-Refers-For"),
        record() + b"\n",
        record()[:-2],
        b"",
    ],
)
def test_invalid_records_are_refused(data):
    assert warc.parse(record())["payload"] == b"<p>x</p>"
    with pytest.raises(warc.InvalidRecord):
        warc.parse(data)


def test_invalid_archives_are_refused():
    archive = warc.encode([record(page=k) for k in range(5)])
    for broken in (b"", archive[4:], archive[:-3], archive[:-9] + b"\x00" * 9, archive + b"zzzz", struct.pack("<II", warc.SKIPPABLE, 1 << 30)):
        with pytest.raises(warc.InvalidRecord):
            list(warc.decode(broken))


def brute(rows, min_bytes):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if (h or "") == (html or "")]
        keep = max((j for j in same if j is not None), default=None)
        again = len(data) >= min_bytes and i != keep
        out.append((i, len(data), warc.digest(data), "revisit" if again else "response", keep if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_bytes", [0, 10])
def test_write_and_read(spark, min_bytes, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 3000)
    rows = [(k, f"http://h/{k}\n", "é<p>" * (k % 7)) for k in range(60)] + [(None, None, "é<p>"), (100, None, None), (101, "u", ""), (102, "u", "x" * 300_000), (None, "u", "only once")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, sha1 int").repartition(3)
    files = warc.write(pages, f"file://{tmp_path}/archives", min_bytes)
    (tmp_path / "archives" / "stray.warc.zst").write_bytes(b"left by a task that failed")
    assert files.count() > 3
    got = warc.read(files).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == brute(rows, min_bytes)
    payload = {r.payload_digest: bytes(r.payload) for r in got if r.payload is not None}
    assert all(warc.digest(p) == d for d, p in payload.items()) and {r.payload_digest for r in got} == set(payload)
    assert {r.url for r in got if r.page_id == 3} == {"http://h/3%0A"}


def test_rows_that_repeat(spark):
    pages = spark.createDataFrame([(1, "u", "a"), (2, "u", "a"), (2, "u", "a"), (2, "u", "b")], "page_id long, url string, html string")
    got = warc.read(warc.write(pages), payload=False).collect()
    assert sorted((r.page_id, r.payload_digest == warc.digest(b"a"), r.record_type, r.refers_to) for r in got) == [(1, True, "revisit", 2), (2, False, "response", None), (2, True, "response", None), (2, True, "response", None)]


def test_empty_table(spark):
    pages = spark.createDataFrame([(1, "u", "a")], "page_id long, url string, html string").where(F.lit(False))
    assert warc.read(warc.write(pages)).count() == 0

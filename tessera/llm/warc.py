"""WARC archives of Zstandard frames: writing and reading.

``write`` makes ``.warc.zst`` files: a leading skippable frame holds the
archive's dictionary, then each record is a frame of its own. ``read`` loads the
dictionary from that frame, decodes one frame per record, and validates header
lines, lengths and digests.

A payload is stored once per text: of records with equal payloads of
``min_bytes`` or more, the one with the largest id is a ``response``, the others
are ``revisit`` records that name it and carry the payload's length in their
HTTP header. Payload groups are found on digests; payloads are not shuffled
while there are at most ``BROADCAST_ROWS`` revisits. Beyond, rows with their html
meet the revisits in a shuffled join, with the same result.

Files are written next to each other below the shared folder, each under a
temporary name that is renamed when complete; its final name is that of its
partition and the digest of its content, so a task that runs twice leaves the
same file. The list of files is
what successful tasks return; anything else in the folder is ignored.

Defined cases: null html is an empty payload, a null url an empty target.
Null ids lose to any other id; every row is a record of its own, and rows that
repeat both the id and the payload of a response are responses too. Line breaks
in a url are percent-encoded. Extra columns are not read. An empty table writes
no file and reads as no record.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_small, shared_path, slices, stored

DATE = "2024-01-01T00:00:00Z"
#: Uncompressed bytes per archive file.
ARCHIVE_BYTES = 32 << 20
#: A dictionary of this size is learned from an archive's first payloads.
DICT_BYTES, DICT_SAMPLE = 16 << 10, 1 << 20
LEVEL = 3
SKIPPABLE = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

class InvalidRecord(ValueError):
    """An archive that breaks the format."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(kind: str, page: int | None, url: str, payload: bytes, sha1: str, refers: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    url = url.replace("\r", "%0D").replace("\n", "%0A")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name(page)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{sha1}"]
    if kind == "revisit":
        lines += [f"WARC-Refers-To: {name(refers)}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(records: list[bytes]):
    """A trained dictionary, or plain content where there is too little to train on."""
    import zstandard

    samples, size = [], 0
    for r in records:
        if size >= DICT_SAMPLE:
            break
        samples.append(r[:8192])
        size += len(samples[-1])
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[:DICT_BYTES] or b"WARC/1.1\r\n", dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def encode(records: list[bytes]) -> bytes:
    """One archive."""
    import zstandard

    words = _dictionary(records)
    content = words.as_bytes()
    out = [struct.pack("<II", SKIPPABLE, len(content)), content]
    make = zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_content_size=True, write_checksum=True)
    out += [make.compress(r) for r in records]
    return b"".join(out)


def decode(archive: bytes) -> Iterator[dict]:
    """The records of an archive; raises ``InvalidRecord`` where it is not valid."""
    import zstandard

    if len(archive) < 8:
        raise InvalidRecord("no dictionary frame")
    magic, size = struct.unpack_from("<II", archive)
    if magic != SKIPPABLE or 8 + size > len(archive):
        raise InvalidRecord("the archive does not begin with a whole dictionary frame")
    words = zstandard.ZstdCompressionDict(archive[8 : 8 + size])
    reader = zstandard.ZstdDecompressor(dict_data=words)
    view, at = memoryview(archive), 8 + size
    while at < len(archive):
        frame, step, parts = reader.decompressobj(), 1 << 14, []
        begin = at
        while not frame.eof:
            piece = view[at : at + step]
            if not len(piece):
                raise InvalidRecord(f"the frame at byte {begin} is cut off")
            try:
                parts.append(frame.decompress(piece))
            except zstandard.ZstdError as e:
                raise InvalidRecord(f"the frame at byte {begin}: {e}") from e
            at += len(piece) - len(frame.unused_data)
        yield parse(b"".join(parts))


def parse(record: bytes) -> dict:
    """One record, checked: version, header lines, lengths, digest."""
    head, mark, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not mark or lines[0] != "WARC/1.1":
        raise InvalidRecord("no WARC/1.1 header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise InvalidRecord(f"header line {line[:80]!r}")
        if name.lower() in fields:
            raise InvalidRecord(f"{name} stands twice")
        fields[name.lower()] = value.strip()
    missing = {"warc-type", "warc-record-id", "warc-date", "warc-payload-digest", "content-length"} - fields.keys()
    if missing:
        raise InvalidRecord(f"without {', '.join(sorted(missing))}")
    if fields["warc-type"] not in ("response", "revisit"):
        raise InvalidRecord(f"type {fields['warc-type']}")
    if not fields["content-length"].isascii() or not fields["content-length"].isdigit() or int(fields["content-length"]) != len(rest) - 4 or rest[-4:] != b"\r\n\r\n":
        raise InvalidRecord("Content-Length does not fit the block")
    http, mark, payload = rest[:-4].partition(b"\r\n\r\n")
    length = [line.partition(b":")[2].strip() for line in http.split(b"\r\n")[1:] if line.lower().startswith(b"content-length:")]
    if not mark or not http.startswith(b"HTTP/1.1 ") or len(length) != 1 or not length[0].isdigit():
        raise InvalidRecord("no HTTP header with a length")
    size, sha1, kind = int(length[0]), fields["warc-payload-digest"], fields["warc-type"]
    if not sha1.startswith("sha1:"):
        raise InvalidRecord("digest without sha1")
    if kind == "response" and (size != len(payload) or sha1 != f"sha1:{digest(payload)}"):
        raise InvalidRecord("length or digest does not fit the payload")
    if kind == "revisit" and (payload or "warc-refers-to" not in fields):
        raise InvalidRecord("a revisit has a payload or refers to nothing")

    def page(name: str) -> int | None:
        value = fields.get(name, "<urn:page:>")
        if not value.startswith("<urn:page:") or value[-1] != ">":
            raise InvalidRecord(f"{name} {value}")
        return int(value[10:-1]) if value[10:-1] else None

    return {
        "page_id": page("warc-record-id"),
        "url": fields.get("warc-target-uri", ""),
        "record_type": kind,
        "payload_bytes": size,
        "payload_digest": sha1[5:],
        "refers_to": page("warc-refers-to"),
        "payload": payload if kind == "response" else None,
    }


def _file_system(folder: str):
    from pyarrow import fs

    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder[5:]
    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


def write(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write the archives into ``folder`` (default: a new one below the shared
    folder); returns the files: path, records, bytes."""
    folder = folder or shared_path(pages.sparkSession, "warc")
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    keyed = pages.select(
        F.col(id_col).isNull().alias("none"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"), F.sha1(html.cast("binary")).alias("sha1"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), html.alias("html")
    )
    narrow = stored(keyed.where(F.octet_length("html") >= min_bytes).select("none", "id", "sha1"), "digests")
    group = narrow.groupBy("sha1").agg(F.count("*").alias("n"), F.max(F.struct((~F.col("none")).alias("known"), "id")).alias("keep"))
    repeated = group.where("n > 1").select("sha1", "keep.known", F.col("keep.id").alias("refers"))
    others = narrow.join(repeated, "sha1").where("none = known or id <> refers")  # not the kept one
    roles = stored(others.select("none", "id", "sha1", F.when(F.col("known"), F.col("refers")).alias("refers"), F.lit(True).alias("again")).distinct(), "revisits")
    rows = join_small(keyed, roles, ["none", "id", "sha1"], "left").select(F.when(~F.col("none"), F.col("id")).alias("id"), "url", "html", "refers", F.coalesce("again", F.lit(False)).alias("again"))

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, done = TaskContext.get().partitionId(), 0
        fs, root = _file_system(folder)
        fs.create_dir(root, recursive=True)
        records: list[bytes] = []
        size = 0

        def finish() -> pa.RecordBatch:
            content = encode(records)
            name = f"{root}/{part:06d}-{done:06d}-{hashlib.sha256(content).hexdigest()[:32]}.warc.zst"
            draft = f"{name}.{uuid.uuid4().hex}.tmp"
            with fs.open_output_stream(draft) as f:
                f.write(content)
            fs.move(draft, name)
            return pa.record_batch([pa.array([name]), pa.array([len(records)], pa.int64()), pa.array([len(content)], pa.int64())], names=["path", "records", "bytes"])

        for batch in slices(batches, "html"):
            for row in batch.to_pylist():
                payload = row["html"].encode()
                records.append(_record("revisit" if row["again"] else "response", row["id"], row["url"], payload, digest(payload), row["refers"]))
                size += len(records[-1])
                if size >= ARCHIVE_BYTES:
                    yield finish()
                    records, size, done = [], 0, done + 1
        if records:
            yield finish()

    return stored(rows.mapInArrow(archives, "path string, records long, bytes long"), "archives")


def read(files: DataFrame, payload: bool = True) -> DataFrame:
    """The records of the archives that ``write`` returned: page_id, url,
    record_type, payload_bytes, payload_digest, refers_to, and the payload
    (null for revisits). Fails where an archive is not valid."""
    spark = files.sparkSession
    known = files.select(F.element_at(F.split("path", "/"), -1).alias("name")).distinct()
    first = files.select("path").first()
    columns = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())]
    columns += [("payload", pa.binary())] * payload
    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long" + ", payload binary" * payload
    if first is None:
        return spark.createDataFrame([], schema)
    folder = first[0].rpartition("/")[0]
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    found = join_small(found.withColumn("name", F.element_at(F.split("path", "/"), -1)), known, "name", "left_semi").select("content")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[dict]) -> pa.RecordBatch:
            return pa.record_batch([pa.array([r[n] for r in rows], t) for n, t in columns], names=[n for n, _ in columns])

        for archive in batches:
            for content in archive.column("content"):
                rows, size = [], 0
                for r in decode(content.as_py()):
                    rows.append(r)
                    size += 500 + payload * len(r["payload"] or b"")
                    if size > 4 << 20:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    return found.mapInArrow(records, schema)

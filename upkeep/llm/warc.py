"""WARC archives: a deduplicating writer and a splittable reader.

Writing: rows are dealt with the first row of their payload (map-side combined minimum per SHA-1, then a join that
adaptive execution splits where one payload is hot); each task writes archives of bounded size, every record a gzip member
of its own, and returns their names.  Reading: a task gets a byte range, scans it for the gzip magic, takes a place as a
member only if decoding it yields a WARC header, and owns the records that start inside its range; it reads on past the
range to end its last record.  Any range size gives each record exactly once.

Defined results: null html counts as an empty payload; a null url has no target line; of equal payloads of at least
``least`` bytes the row with the smallest id is the response and the others revisit it (rows repeated with that same id are
all responses; null ids come last and revisit); an empty table gives no archives.  A damaged member raises.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.llm.support import file_system, map_batches, shared_folder, spread, stored, text_of, write_file

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:upkeep:page")

ARCHIVE_BYTES = 64 << 20
SPLIT_BYTES = 8 << 20
CHUNK = 64 << 10
WINDOW = 1 << 20
LEVEL = 5


def record_id(page) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, str(page))}>"


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def page_record(page, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    revisit = refers_to is not None
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page))]
    headers += [("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if page is not None:
        headers.append(("X-Page-Id", str(page)))
    if url is not None:
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to))]
        headers.append(("X-Refers-To-Page-Id", str(refers_to)))
    headers.append(("Content-Type", "application/http; msgtype=response"))
    answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return member(headers, answer.encode() + (b"" if revisit else payload))


def with_references(pages: DataFrame, least: int) -> DataFrame:
    """page_id, url, payload, sha1 and refers_to (null for responses)."""
    payload = text_of(pages, "html").cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha1", F.unhex(F.sha1("payload")))
    first = rows.where(F.length("payload") >= least).groupBy("sha1").agg(F.min("page_id").alias("first"))
    joined = rows.join(first, "sha1", "left")
    copy = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & (F.length("payload") >= least)
    return joined.select("page_id", "url", "payload", "sha1", F.when(copy, F.col("first")).alias("refers_to"))


def write(pages: DataFrame, least: int = 0, folder: str | None = None) -> DataFrame:
    """Write ``page_id``, ``url``, ``html``; returns the manifest: path, bytes, records."""
    folder = folder or shared_folder(pages.sparkSession)

    def work(batches):
        members, size, records = [], 0, 0

        def close():
            path = f"{folder}/pages-{uuid.uuid4().hex}.warc.gz"
            info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(path)), ("WARC-Date", "1970-01-01T00:00:00Z")]
            head = member([*info, ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
            written = write_file(path, [head, *members])
            return pa.RecordBatch.from_pylist([{"path": path, "bytes": written, "records": records}])

        for batch in batches:
            for page, url, payload, sha1, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                made = page_record(page, url, payload, base64.b32encode(sha1).decode(), refers_to)
                members.append(made)
                size += len(made)
                records += 1
                if size > ARCHIVE_BYTES:
                    yield close()
                    members, size, records = [], 0, 0
        if members:
            yield close()

    written = map_batches(with_references(pages, least), work, "path string, bytes long, records long")
    return stored(written, folder, "manifest")


class Archive:
    """Members of one archive that start in a byte range; read through one window."""

    def __init__(self, uri: str):
        system, path = file_system(uri)
        self.uri, self.file = uri, system.open_input_file(path)
        self.size = self.file.size()
        self.window, self.window_at = b"", 0

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()

    def _bytes(self, at: int, count: int) -> bytes:
        count = max(0, min(count, self.size - at))
        if not self.window_at <= at <= at + count <= self.window_at + len(self.window):
            self.window, self.window_at = self.file.read_at(max(count, min(WINDOW, self.size - at)), at), at
        return self.window[at - self.window_at : at - self.window_at + count]

    def _next_magic(self, at: int, end: int) -> int | None:
        if at < end and self._bytes(at, len(MAGIC)) == MAGIC:  # right after a member
            return at
        while at < end:
            window = self._bytes(at, min(CHUNK, end - at) + len(MAGIC) - 1)
            if (found := window.find(MAGIC)) >= 0:
                return at + found
            at += CHUNK
        return None

    def _decode(self, at: int) -> tuple[bytes, int] | None:
        """Record and end of the member at a place; None if decoding shows no WARC header there."""
        unpacker, out, place = zlib.decompressobj(31), [], at
        while not unpacker.eof:
            chunk = self._bytes(place, CHUNK)
            if not chunk:
                break
            place += len(chunk)
            try:
                part = unpacker.decompress(chunk)
            except zlib.error as error:
                if out and b"".join(out).startswith(VERSION):
                    raise ValueError(f"{self.uri}: damaged member at {at}: {error}") from error
                return None
            out.append(part)
            if not b"".join(out[:2])[: len(VERSION)] == VERSION[: sum(map(len, out[:2]))]:
                return None
        record = b"".join(out)
        if not record.startswith(VERSION):
            return None
        if not unpacker.eof:
            raise ValueError(f"{self.uri}: member at {at} ends early")
        return record, place - len(unpacker.unused_data)

    def records(self, start: int, end: int):
        """``(place, headers, block)`` of each record that starts in the range."""
        at = start
        while (at := self._next_magic(at, min(end, self.size))) is not None:
            if (found := self._decode(at)) is None:
                at += 1
                continue
            head, _, rest = found[0].partition(b"\r\n\r\n")
            headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            yield at, headers, rest[: int(headers["Content-Length"])]
            at = found[1]


def page_row(headers: dict, block: bytes) -> dict:
    """A record as a row; the digest and length of a response are taken from its payload and must agree."""
    answer, _, payload = block.partition(b"\r\n\r\n")
    size, digest = int(re.search(rb"(?i)content-length: *(\d+)", answer)[1]), headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if headers["WARC-Type"] == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if (len(payload), found) != (size, digest):
            raise ValueError(f"record {headers['WARC-Record-ID']}: payload differs from its header")
    number = lambda name: int(headers[name]) if name in headers else None
    return {
        "page_id": number("X-Page-Id"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": headers["WARC-Type"],
        "refers_to": number("X-Refers-To-Page-Id"),
        "url": headers.get("WARC-Target-URI"),
        "html": payload if headers["WARC-Type"] == "response" else None,
    }


def read(spark: SparkSession, manifest: DataFrame, split_bytes: int = SPLIT_BYTES, payloads: bool = False) -> DataFrame:
    """One row per page record of the archives; with ``payloads`` also ``url`` and the ``html`` bytes of responses."""
    columns = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}
    columns |= {"url": pa.string(), "html": pa.binary()} if payloads else {}
    kinds = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long")))
    ranges = manifest.select("path", starts.alias("start"))

    def work(batches):
        for batch in batches:
            for part in batch.to_pylist():
                rows, size = [], 0
                with Archive(part["path"]) as archive:
                    for _, headers, block in archive.records(part["start"], part["start"] + split_bytes):
                        if headers["WARC-Type"] not in ("response", "revisit"):
                            continue
                        row = page_row(headers, block)
                        rows.append(row if payloads else {**row, "html": None})
                        size += 200 + len(block) * payloads
                        if size > 4 << 20:
                            yield made(rows)
                            rows, size = [], 0
                if rows:
                    yield made(rows)

    def made(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in columns.items()], list(columns))

    schema = ", ".join(f"{n} {kinds[t]}" for n, t in columns.items())
    return map_batches(spread(ranges, ranges.count()), work, schema)

"""WARC archives: one gzip member a record, written by tasks, read back by byte ranges.

Writing: a task rolls over archives of a target size in a shared folder and returns
one manifest row an archive. Names are new with each attempt and only archives of
the written manifest count, so attempts that failed or were lost leave nothing that
is read. Records with equal payloads are told apart by SHA-256: the one with the
greatest key keeps its payload, the others become revisit records that point to it.

Reading: archives are cut into byte ranges; a task looks for gzip magic from the
start of its range, accepts a candidate only if its first bytes inflate to a whole
WARC header, and owns every record that starts inside its range, also if it ends
beyond. As a stored payload can itself be an archive, a range could begin inside one
and take its members for records. So ranges tell where they began and where the next
record after them starts; a range that began elsewhere than its predecessor handed
over is read again from there, until all agree.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapforge.llm.common import ready, shared_dir, written

MAGIC = b"\x1f\x8b\x08"
ARCHIVE_BYTES, RANGE_BYTES, READ_BYTES = 1 << 28, 1 << 25, 1 << 18
#: A header over this length is none.
MOST_HEADER = 1 << 16
#: Groups of equal payloads up to which their list is broadcast; beyond, only those of over HEAVY records are.
MOST_SHARED_GROUPS, HEAVY = 200_000, 10_000
DATE = "1970-01-01T00:00:00Z"
MANIFEST = "path string, bytes long, records long"
RECORDS = (
    "path string, start long, record_type string, record_id string, refers_to string, target_uri string, record_date string, "
    "payload_digest string, payload_sha1 string, payload_bytes long, payload binary, error string"
)
_SCAN = RECORDS + ", range_start long, range_stop long, begun long, first_start long, next_start long"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _file(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def _header(pairs: list[tuple[str, str | None]]) -> str:
    """Header lines; line breaks inside a value would end it and become spaces."""
    return "".join(f"{k}: {' '.join(v.splitlines())}\r\n" for k, v in pairs if v is not None)


def encode_record(kind: str, record_id: str, refers_to: str | None, uri: str | None, date: str, payload: bytes | None, payload_bytes: int, digest: str) -> bytes:
    """A record as a gzip member of its own. A revisit keeps the HTTP header of the whole payload and no payload."""
    http = "HTTP/1.1 200 OK\r\n" + _header([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(payload_bytes))]) + "\r\n"
    block = http.encode() + (payload or b"" if kind == "response" else b"")
    profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if kind == "revisit" else None
    head = "WARC/1.1\r\n" + _header([
        ("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Profile", profile),
        ("WARC-Refers-To", f"<{refers_to}>" if refers_to is not None else None), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ])
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(head.encode() + b"\r\n" + block + b"\r\n\r\n") + squeeze.flush()


def roles(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Add record_type and refers_to to rows of record_id, key, payload, ...: of equal payloads of ``least_bytes`` or more that with
    the greatest key is the response and the others revisit it; smaller ones are all responses.

    A null payload is empty, a null key the least; of rows with equal payload and key any one is the response. ``records`` is
    numbered and written once, so that rows are the same ones in both passes.
    """
    data = F.coalesce(F.col("payload"), F.lit(b""))
    rows = records.withColumn("payload", data).withColumns({"uid": F.monotonically_increasing_id(), "payload_bytes": F.length("payload").cast("long"), "hash": F.unhex(F.sha2("payload", 256))})
    rows = written(rows, "records")
    top = F.max(F.struct("key", "uid", "record_id"))
    groups = rows.filter(F.col("payload_bytes") >= least_bytes).groupBy("hash").agg(top.alias("top"), F.count("*").alias("n")).filter("n > 1")
    groups = written(groups.select("hash", "n", F.col("top.uid").alias("top_uid"), F.col("top.record_id").alias("top_id")), "groups")
    if groups.count() <= MOST_SHARED_GROUPS:
        joined = rows.join(F.broadcast(groups), "hash", "left")
    else:  # heavy groups are at most one in HEAVY rows; the rest have no hot key
        heavy, light = groups.filter(F.col("n") > HEAVY), groups.filter(F.col("n") <= HEAVY)
        few = F.broadcast(heavy) if heavy.count() <= MOST_SHARED_GROUPS else heavy
        joined = rows.join(few, "hash").unionByName(rows.join(few, "hash", "left_anti").join(light, "hash", "left"))
    again = F.coalesce(F.col("uid") != F.col("top_uid"), F.lit(False))
    joined = joined.withColumns({"record_type": F.when(again, "revisit").otherwise("response"), "refers_to": F.when(again, F.col("top_id"))})
    return joined.drop("hash", "n", "top_uid", "top_id", "uid")


def write(records: DataFrame, root: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write rows of record_id, record_type, refers_to, target_uri, payload as archives under ``root``; the manifest is returned.

    The manifest is a written table: reading it starts no second write. Rows keep their partitions, nothing is shuffled.
    """
    ready(records.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _file(root)
        store.create_dir(folder, recursive=True)
        out, name, size, count, done = None, "", 0, 0, []

        def close() -> None:
            out.close()
            done.append((f"{root}/{name}", size, count))

        for batch in batches:
            for row in (r for k in range(0, batch.num_rows, 64) for r in batch.slice(k, 64).to_pylist()):
                if out is not None and size >= archive_bytes:
                    close()
                    out = None
                if out is None:
                    name, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(posixpath.join(folder, name), compression=None)
                data = row["payload"] or b""
                member = encode_record(row["record_type"], row["record_id"], row["refers_to"], row["target_uri"], DATE, data, len(data), sha1_base32(data))
                out.write(member)
                size, count = size + len(member), count + 1
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())], names=["path", "bytes", "records"])

    return written(records.select("record_id", "record_type", "refers_to", "target_uri", "payload").mapInArrow(run, MANIFEST), "manifest")


@dataclass
class _Member:
    """What a member tells; ``end`` is where the next one may start."""

    start: int
    end: int = 0
    header: dict[str, str] = field(default_factory=dict)
    size: int = 0
    sha1: str = ""
    payload: bytes | None = None
    http: dict[str, str] = field(default_factory=dict)
    error: str | None = None


def _fields(block: bytes) -> dict[str, str]:
    lines = [line.split(":", 1) for line in block.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line]
    return {k.strip().lower(): v.strip() for k, v in lines}


class _Inflated:
    """Inflates one member from a place in a file, piece by piece; ``used`` counts its packed bytes."""

    def __init__(self, file: BinaryIO, start: int) -> None:
        file.seek(start)
        self.file, self.used, self.unpack = file, 0, zlib.decompressobj(31)
        self.rest, self.tail = b"", b""

    def piece(self, most: int = READ_BYTES) -> bytes:
        """Next bytes, ``most`` at most; empty at the end of the member. Cut or damaged members raise ``zlib.error``, but not before the place."""
        while not self.unpack.eof:
            data = self.tail or self.file.read(READ_BYTES)
            if not data:
                raise zlib.error("the member is cut")
            out = self.unpack.decompress(data, most)
            self.tail = self.unpack.unused_data if self.unpack.eof else self.unpack.unconsumed_tail
            self.used += len(data) - len(self.tail)
            if out:
                return out
        return b""

    def upto(self, mark: bytes, most: int) -> bytes | None:
        """Bytes up to and with ``mark``; None if it is not among the first ``most``."""
        seen = self.rest
        while (at := seen.find(mark)) < 0:
            if len(seen) > most or not (more := self.piece(1024)):
                self.rest = seen
                return None
            seen += more
        self.rest = seen[at + len(mark) :]
        return seen[: at + len(mark)]

    def take(self, most: int) -> bytes:
        """Some of the next bytes, ``most`` at most; empty at the end."""
        data = self.rest or self.piece()
        self.rest = data[most:]
        return data[:most]


def read_member(file: BinaryIO, start: int, with_payload: bool) -> _Member | None:
    """The record whose member starts here; None if none does: the bytes don't inflate to a WARC header."""
    inflated, member = _Inflated(file, start), _Member(start)
    try:
        head = inflated.upto(b"\r\n\r\n", MOST_HEADER)
        if head is None or not head.startswith(b"WARC/1."):
            return None
        member.header = _fields(head)
        left = int(member.header["content-length"])
    except (zlib.error, KeyError, ValueError):
        return None
    try:
        hasher, kept = hashlib.sha1(), []
        if member.header.get("content-type", "").startswith("application/http"):
            http = inflated.upto(b"\r\n\r\n", min(left, MOST_HEADER)) or b""
            member.http = _fields(http)
            left -= len(http)
        while left > 0 and (data := inflated.take(left)):
            left -= len(data)
            member.size += len(data)
            hasher.update(data)
            if with_payload:
                kept.append(data)
        if left:
            raise zlib.error("the block is shorter than its header says")
        while inflated.take(READ_BYTES):
            pass
        member.sha1, member.payload = base64.b32encode(hasher.digest()).decode(), b"".join(kept) if with_payload else None
        member.end = start + inflated.used
    except zlib.error as e:
        member.error, member.end = str(e), start + 1
    return member


def find_magic(file: BinaryIO, start: int, stop: int) -> int | None:
    """Place of the first gzip magic that starts in [start, stop)."""
    at = start
    while at < stop:
        file.seek(at)
        data = file.read(min(READ_BYTES, stop - at) + len(MAGIC) - 1)
        k = data.find(MAGIC)
        if k >= 0:
            return at + k
        if len(data) < len(MAGIC):
            return None
        at += len(data) - len(MAGIC) + 1
    return None


def _row(path: str, m: _Member) -> dict:
    h = m.header
    bare = lambda v: v[1:-1] if v and v.startswith("<") and v.endswith(">") else v
    kind, digest = h.get("warc-type"), h.get("warc-payload-digest")
    whole = int(m.http["content-length"]) if kind == "revisit" and m.http.get("content-length", "").isdigit() else m.size
    return {
        "path": path, "start": m.start, "record_type": kind, "record_id": bare(h.get("warc-record-id")), "refers_to": bare(h.get("warc-refers-to")), "target_uri": h.get("warc-target-uri"),
        "record_date": h.get("warc-date"), "payload_digest": digest.split(":", 1)[1] if digest and ":" in digest else digest, "payload_sha1": None if m.error else m.sha1,
        "payload_bytes": None if m.error else whole, "payload": m.payload, "error": m.error,
    }


def scan_range(path: str, start: int, stop: int, begin: int | None, with_payload: bool) -> Iterator[dict]:
    """Records that start in [start, stop) of an archive, from ``begin`` on if it is given; the last row tells where the range began and hands over."""
    store, name = _file(path)
    first, at, sure = None, start if begin is None else begin, begin is not None
    with store.open_input_file(name) as file:
        size = file.size()
        while at < min(stop, size):
            member = read_member(file, at, with_payload) if sure else None
            if member is None:
                # not where a record starts: go on to the next candidate
                found = find_magic(file, at + 1 if sure else at, stop)
                if found is None:
                    at = stop
                    break
                at, sure = found, True
                continue
            first = member.start if first is None else first
            yield _row(path, member)
            at = member.end
    yield {"path": path, "range_start": start, "range_stop": stop, "begun": begin, "first_start": first, "next_start": at}


def _scan(ranges: DataFrame, with_payload: bool) -> DataFrame:
    ready(ranges.sparkSession)
    schema = pa.schema([
        pa.field(name, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[kind]) for name, kind in (c.split() for c in _SCAN.split(", "))
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in (r for batch in batches for r in batch.to_pylist()):
            rows, held = [], 0
            for row in scan_range(r["path"], r["start"], r["stop"], r["begin"], with_payload):
                row |= {"range_start": r["start"], "range_stop": r["stop"]}
                rows.append(row)
                held += len(row.get("payload") or b"") + 512
                if held > 1 << 24:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return ranges.select("path", "start", "stop", "begin").mapInArrow(run, _SCAN)


def read(spark: SparkSession, manifest: DataFrame, range_bytes: int = RANGE_BYTES, with_payload: bool = True) -> DataFrame:
    """Records of the archives of ``manifest`` (path, bytes), each once, in columns as ``RECORDS`` names them.

    ``payload_sha1`` and ``payload_bytes`` are made from the payload as read; of a revisit, which has none, the bytes are those its HTTP
    header states. A member that starts well but is cut or damaged gives a row with an ``error``, and reading goes on at the next
    candidate. Records are written once to the shared folder, so a lost executor costs only the ranges it had. No archives: no rows.
    """
    step = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long")))
    ranges = manifest.filter("bytes > 0").select("path", "bytes", step.alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + range_bytes, "bytes").alias("stop"), F.when(F.col("start") == 0, F.lit(0)).cast("long").alias("begin"))
    tasks = max(1, min(ranges.count(), 100_000))
    scanned = written(_scan(ranges.repartition(tasks, "path", "start"), with_payload), "scan")
    while True:
        told = scanned.filter("next_start is not null").select("path", "range_start", "range_stop", "begun", "first_start", "next_start")
        by_place = Window.partitionBy("path").orderBy("range_start").rowsBetween(Window.unboundedPreceding, -1)
        # a record may end ranges later: what counts is the farthest start handed over so far
        due = F.coalesce(F.max("next_start").over(by_place), F.lit(0))
        wrong = told.withColumn("due", due).filter("not (begun <=> due) and not (first_start <=> if(due < range_stop, due, null))")
        wrong = written(wrong.select("path", F.col("range_start").alias("start"), F.col("range_stop").alias("stop"), F.col("due").alias("begin")), "wrong")
        if wrong.isEmpty():
            return scanned.filter("next_start is null").select([c.split()[0] for c in RECORDS.split(", ")])
        keep = scanned.join(wrong.select("path", F.col("start").alias("range_start")), ["path", "range_start"], "left_anti").select(scanned.columns)
        scanned = written(keep.unionByName(_scan(wrong, with_payload)), "scan")


def archive(pages: DataFrame, root: str, least_bytes: int = 0) -> DataFrame:
    """Write a record a row of page_id, url, html (null: empty), identified by page_id; the manifest is returned."""
    name = F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    records = pages.select(name.alias("record_id"), F.col("page_id").alias("key"), F.col("url").alias("target_uri"), F.col("html").cast("binary").alias("payload"))
    return write(roles(records, least_bytes), root)


def query(pages: DataFrame) -> DataFrame:
    """Pages as read back from their archives. A null page_id comes back as null; repeated rows are records of their own."""
    spark = pages.sparkSession
    manifest = archive(pages, f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}")
    page = lambda c: F.nullif(F.substring_index(c, ":", -1), F.lit("")).cast(pages.schema["page_id"].dataType)
    back = read(spark, manifest, with_payload=False)
    digest = F.when(F.col("record_type") == "response", F.col("payload_sha1")).otherwise(F.col("payload_digest"))
    return back.select(page("record_id").alias("page_id"), "payload_bytes", digest.alias("payload_digest"), "record_type", page("refers_to").alias("refers_to"))


ORACLE = r"""
WITH p AS (SELECT row_number() OVER () AS rid, page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT *, octet_length(b) AS n, sha1(b) AS s, row_number() OVER (PARTITION BY b ORDER BY page_id DESC NULLS LAST, rid) AS turn,
  first_value(page_id) OVER (PARTITION BY b ORDER BY page_id DESC NULLS LAST, rid) AS top FROM p)
SELECT page_id, n::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(s, 5 * (i // 4)::INT + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN turn = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN turn > 1 THEN top END AS refers_to
FROM h
"""

"""WARC archives: writing with repeated payloads as revisits, and a reader that splits compressed files.

``write_archives`` stores each record as a gzip member of its own, one file per task. ``read_archives`` gives every
task a byte range of a file: it looks for the gzip magic number and decodes the start of each candidate. The first
candidate of a range is a record if it is whole and followed by another header or by the end of the file; from there on
each record ends where the next begins. A task owns the records that start inside its range and reads past the range
to end the last of them, so each record is read exactly once and a file is never one task's work.

A candidate that is not followed so is either inside another record's payload or next to damage. The task then reads
the file from its beginning to find out, which happens only in files that are damaged or hold archives as payloads.

Nothing is lost silently. Where no whole record begins (junk between members, a member that is damaged or cut off) a
``Damage`` is found, once, by the task that owns the place or the record before it; reading goes on with the next whole
record. A file whose size is not the listed one is damaged at its end. ``read_archives`` raises, or reports damage as rows.

Of records with equal payloads of at least ``min_revisit`` bytes, that with the largest page_id is the response; the
others are revisits that carry the payload's digest and size but not its bytes. Which payloads are repeated is decided
on ids, digests and sizes; payloads stay in their tasks as long as Spark can broadcast the repeated digests.

Records of other writers are read too: any type, either version, header names in any case, ids of any form (page_id is
null then). A digest is checked where it is SHA-1 and the payload was not sent in chunks; otherwise it is computed. A
revisit has a size only where its record states one. Of two whole neighbouring records that a payload holds
uncompressed, and that lie across a range's beginning, the first would be taken for a record of the file.

Defined cases: a null html is an empty payload, a null url leaves the target out, a null page_id is kept as null and is
the response only if no page with an id has the payload. Several rows with the largest id are each the response. Long
payloads become Python objects one at a time. An empty table writes no file and reads as no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from base64 import b32decode, b32encode
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activitymill.llm.work import kept

# Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

_HEADER_BYTES = 1 << 12  # compressed bytes in which a record's header must have begun
_READ = 1 << 14


@dataclass(frozen=True)
class Store:
    """A file system that tasks reach with pyarrow, and a path in it."""

    uri: str

    def open(self) -> tuple[fs.FileSystem, str]:
        uri = self.uri if "://" in self.uri or self.uri.startswith("file:") else f"file://{self.uri}"
        return fs.FileSystem.from_uri(uri)


def with_revisits(pages: DataFrame, min_revisit: int = 1000) -> DataFrame:
    """page_id, url, payload, its digest and size, and for revisits the page_id that they refer to."""
    html = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", html.alias("payload")).withColumns(
        {"digest": F.sha1("payload"), "size": F.octet_length("payload").cast("long")}
    )
    # One row per repeated payload; a payload that a third of the pages have is one row per task before the shuffle.
    # Written first, so that Spark knows its size and broadcasts it below its limit; payloads are then not shuffled.
    repeated = kept(
        rows.filter(F.col("size") >= min_revisit).groupBy(F.col("digest").alias("of"))
        .agg(F.max("page_id").alias("first"), F.count("*").alias("times"))
        .filter((F.col("times") > 1) & F.col("first").isNotNull()).drop("times"),
        "repeated",
    )
    joined = rows.join(repeated, F.col("digest") == F.col("of"), "left")
    other = ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(*rows.columns, F.when(other, F.col("first")).alias("refers_to"))


def _record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    head = _HTTP % len(payload)
    body = head + payload if kind == "response" else head
    lines = [
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http; msgtype=response",
        "WARC-Payload-Digest: sha1:" + b32encode(bytes.fromhex(digest)).decode(),
        f"WARC-Payload-Length: {len(payload)}",
        f"Content-Length: {len(body)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe=":/?#[]@!$&'()*+,;=%~"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(5, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(pages: DataFrame, folder: str, min_revisit: int = 1000) -> list[tuple[str, int]]:
    """Write one file per task below ``folder`` and return (file, bytes), a row per file.

    A file counts only once its task has ended well: what an attempt that failed has left is not in the list and is
    removed.
    """
    store = Store(folder)
    files, path = store.open()
    files.create_dir(path, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to, base = store.open()
        name, out, size = f"part-{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
                if out is None:
                    out = to.open_output_stream(f"{base}/{name}", compression=None)
                member = _gzip(_record(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"]))
                out.write(member)
                size += len(member)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "bytes": [size]}, pa.schema(
                [("file", pa.string()), ("bytes", pa.int64())]
            ))

    marked = with_revisits(pages, min_revisit)
    listed = [(r.file, r.bytes) for r in marked.mapInArrow(write, "file string, bytes long").collect()]
    whole = {f for f, _ in listed}
    for info in files.get_file_info(fs.FileSelector(path)):
        if info.base_name not in whole:
            files.delete_file(info.path)
    return listed


@dataclass(frozen=True)
class Member:
    """A whole record, decompressed, and where its member starts in the file."""

    at: int
    data: bytes


@dataclass(frozen=True)
class Damage:
    """A place at which a record should begin and no whole one does."""

    at: int


def members(source: pa.NativeFile, start: int, end: int, size: int) -> Iterator[Member | Damage]:
    """Records of the gzip members that start in [start, end), and the damage that is this range's to tell."""
    at: int | None = start
    if start > 0:
        at = _candidate(source, start, end)
        if at is None:
            return
        whole = _member(source, at)
        if whole is None or (whole[1] < size and not _header(source, whole[1])):
            at = _boundary(source, start, size)
    elif size and not _header(source, 0):
        yield Damage(0)
    if at is not None:
        yield from _records(source, at, end, size)


def _records(source: pa.NativeFile, at: int | None, end: int, size: int) -> Iterator[Member | Damage]:
    """Records from ``at`` on, which is where one ends or begins. A place without a header is told with the record
    before it, a header without a whole record by the range that it is in. Returns the first such place not before ``end``."""
    while at is not None and at < end:
        if _header(source, at):
            whole = _member(source, at)
            if whole is not None:
                yield Member(at, whole[0])
                at = whole[1]
                if at < size and not _header(source, at):
                    yield Damage(at)
                continue
            yield Damage(at)
        at = _candidate(source, at + 1, size)
    return at


def _boundary(source: pa.NativeFile, start: int, size: int) -> int | None:
    """The first place not before ``start`` at which a record ends or begins, by reading the file up to there."""
    steps = _records(source, 0, start, size)
    while True:
        try:
            next(steps)
        except StopIteration as done:
            return done.value


def _candidate(source: pa.NativeFile, start: int, end: int) -> int | None:
    """The first place in [start, end) at which a record's header can be decoded."""
    at = _find(source, start, end)
    while at is not None and not _header(source, at):
        at = _find(source, at + 1, end)
    return at


def _find(source: pa.NativeFile, start: int, end: int) -> int | None:
    """Where the magic number next begins in [start, end)."""
    at = start
    while at < end:
        source.seek(at)
        piece = source.read(min(_READ, end - at) + len(MAGIC) - 1)
        hit = piece.find(MAGIC)
        if hit >= 0:
            return at + hit if at + hit < end else None
        at += _READ
    return None


def _header(source: pa.NativeFile, at: int) -> bool:
    source.seek(at)
    try:
        return zlib.decompressobj(31).decompress(source.read(_HEADER_BYTES), 5) == VERSION[:5]
    except zlib.error:
        return False


def _member(source: pa.NativeFile, at: int) -> tuple[bytes, int] | None:
    """The member at a place with a header, and where it ends; None if it is damaged or cut off."""
    source.seek(at)
    reader, parts, read = zlib.decompressobj(31), [], 0
    while not reader.eof:
        piece = source.read(max(_READ, min(read, 1 << 22)))
        if not piece:
            return None
        read += len(piece)
        try:
            parts.append(reader.decompress(piece))
        except zlib.error:
            return None
    return b"".join(parts), at + read - len(reader.unused_data)


_ID = re.compile(r"<urn:page:(-?\d+)>")
_SHA1 = re.compile(r"sha1:([A-Z2-7]{32})", re.IGNORECASE)


def parse(record: bytes) -> dict:
    """Fields of one record; raises ValueError if it has no length, is shorter than it says, or has another digest."""
    head, _, rest = record.partition(b"\r\n\r\n")
    named = _fields(head)
    name, kind = named.get("warc-record-id"), named.get("warc-type", "")
    if not named.get("content-length", "").isdigit() or len(rest) < int(named["content-length"]):
        raise ValueError(f"damaged record {name}")
    payload, sent = rest[:int(named["content-length"])], {}
    if named.get("content-type", "").lower().startswith("application/http"):
        first, _, payload = payload.partition(b"\r\n\r\n")
        sent = _fields(first)
    stated = _SHA1.fullmatch(named.get("warc-payload-digest", ""))
    digest = b32decode(stated[1].upper()).hex() if stated else None
    if kind != "revisit":
        found = hashlib.sha1(payload).hexdigest()
        if digest not in (None, found) and "transfer-encoding" not in sent:
            raise ValueError(f"damaged payload in {name}")
        digest = digest or found
    size = named.get("warc-payload-length") or (None if kind == "revisit" else len(payload))
    return {
        "page_id": _number(name), "record_type": kind, "refers_to": _number(named.get("warc-refers-to")),
        "payload_digest": digest, "payload_bytes": None if size is None else int(size),
        "url": named.get("warc-target-uri"), "payload": None if kind == "revisit" else payload, "record_id": name,
    }


def _fields(head: bytes) -> dict[str, str]:
    """Named fields below the first line, the names in lower case."""
    lines = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in lines}


def _number(name: str | None) -> int | None:
    found = _ID.fullmatch(name or "")
    return int(found[1]) if found else None


READ_SCHEMA = (
    "page_id long, record_type string, refers_to long, payload_digest string, payload_bytes long, url string, "
    "payload binary, record_id string, file string, at long"
)
_ARROW = {
    "page_id": pa.int64(), "record_type": pa.string(), "refers_to": pa.int64(), "payload_digest": pa.string(),
    "payload_bytes": pa.int64(), "url": pa.string(), "payload": pa.binary(), "record_id": pa.string(),
    "file": pa.string(), "at": pa.int64(),
}


def read_archives(
    spark: SparkSession, folder: str, listed: list[tuple[str, int]], split_bytes: int = 4 << 20,
    columns: tuple[str, ...] = tuple(_ARROW), report_damage: bool = False,
) -> DataFrame:
    """Records of the listed files (name, bytes), read in splits of ``split_bytes``; only ``columns`` leave the task.

    Damage raises an error that names the file and the place. With ``report_damage`` it is a row of record_type
    ``damaged`` instead, with its file and place; so is a record that can be decoded and not parsed.
    """
    store = Store(folder)
    kinds = [part.split() for part in READ_SCHEMA.split(", ")]
    schema = ", ".join(f"{name} {kind}" for name, kind in kinds if name in columns)
    arrow = pa.schema([(name, kind) for name, kind in _ARROW.items() if name in columns])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = store.open()
        for batch in batches:
            for split in batch.to_pylist():
                with files.open_input_file(f"{base}/{split['file']}") as source:
                    rows, held = [], 0
                    for row, size in found(source, split):
                        rows.append({name: row.get(name) for name in arrow.names})
                        held += size
                        if held > 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, arrow)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, arrow)

    def found(source: pa.NativeFile, split: dict) -> Iterator[tuple[dict, int]]:
        """Rows of a split, and the bytes of each record."""
        size = source.size()
        if split["start"] == 0 and size != split["bytes"]:
            yield damaged(split["file"], min(size, split["bytes"]), f"{size} bytes, not {split['bytes']}")
        for member in members(source, split["start"], min(split["stop"], size), size):
            if isinstance(member, Damage):
                yield damaged(split["file"], member.at, "no whole record")
                continue
            try:
                row = parse(member.data)
            except ValueError as e:
                yield damaged(split["file"], member.at, str(e))
            else:
                yield row | {"file": split["file"], "at": member.at}, len(member.data)

    def damaged(file: str, at: int, what: str) -> tuple[dict, int]:
        if not report_damage:
            raise ValueError(f"{file}, byte {at}: {what}")
        return {"record_type": "damaged", "file": file, "at": at}, 0

    sizes = spark.createDataFrame(listed, "file string, bytes long")
    splits = sizes.select("file", "bytes", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long")
    )).alias("start")).withColumn("stop", F.least("bytes", F.col("start") + split_bytes))
    n = max(1, sum(-(-size // split_bytes) for _, size in listed))
    return splits.repartition(min(n, 10_000)).mapInArrow(read, schema)

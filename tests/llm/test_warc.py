import base64
import hashlib
import io
import random
import zlib

import pyarrow as pa
import pytest

from activitymill.llm import warc
from activitymill.plans.shared import shared_folder

SCHEMA = "page_id long, url string, html string, size long, digest string, payload string"


def pages():
    big, other = "é" * 600, "x" * 2000
    html = [big, other, big, None, "", "small", "small", other, big + "!", "\r\n\r\n" * 300, "\x1f" * 1200, big]
    rows = [(i, f"http://a.b/{i} ü\r\nx", h, 1, "d", "p") for i, h in enumerate(html)]
    return rows + [rows[1], (None, None, other, 1, "d", "p"), (99, None, "long " * 200_000, 1, "d", "p")]


@pytest.mark.parametrize("split", [700, 4 << 20])
def test_round_trip(spark, split):
    folder, rows = shared_folder(spark), pages()
    listed = warc.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(2), folder)
    got = warc.read_archives(spark, folder, listed, split_bytes=split).collect()
    largest = {}
    for i, _, html, *_ in rows:
        key = (html or "").encode()
        largest[key] = max(largest.get(key, -1), -1 if i is None else i)
    expected = []
    for i, _, html, *_ in rows:
        body = (html or "").encode()
        again = len(body) >= 1000 and i != largest[body]
        expected.append((i, "revisit" if again else "response", largest[body] if again else None,
                         hashlib.sha1(body).hexdigest(), len(body), None if again else body))
    found = [(r.page_id, r.record_type, r.refers_to, r.payload_digest, r.payload_bytes,
              None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_members_are_owned_by_the_range_in_which_they_start():
    records = [warc._gzip(warc._record(k, None, b"x" * k, "00" * 20, None)) for k in range(40)]
    data = b"".join(records)
    source = pa.PythonFile(io.BytesIO(data), mode="r")
    whole = list(warc.members(source, 0, len(data), len(data)))
    assert len(whole) == 40 and all(isinstance(m, warc.Member) for m in whole)
    for step in (1, 13, 97, 1000):
        parts = [m for a in range(0, len(data), step) for m in warc.members(source, a, min(a + step, len(data)), len(data))]
        assert parts == whole


def test_false_candidates_are_passed_over():
    inner = warc.MAGIC + b"\x00" * 40 + zlib.compress(b"no record")
    plain = zlib.compressobj(0, zlib.DEFLATED, 31)  # stored, so that what is inside shows
    record = warc._record(1, None, b"a" + inner + warc._gzip(b"not a header") + b"z", "00" * 20, 7)
    first = plain.compress(record) + plain.flush()
    data = warc.MAGIC + b"junk" + first + warc._gzip(warc._record(2, None, b"", "00" * 20, 7))
    assert [(warc.parse(m.data)["page_id"] if isinstance(m, warc.Member) else m) for m in found(data)] == [warc.Damage(0), 1, 2]
    start = data.index(warc.MAGIC, 3)
    assert ids(found(data, start)) == [1, 2] and ids(found(data, start + 1)) == [2]


def found(data, start=0, end=None):
    source = pa.PythonFile(io.BytesIO(data), mode="r")
    return list(warc.members(source, start, len(data) if end is None else end, len(data)))


def ids(pieces):
    return [warc.parse(m.data)["page_id"] if isinstance(m, warc.Member) else "damage" for m in pieces]


def four(length=300):
    rng = random.Random(length)
    return [warc._gzip(warc._record(k, None, rng.randbytes(length), "00" * 20, 7)) for k in range(4)]


def plain(record):
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)
    return stored.compress(record) + stored.flush()


def nested(length=300):
    """A stored response whose payload is a record of its own."""
    inner = four(length)[0] + b"tail"
    return plain(warc._record(8, None, inner, hashlib.sha1(inner).hexdigest(), None))


@pytest.mark.parametrize("step", [7, 50, 211, 10_000])
@pytest.mark.parametrize("data, expected", [
    (lambda m: b"".join(m), [0, 1, 2, 3]),
    (lambda m: b"".join(m)[:-10], [0, 1, 2, "damage"]),
    (lambda m: b"".join(m)[:-1], [0, 1, 2, "damage"]),
    (lambda m: m[0] + m[1] + b"junk" + m[2] + m[3], [0, 1, "damage", 2, 3]),
    (lambda m: m[0] + m[1] + b"\0" * 900 + m[2] + m[3] + b"end", [0, 1, "damage", 2, 3, "damage"]),
    (lambda m: m[0] + m[1][:60] + b"????" + m[1][64:] + m[2] + m[3], [0, "damage", 2, 3]),
    (lambda m: m[0] + b"????" + m[1][4:] + m[2] + m[3], [0, "damage", 2, 3]),
    (lambda m: b"\x1f\x8b" + m[0] + m[1], ["damage", 0, 1]),
    (lambda m: m[0] + nested() + b"junk" + m[1], [0, 8, "damage", 1]),
    (lambda m: m[0] + nested() + m[1], [0, 8, 1]),
    (lambda m: b"nothing here", ["damage"]),
    (lambda m: b"", []),
])
def test_no_record_is_lost_without_being_told(data, expected, step):
    data = data(four())
    assert ids(found(data)) == expected
    parts = [m for a in range(0, len(data), step) for m in found(data, a, min(a + step, len(data)))]
    assert parts == found(data)


def test_damage_raises_or_is_reported(spark):
    folder = shared_folder(spark)
    listed = warc.write_archives(spark.createDataFrame(pages(), SCHEMA).coalesce(1), folder)
    (name, size), = listed
    files, path = warc.Store(folder).open()
    with files.open_input_file(f"{path}/{name}") as source:
        data = source.read()
    with files.open_output_stream(f"{path}/{name}", compression=None) as out:
        out.write(data[:-20])
    for split in (700, 4 << 20):
        for told in ([(name, size)], [(name, size - 20)]):
            with pytest.raises(Exception, match=f"{name}, byte"):
                warc.read_archives(spark, folder, told, split_bytes=split).collect()
            rows = warc.read_archives(spark, folder, told, split_bytes=split, report_damage=True).collect()
            assert sum(r.record_type != "damaged" for r in rows) == len(pages()) - 1
            assert all(r.file == name and r.at > 0 for r in rows if r.record_type == "damaged")


def test_records_of_another_writer(spark):
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/plain\r\n\r\nhello"
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nhello\r\n0\r\n\r\n"
    sha1 = "SHA1:" + base64.b32encode(hashlib.sha1(b"hello").digest()).decode()
    records = [
        (b"WARC/1.0", {"WARC-Type": "warcinfo", "WARC-Record-ID": "<urn:uuid:1>"}, b"software: x\r\n"),
        (b"WARC/1.0", {"warc-type": "response", "warc-record-id": "<urn:uuid:2>", "WARC-Target-URI": "http://a/",
                       "content-type": "application/http;msgtype=response", "WARC-Payload-Digest": sha1}, body),
        (b"WARC/1.1", {"WARC-Type": "response", "WARC-Record-ID": "<urn:uuid:3>",
                       "Content-Type": "application/http", "WARC-Payload-Digest": sha1}, chunked),
        (b"WARC/1.1", {"WARC-Type": "revisit", "WARC-Record-ID": "<urn:uuid:4>", "WARC-Refers-To": "<urn:uuid:2>",
                       "WARC-Payload-Digest": "md5:00"}, b""),
    ]
    data = b"".join(
        warc._gzip(version + b"".join(f"\r\n{k}:{v}".encode() for k, v in {**named, "Content-Length": len(body)}.items())
                   + b"\r\n\r\n" + body + b"\r\n\r\n") for version, named, body in records
    )
    folder = shared_folder(spark)
    files, path = warc.Store(folder).open()
    files.create_dir(path, recursive=True)
    with files.open_output_stream(f"{path}/other.warc.gz", compression=None) as out:
        out.write(data)
    rows = sorted(warc.read_archives(spark, folder, [("other.warc.gz", len(data))], split_bytes=100).collect(), key=lambda r: r.at)
    hello = hashlib.sha1(b"hello").hexdigest()
    assert [(r.page_id, r.record_type, r.record_id, r.payload_digest, r.payload_bytes, r.url) for r in rows] == [
        (None, "warcinfo", "<urn:uuid:1>", hashlib.sha1(records[0][2]).hexdigest(), 13, None),
        (None, "response", "<urn:uuid:2>", hello, 5, "http://a/"),
        (None, "response", "<urn:uuid:3>", hello, 15, None),
        (None, "revisit", "<urn:uuid:4>", None, None, None),
    ]
    short = b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: 9\r\n\r\nabc"
    with pytest.raises(ValueError, match="damaged record"):
        warc.parse(short)


def test_payloads_are_not_shuffled(spark):
    plan = warc.with_revisits(spark.createDataFrame(pages(), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_damaged_payload_is_told(spark):
    record = warc._record(1, None, b"abc", "00" * 20, None)
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(record)


def test_no_pages(spark):
    folder = shared_folder(spark)
    listed = warc.write_archives(spark.createDataFrame([], SCHEMA), folder)
    assert listed == [] and warc.read_archives(spark, folder, listed).collect() == []

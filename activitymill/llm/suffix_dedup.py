"""Removal of repeated byte strings by a collection suffix array that is built column by column.

Every byte that is covered by a ``length``-byte string which also starts elsewhere, in the same text or another, goes.

Which texts have to meet: each window of ``length`` bytes has an anchor, the place of the least hash among its first
``reach`` short substrings. Equal windows have their anchors at the same place inside them, and all windows of one
anchor share the ``length - reach + 1`` bytes from the anchor on, their core. So windows can only be equal if the
cores are, and only cores that occur at two places are looked at further.

Around each such anchor a segment is cut: the bytes before the core that its windows start in, symbols that stand for
the core, and the bytes after it. Segments of a group (equal cores) that are equal too are kept once, and the verdict on
a segment is joined back to its places. The others form
collections, over which the Burrows-Wheeler transform and the longest common prefixes are built as by Bauer, Cox and
Rosone: each round puts one more symbol of every segment, from its end to its start, into both, which are kept in
files that are read and written from front to back. A window has the same number of symbols here wherever it
starts, so it occurs elsewhere if its suffix shares that many with a neighbour in suffix order.

Equal texts are one text, all of which goes if it is as long as a window. A core with more than ``crowd`` places is
dealt out to several collections by its segments' hashes; windows are then compared across these by a digest, one row
per collection and distinct window, so no group is ever one task.

Defined cases: a null text is an empty one; texts shorter than a window lose nothing; row hashes of id and text tell
rows apart, so null ids and repeated rows are documents like others (a repeated row is a copy); other columns are
ignored by ``removals`` and kept by ``without_repeats``, where a text cut inside a character loses the rest of it. Very
long texts are read in pieces. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activitymill.llm import packed
from activitymill.llm.words import Texts, hash_spans, texts
from activitymill.llm.work import kept, unused

_PIECE = 1 << 21
_SEGMENTS = 1024  # of a collection, at least one group
_SPOTS = 20_000  # places that are gathered before their segments are sent on


@dataclass(frozen=True)
class Windows:
    length: int = 400
    reach: int = 128
    grain: int = 16  # bytes of the substrings that are compared for anchors

    @property
    def core(self) -> int:
        return self.length - self.reach + 1


# --- anchors ---------------------------------------------------------------------------------------------------


def _pieces(piece: Texts, w: Windows) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """bytes, offsets, first document and place of the first byte in it; a long text comes in overlapping pieces."""
    if len(piece) > 1 or len(piece.data) <= 2 * _PIECE:
        yield piece.data, piece.offsets, piece.first, 0
        return
    for start in range(0, len(piece.data) - w.length + 1, _PIECE):
        data = piece.data[start:start + _PIECE + w.length - 1]
        yield data, np.array([0, len(data)]), piece.first, start


def anchors(data: np.ndarray, offsets: np.ndarray, w: Windows) -> tuple[np.ndarray, ...]:
    """Of all windows: the document, the anchor, and the first and last window that have it."""
    places = len(data) - w.grain + 1
    none = np.zeros(0, np.int64)
    if places < w.reach:
        return none, none, none, none
    at = np.arange(places)
    bits = np.uint64(max(1, int(places).bit_length()))
    rank = (hash_spans(data, at, at + w.grain) >> bits << bits) | at.astype(np.uint64)
    width = -(-places // w.reach) * w.reach
    padded = np.full(width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:places] = rank
    table = padded.reshape(-1, w.reach)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    counts = np.maximum(np.diff(offsets) - w.length + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    window = np.arange(len(owner)) + np.repeat(offsets[:-1] - np.concatenate([[0], np.cumsum(counts)])[:-1], counts)
    least = np.minimum(behind[window], ahead[window + w.reach - 1])
    anchor = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    fresh = np.ones(len(window), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(window))[:len(first)] - 1
    return owner[first], anchor[first], window[first], window[last]


def _repeated_cores(rows: DataFrame, w: Windows, n: int) -> DataFrame:
    """Cores that occur at several places: text, first window (place), and how far anchor and last window are."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, out = set(), packed.Sender(n, sort=1)  # texts that this task has sent
        for batch in batches:
            names = batch.column("same").to_numpy()
            first = np.ones(len(names), bool)
            for k, name in enumerate(names.tolist()):
                first[k] = name not in done
                done.add(name)
            names = names[first]
            for piece in texts(batch.column("text").filter(pa.array(first))):
                for data, offsets, doc, start in _pieces(piece, w):
                    owner, anchor, low, high = anchors(data, offsets, w)
                    if len(owner):
                        base = offsets[:-1][owner] - start
                        more = (anchor - low) << 16 | (high - low)
                        yield from packed.occurrences(
                            out, hash_spans(data, anchor, anchor + w.core), names[doc + owner], low - base, more
                        )
        yield from out.flush()

    return packed.repeated(rows.select("same", "text").mapInArrow(send, packed.SCHEMA), n)


# --- collections -----------------------------------------------------------------------------------------------


class _File:
    """A column of numbers on disk, read and written from front to back."""

    def __init__(self, values: np.ndarray):
        self.dtype = values.dtype
        self.file = tempfile.TemporaryFile()
        self.write(values)

    def write(self, values: np.ndarray) -> None:
        self.file.seek(0)
        self.file.truncate()
        values.tofile(self.file)
        self.file.flush()

    def read(self) -> np.ndarray:
        self.file.seek(0)
        return np.fromfile(self.file, self.dtype)

    def close(self) -> None:
        self.file.close()


def _range_least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of values[low:high + 1] for each pair; low <= high."""
    step = 256
    out = np.empty(len(low), values.dtype)
    long = high - low > 4 * step
    padded = np.append(values, values.dtype.type(0))

    def least(of: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        ends = np.empty(2 * len(a), np.int64)
        ends[::2], ends[1::2] = a, b
        return np.minimum.reduceat(of, ends)[::2]

    short = ~long
    if short.any():
        out[short] = least(padded, low[short], high[short] + 1)
    if long.any():
        a, b = low[long], high[long] + 1
        whole = len(values) // step
        blocks = np.append(values[:whole * step].reshape(-1, step).min(axis=1), values.dtype.type(0))
        inner_a, inner_b = -(-a // step), b // step
        edge = np.minimum(least(padded, a, np.maximum(inner_a * step, a + 1)), padded[b - 1])
        tail = np.where(inner_b * step < b, least(padded, np.minimum(inner_b * step, b - 1), b), padded[b - 1])
        out[long] = np.minimum(np.minimum(edge, tail), least(blocks, inner_a, inner_b))
    return out


def shared_prefixes(symbols: np.ndarray, offsets: np.ndarray, cap: int) -> np.ndarray:
    """For the suffix at each symbol of each segment, how many symbols, up to ``cap``, it shares with the suffix of
    another start that shares most. Symbols are from 1 to 255; ends of segments differ from each other."""
    count, sizes = len(offsets) - 1, np.diff(offsets)
    end = offsets[1:]
    filled = sizes > 0
    begin = np.zeros(count, np.uint8)
    begin[filled] = symbols[end[filled] - 1]
    bwt, lcp = _File(begin), _File(np.zeros(count, np.uint8))
    try:
        active, at, j = np.flatnonzero(filled), np.flatnonzero(filled), 0
        while len(active):
            old, common = bwt.read(), lcp.read()
            order = np.argsort(old, kind="stable")
            place = np.empty(len(old), np.int32)
            place[order] = np.arange(len(old), dtype=np.int32)
            mine, symbol = place[at].astype(np.int64), old[at]
            ended = int(np.count_nonzero(old == 0))
            before = order[np.maximum(mine - 1, 0)]
            after = order[np.minimum(mine + 1, len(old) - 1)]
            has_before = (mine > 0) & (old[before] == symbol)
            has_after = (mine + 1 < len(old)) & (old[after] == symbol)
            prev, following = np.zeros(len(active), np.uint8), np.zeros(len(active), np.uint8)
            prev[has_before] = np.minimum(_range_least(common, before[has_before] + 1, at[has_before]), cap - 1) + 1
            following[has_after] = np.minimum(_range_least(common, at[has_after] + 1, after[has_after]), cap - 1) + 1
            j += 1
            goes_on = sizes[active] > j
            symbol = np.zeros(len(active), np.uint8)
            symbol[goes_on] = symbols[end[active[goes_on]] - 1 - j]
            to = count + mine - ended
            fresh = np.zeros(len(old) + len(active), bool)
            fresh[to] = True
            new, new_common = np.empty(len(fresh), np.uint8), np.empty(len(fresh), np.uint8)
            new[~fresh], new_common[~fresh] = old, common
            new[to], new_common[to] = symbol, prev
            next_old = to + 1 < len(fresh)
            next_old[next_old] = ~fresh[to[next_old] + 1]
            new_common[to[next_old] + 1] = following[next_old]
            bwt.write(new)
            lcp.write(new_common)
            active, at = active[goes_on], to[goes_on]
            sorted_by_place = np.argsort(at)
            active, at = active[sorted_by_place], at[sorted_by_place]
        final, common = bwt.read(), np.append(lcp.read(), np.uint8(0))
    finally:
        bwt.close()
        lcp.close()
    # From each segment's empty suffix on, the step to the suffix one longer.
    order = np.argsort(final, kind="stable")
    longer = np.empty(len(final), np.int64)
    longer[order] = np.arange(len(final)) + count - int(np.count_nonzero(final == 0))
    best = np.zeros(len(symbols), np.uint8)
    active, at = np.flatnonzero(filled), np.flatnonzero(filled)
    for j in range(1, int(sizes.max(initial=0)) + 1):
        at = longer[at]
        best[end[active] - j] = np.maximum(common[at], common[at + 1])
        on = sizes[active] > j
        active, at = active[on], at[on]
    return best


# --- segments and groups ---------------------------------------------------------------------------------------

_SEGMENT = (
    "core long, core2 long, part int, cut int, span int, body binary, segment long, same array<long>, place array<long>"
)


def _number(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def _segments(found: DataFrame, w: Windows, crowd: int) -> DataFrame:
    """Segments around repeated cores, from (same, text, spots): a row per some places and different segment, with
    those at which it is. ``segment`` is its hash; ``part`` is -1 but for crowded cores."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("core", pa.int64()), ("core2", pa.int64()), ("part", pa.int32()), ("cut", pa.int32()), ("span", pa.int32()),
            ("body", pa.binary()), ("segment", pa.int64()), ("same", pa.list_(pa.int64())), ("place", pa.list_(pa.int64())),
        ])

        def rows_of(merged: dict) -> pa.RecordBatch:
            rows = [
                (int.from_bytes(core[:8], "little", signed=True), int.from_bytes(core[8:], "little", signed=True),
                 _number(body) % parts if parts > 1 else -1, left, span, body,
                 _number(b"%s %d %d " % (core, left, span) + body), *spots)
                for (core, parts, left, span, body), spots in merged.items()
            ]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        held = 0
        merged: dict[tuple, tuple[list[int], list[int]]] = {}
        for batch in batches:
            for name, text, spots in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                data = text.as_buffer().to_pybytes()
                for spot in spots.as_py():
                    place, left, span = spot["place"], spot["more"] >> 16, spot["more"] & 0xFFFF
                    anchor = place + left
                    core = hashlib.blake2b(data[anchor:anchor + w.core], digest_size=16).digest()
                    body = data[place:anchor] + data[anchor + w.core:place + span + w.length]
                    key = (core, -(-spot["times"] // crowd), left, span, body)
                    names, places = merged.setdefault(key, ([], []))
                    names.append(name)
                    places.append(place)
                    held += 1
                if held > _SPOTS:
                    yield rows_of(merged)
                    merged, held = {}, 0
        if merged:
            yield rows_of(merged)

    return found.mapInArrow(cut, _SEGMENT)


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each run of true flags."""
    edges = np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1


class _Group:
    """The segments of one core, or of one part of a crowded one: hash to (cut, span, body, times)."""

    def __init__(self, core: tuple[int, int], crowded: bool):
        self.core, self.crowded = b"%d %d" % core, crowded
        self.segments: dict[int, list] = {}

    def add(self, segment: int, cut: int, span: int, body: bytes, times: int) -> None:
        known = self.segments.setdefault(segment, [cut, span, body, 0])
        known[3] += times


def _collection(groups: list[_Group]) -> tuple[np.ndarray, np.ndarray, int]:
    """Symbols and offsets of the segments of all groups with several, and how many symbols stand for a core.

    Bytes are numbered from 1 as they occur; cores are written with digits from the numbers that are left, which are
    at least 11 as UTF-8 has 243 different bytes.
    """
    several = [g for g in groups if len(g.segments) > 1]
    bodies = [(number, cut, body) for number, g in enumerate(several) for cut, _, body, _ in g.segments.values()]
    joined = np.frombuffer(b"".join(body for _, _, body in bodies), np.uint8)
    present = np.zeros(256, bool)
    present[joined] = True
    code = np.cumsum(present).astype(np.uint8)
    base = 255 - int(present.sum())
    digits = 1
    while base ** digits < len(several):
        digits += 1
    parts, sizes, at = [], [], 0
    coded = code[joined]
    for number, cut, body in bodies:
        own = coded[at:at + len(body)]
        at += len(body)
        name = [255 - number // base ** k % base for k in range(digits)]
        parts += [own[:cut], np.array(name, np.uint8), own[cut:]]
        sizes.append(len(body) + digits)
    return np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)]), digits


_VERDICT = pa.schema([
    ("segment", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("digest", pa.binary()), ("single", pa.bool_()),
])


def _judge(groups: list[_Group], w: Windows) -> Iterator[pa.RecordBatch]:
    """Runs of windows, counted from a segment's first, that occur elsewhere; for crowded cores also a row with a
    digest per window."""
    if any(len(g.segments) > 1 for g in groups):
        symbols, offsets, digits = _collection(groups)
        enough = w.reach - 1 + digits
        best = shared_prefixes(symbols, offsets, enough) >= enough
    rows, k = [], 0
    for group in groups:
        for segment, (cut, span, body, times) in group.segments.items():
            again = np.full(span + 1, times > 1)
            if len(group.segments) > 1:
                again |= best[offsets[k]:offsets[k] + span + 1]
                k += 1
            if again.all():
                rows.append((segment, 0, span, None, None))
            elif again.any():
                rows += [(segment, int(a), int(b), None, None) for a, b in zip(*_runs(again))]
            if group.crowded:
                for o in range(span + 1):
                    digest = hashlib.blake2b(
                        b"%s %d " % (group.core, cut - o) + body[o:cut + w.reach - 1 - (cut - o)], digest_size=16
                    ).digest()
                    rows.append((segment, o, o, digest, not again[o]))
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _VERDICT)], schema=_VERDICT)


def _ranges(segments: DataFrame, w: Windows, n: int) -> DataFrame:
    """Ranges of bytes to remove: text, start and stop."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group, waiting, size = None, None, [], 0
        for batch in batches:
            for core, core2, part, *segment in zip(*(c.to_pylist() for c in batch.columns)):
                if (core, core2, part) != key:
                    if group:
                        size += len(group.segments)
                        if size >= _SEGMENTS:
                            yield from _judge(waiting, w)
                            waiting, size = [], 0
                    key, group = (core, core2, part), _Group((core, core2), part >= 0)
                    waiting.append(group)
                group.add(*segment)
        if waiting:
            yield from _judge(waiting, w)

    sorted_segments = segments.select(
        "core", "core2", "part", "segment", "cut", "span", "body", F.array_size("same").alias("times")
    ).repartition(n, "core", "core2", "part").sortWithinPartitions("core", "core2", "part", "segment")
    judged = kept(sorted_segments.mapInArrow(
        run, "segment long, first int, last int, digest binary, single boolean"), "judged"
    )
    sure = judged.filter(F.col("digest").isNull()).select("segment", "first", "last")
    # Windows of crowded cores that are single in their part but not in all.
    several = judged.filter(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.count_if("single").alias("singles"), F.count("*").alias("times")
    ).filter((F.col("times") > 1) & (F.col("singles") > 0)).select("digest")
    late = judged.filter(F.col("single")).join(several, "digest", "left_semi").select("segment", "first", "last")
    runs = sure.unionByName(late)
    spots = segments.select("segment", F.explode(F.arrays_zip("same", "place")).alias("spot"))
    start = F.col("spot.place") + F.col("first")
    return spots.join(runs, "segment").select(
        F.col("spot.same").alias("same"), start.alias("start"),
        (F.col("spot.place") + F.col("last") + w.length).alias("stop"),
    )


# --- the operator ----------------------------------------------------------------------------------------------


def _marked(docs: DataFrame, w: Windows, crowd: int) -> tuple[DataFrame, DataFrame]:
    """Documents with the hash of their row (``rid``), and by that hash what goes: everything, or ranges."""
    n = packed.buckets(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64("doc_id", text).alias("rid"),
                       F.xxhash64(text, F.octet_length(text)).alias("same"))
    ids = kept(rows.select("rid", "same", F.octet_length("text").alias("size")), "ids")
    classes = ids.groupBy("same").agg(
        F.min("rid").alias("rid"), F.count("*").alias("copies"), F.max("size").alias("size")
    )
    spots = _repeated_cores(rows, w, n).groupBy(F.col("row").alias("same")).agg(
        F.collect_list(F.struct("place", "more", "times")).alias("spots")
    )
    wanted = spots.join(classes.select("same", "rid"), "same")
    found = rows.select("rid", "text").join(wanted, "rid").select("same", "text", "spots")
    ranges = _ranges(kept(_segments(found, w, crowd), "segments"), w, n)
    by_text = ranges.groupBy("same").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    gone = classes.select("same", ((F.col("copies") > 1) & (F.col("size") >= w.length)).alias("all")).join(
        by_text, "same", "left"
    ).filter(F.col("all") | F.col("ranges").isNotNull())
    slim = gone.withColumn("ranges", F.when(~F.col("all"), F.col("ranges")))
    by_row = ids.select("rid", "same").distinct().join(slim, "same").select("rid", "all", "ranges")
    return rows.select("rid", "doc_id", "text"), by_row


def _cut(data: bytes, everything: bool | None, ranges: list | None) -> tuple[bytes, int]:
    """What is left, and the number of runs that went."""
    if everything:
        return b"", 1
    if not ranges:
        return data, 0
    left, at, runs = [], 0, 0
    for start, stop in sorted((r["start"], r["stop"]) for r in ranges):
        if start > at or not runs:
            left.append(data[at:start])
            runs += 1
        at = max(at, stop)
    left.append(data[at:])
    return b"".join(left), runs


def removals(docs: DataFrame, windows: Windows = Windows(), crowd: int = 20_000) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and the SHA-256 of the bytes left."""
    rows, gone = _marked(docs, windows, crowd)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, everything, ranges in zip(*(batch.column(c) for c in ("text", "all", "ranges"))):
                data = text.as_buffer().to_pybytes()
                left, runs = _cut(data, everything.as_py(), ranges.as_py())
                out.append((len(data), len(data) - len(left), runs, hashlib.sha256(left).hexdigest()))
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return rows.join(gone, "rid", "left").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def without_repeats(docs: DataFrame, windows: Windows = Windows(), crowd: int = 20_000) -> DataFrame:
    """Documents with repeated bytes cut out of ``text``; all columns and rows are kept."""
    _, gone = _marked(docs, windows, crowd)
    rid, every, spans = (unused(docs, c) for c in ("_rid", "_all", "_ranges"))
    found = gone.select(F.col("rid").alias(rid), F.col("all").alias(every), F.col("ranges").alias(spans))
    joined = docs.withColumn(rid, F.xxhash64("doc_id", F.coalesce("text", F.lit("")))).join(found, rid, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = []
            for value, everything, ranges in zip(*(batch.column(c).to_pylist() for c in ("text", every, spans))):
                if value is not None and (everything or ranges):
                    value = _cut(value.encode(), everything, ranges)[0].decode(errors="ignore")
                new.append(value)
            names = [c for c in batch.schema.names if c not in (rid, every, spans)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(new, pa.string()) if c == "text" else batch.column(c) for c in names], names
            )

    return joined.mapInArrow(run, docs.schema)


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n
  FROM documents
), w AS (
  SELECT r, p, md5(array_slice(b, p, p + 399)) AS h FROM (SELECT r, b, unnest(range(1, n - 398)) AS p FROM d WHERE n >= 400)
), hit AS (
  SELECT r, p FROM w JOIN (SELECT h FROM w GROUP BY h HAVING count(*) > 1) USING (h)
), mark AS (
  SELECT r, p, CASE WHEN p <= lag(p) OVER (PARTITION BY r ORDER BY p) + 400 THEN 0 ELSE 1 END AS fresh FROM hit
), runs AS (
  SELECT r, min(p) AS a, max(p) + 400 AS z  -- bytes a to z - 1 go
  FROM (SELECT r, p, sum(fresh) OVER (PARTITION BY r ORDER BY p) AS g FROM mark) GROUP BY r, g
), gaps AS (
  SELECT r, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 1) AS x, a AS y FROM runs
  UNION ALL SELECT r, max(z), 9223372036854775807 FROM runs GROUP BY r
), left_over AS (
  SELECT r, unhex(coalesce(string_agg(hex(array_slice(b, x, least(y - 1, n))), '' ORDER BY x), '')) AS k
  FROM gaps JOIN d USING (r) WHERE x < y AND x <= n GROUP BY r
), gone AS (SELECT r, CAST(sum(z - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM runs GROUP BY r)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(CASE WHEN gone.r IS NULL THEN b ELSE coalesce(k, ''::BLOB) END) AS kept_sha256
FROM d LEFT JOIN gone USING (r) LEFT JOIN left_over USING (r)
"""

"""I-Match document fingerprints with randomised lexicons.

The lexicon holds the terms whose inverse document frequency is within a band: terms that at least ``rarest`` and at
most ``commonest`` of all documents have. A document's distinct lexicon terms, sorted, are hashed once for each of
several random subsets of the lexicon, in ``groups`` independent draws that keep all terms, a half, a quarter and so
on. A fingerprint is the row of these hashes; two fingerprints are as alike as the share of hashes that agree. Small
subsets survive edits that change a large one.

The lexicon is the only thing that is broadcast. It has at most (mean number of distinct words) / ``rarest`` terms
however many documents there are, since each of its terms takes up that share of all (document, word) pairs.

A document's successor in doc_id order, for ``with_next``, is found in one range exchange: the first document of each
range is also sent to the range before it.

Defined cases: a null text is an empty one, which has a fingerprint of its own that equals that of any text without a
word. Where a subset keeps no term of a document, its hash is that of all the document's words, so unrelated short
texts do not agree. Equal texts have equal fingerprints. Null ids sort first and equal ids by text. Other columns are
ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activitymill.llm import packed
from activitymill.llm.words import SLICE_BYTES, distinct, mix, texts

HALVINGS = 8
GROUPS = 4
_STEP = np.uint64(0x9E3779B97F4A7C15)


def lexicon(docs: DataFrame, rarest: float = 0.001, commonest: float = 0.2) -> np.ndarray:
    """Sorted hashes of the terms in the band, counted over all documents."""
    spark = docs.sparkSession
    n = packed.buckets(spark)
    total = docs.count()
    low, high = max(1.0, rarest * total), commonest * total

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = packed.Sender(n, sort=0)
        for batch in batches:
            for piece in texts(batch.column("text"), 4 * SLICE_BYTES):
                words = piece.words()
                own, _, _ = distinct(words.hashes(), words.offsets)
                keys, times = np.unique(own, return_counts=True)
                yield from out.add(packed.to_bucket(keys, n), keys, times.astype(np.uint32))
        yield from out.flush()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        waiting, held = [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            every = np.concatenate([keys, *[k for k, _ in waiting]])
            each = np.concatenate([counts, *[c.astype(np.int64) for _, c in waiting]])
            found, place = np.unique(every, return_inverse=True)
            return found, np.bincount(place, each, minlength=len(found)).astype(np.int64)

        for records in (r for batch in batches for r in batch.column("records")):
            waiting.append(packed.columns_of(records, "<u8", "<u4"))
            held += len(waiting[-1][0])
            if held > max(1_000_000, len(keys)):
                (keys, counts), waiting, held = merged(), [], 0
        keys, counts = merged()
        kept = keys[(counts >= low) & (counts <= high)]
        yield pa.RecordBatch.from_pydict({"term": kept.view(np.int64)})

    sent = packed.deal(docs.select("text").mapInArrow(count, packed.SCHEMA), n)
    terms = sent.mapInArrow(add, "term long").toArrow().column("term")
    return np.sort(terms.to_numpy().astype(np.int64).view(np.uint64))


def _sequence_hash(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hash of each document's values in their order."""
    sizes = np.diff(offsets)
    power = np.multiply.accumulate(np.full(max(1, int(sizes.max(initial=0))), _STEP, np.uint64))
    rank = np.arange(len(values)) - np.repeat(offsets[:-1], sizes)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mix(values) * power[rank], out=sums[1:])
    return mix(sums[offsets[1:]] - sums[offsets[:-1]] + sizes.astype(np.uint64))


def fingerprints(column: pa.Array, terms: np.ndarray) -> np.ndarray:
    """A row of 32-bit hashes per text."""
    rows = [np.zeros((0, GROUPS * HALVINGS), np.uint32)]
    for piece in texts(column):
        words = piece.words()
        own, offsets, _ = distinct(words.hashes(), words.offsets)
        everything = _sequence_hash(own, offsets)
        out = np.empty((len(piece), GROUPS * HALVINGS), np.uint32)
        place = np.minimum(np.searchsorted(terms, own), max(0, len(terms) - 1))
        inside = terms[place] == own if len(terms) else np.zeros(len(own), bool)
        owner = np.repeat(np.arange(len(piece)), np.diff(offsets))
        own, owner = own[inside], owner[inside]
        for g in range(GROUPS):
            value, of, draw = own, owner, mix(own ^ np.uint64(g + 1))
            for h in range(HALVINGS):
                keep = draw & np.uint64((1 << h) - 1) == 0
                value, of, draw = value[keep], of[keep], draw[keep]
                ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(piece)))])
                salt = np.uint64(g * HALVINGS + h + 1)
                part = mix(_sequence_hash(value, ends) ^ salt)
                none = ends[1:] == ends[:-1]
                part[none] = mix(everything[none] ^ mix(np.full(1, salt)))
                out[:, g * HALVINGS + h] = (part >> np.uint64(32)).astype(np.uint32)
        rows.append(out)
    return np.concatenate(rows)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def _text(prints: np.ndarray) -> list[str]:
    return [row.astype(">u4").tobytes().hex() for row in prints]


def fingerprint(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """doc_id and fingerprint of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = fingerprints(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_text(prints))], ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string")


def in_ranges(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, text, ``part`` and ``guest``: ranges of doc_id, each sorted and followed by the first document of the
    next one (the last by the first of all) as its guest."""
    ids = docs.select("doc_id")
    cuts = docs.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.2 / n) if n > 1 else []
    cuts = np.array(sorted(set(cuts)))

    @F.pandas_udf("int")
    def part(values: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, values.fillna(-np.inf), "left"), dtype="int32")

    bounds = ids.select("doc_id", part("doc_id").alias("part")).groupBy("part").agg(
        F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("nulls")
    ).orderBy("part").collect()  # one row per range
    first = docs.sparkSession.createDataFrame(
        [(r.part, r.least, r.nulls, bounds[i - 1].part) for i, r in enumerate(bounds)],
        "part int, least long, nulls boolean, before int",
    )
    placed = docs.select("doc_id", "text", part("doc_id").alias("part")).join(F.broadcast(first), "part")
    is_first = F.when(F.col("nulls"), F.col("doc_id").isNull()).otherwise(F.col("doc_id") == F.col("least"))
    home = F.struct("part", F.lit(False).alias("guest"))
    there = F.struct(F.col("before").alias("part"), F.lit(True).alias("guest"))
    sent = placed.select("doc_id", "text", F.inline(F.when(is_first, F.array(home, there)).otherwise(F.array(home))))
    return sent.repartition(n, "part").sortWithinPartitions("part", "guest", F.col("doc_id").asc_nulls_first(), "text")


def with_next(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next document's are.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many of the next document.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(terms)

    def compare(rows: list[tuple]) -> pa.RecordBatch:
        """Of each row but the last, which only follows."""
        own = [text for _, text in rows]
        edited = [a[:len(a) - len(a) // 2] + b[:len(a) // 2] for a, b in zip(own, own[1:])]
        prints = fingerprints(pa.array(own, pa.string()), shared.value)
        changed = fingerprints(pa.array(edited, pa.string()), shared.value)
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array([i for i, _ in rows[:-1]], pa.int64()),
            "n_chars": pa.array([len(t) for t in own[:-1]], pa.int64()),
            "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
            "fingerprint": _text(prints[:-1]),
            "edited_fingerprint": _text(changed),
            "near_edited": likeness(prints[:-1], changed),
            "near_next": likeness(prints[:-1], prints[1:]),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, at, ended = [], 0, None, False
        for batch in batches:
            for doc_id, text, part, guest in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if part != at:
                    rows, size, at, ended = [], 0, part, False
                if ended:  # only the first guest follows
                    continue
                rows.append((doc_id, text or ""))
                size += len(text or "")
                ended = guest
                if len(rows) > 1 and (guest or size > SLICE_BYTES):
                    yield compare(rows)
                    rows, size = rows[-1:], len(rows[-1][1])

    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return in_ranges(docs, packed.buckets(spark)).mapInArrow(run, schema)

"""Language-model scoring with a log-frequency Bloom filter.

Unigrams and bigrams are counted over all training documents. A count c is quantised to a level 1 + floor(log2 c), and
an n-gram is put into the filter once per level up to its own. Reading an n-gram probes level after level until one is
missing; the level reached stands for the middle of its range. All unigrams and bigrams are in the filter, those seen
once too, at every level.

The filters are in segments, one per bucket of n-grams. A segment has the bits that its exact number of insertions needs
for a false reading of a level with probability ``FALSE``. It is read where it is: texts are packed into chunks, a chunk
sends each of its distinct words and bigrams to a bucket once, with how often they are in its training texts, and gets
back a count and a level. Then the chunk's texts are scored where all replies to it come together. What is sent grows
with the distinct n-grams of chunks, whatever the number of buckets, and no bucket gets an n-gram more than once per chunk.

P(w | u) = (1 - mass) p(w) + mass min(1, c(u w) / c(u)), with p(w) = (c(w) + 0.5) / (R + 0.5 (V + 1)) and every count
read from the filter; V is exact, and R is the sum of what the filter should read over all V words, so that p sums to 1
over them and one unseen word. The first word of a text has p(w). Reading the middle of a level is at most 3/2 of a count
and at least 3/4 of it, so the second term sums to at most twice ``mass`` over the words after u: what P sums to is
between 1 - mass and 1 + mass (after a word not seen in training, 1 - mass), but for false readings, of which a filter has ``FALSE`` a level.

The base score needs exact counts of every word of every document; these are what the words' buckets reply with. The
documents themselves are read once and written in chunks, which are read twice and shuffled once, compressed.

Words are hashed to 64 bits (48 of them and the bucket for unigrams, 32 and the bucket for bigrams). Defined cases: a
null or empty text has one token, its end; a null id is in the training part; repeated rows are documents of their own
(they count as often and each gets its row); other columns are ignored. With no training tokens p(w) is 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activitymill.llm import packed
from activitymill.llm.work import kept
from activitymill.llm.words import Words, mix, texts

PROBES = 4
FALSE = 0.005
LEVELS = 48
_END = np.uint64(0x9D5C1A7E3B2F4861)  # the hash of the end token
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def tokens(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes with each document's end, and the documents' offsets."""
    counts = np.diff(words.offsets)
    offsets = words.offsets + np.arange(len(words.offsets))
    out = np.full(offsets[-1], _END)
    out[np.arange(len(words.starts)) + np.repeat(np.arange(len(counts)), counts)] = words.hashes()
    return out, offsets


def bigrams(found: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each token with the one before it, and which tokens have one before them."""
    second = np.ones(len(found), bool)
    second[offsets[:-1]] = False
    before = np.zeros_like(found)
    before[1:] = found[:-1]
    before[~second] = 0
    return mix(before * _PAIR + found), second


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    """By bits 48 to 63, which the key kept in a bucket may then do without."""
    return ((keys >> np.uint64(48)) % np.uint64(n)).astype(np.int32)


def _positions(keys: np.ndarray, level: int, probe: int, bits: int | np.ndarray) -> np.ndarray:
    """Place in a bucket's segment of the filter, from the lower 32 bits of a key."""
    low = keys & _LOW
    return mix(low * np.uint64(LEVELS) + np.uint64(level) + np.uint64(probe << 44)) % np.asarray(bits, np.uint64)


def bits_for(counts: np.ndarray) -> int:
    """Bits of a segment in which a level that is not there reads as there with probability ``FALSE``."""
    insertions = int(level_of(counts).sum())
    return max(64, -int(insertions * PROBES / np.log1p(-FALSE ** (1 / PROBES)) // 8) * 8)


def segment(keys: np.ndarray, counts: np.ndarray, bits: int) -> np.ndarray:
    """A bucket's part of the filter: n-grams at every level up to their own."""
    out = np.zeros(bits, bool)
    levels = level_of(counts)
    for level in range(1, int(levels.max(initial=0)) + 1):
        keys, levels = keys[levels >= level], levels[levels >= level]
        for probe in range(PROBES):
            out[_positions(keys, level, probe, bits).astype(np.int64)] = True
    return np.packbits(out, bitorder="little")


@dataclass(frozen=True)
class Counts:
    """A filter in segments, one per bucket, end to end."""

    data: np.ndarray  # uint8
    buckets: int
    bits: int | np.ndarray  # of all segments, or of each
    first: int = 0  # the bucket of the first segment here

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Levels of n-grams, 0 for those that are not in the filter; all are of buckets that are here."""
        bits = np.full(self.buckets, self.bits) if np.ndim(self.bits) == 0 else self.bits
        own = bucket_of(keys, self.buckets).astype(np.int64) - self.first
        start = (np.cumsum(bits) - bits)[own] // 8
        bits = bits[own].astype(np.uint64)
        out = np.zeros(len(keys), np.int64)
        alive = np.arange(len(keys))
        for level in range(1, LEVELS):
            for probe in range(PROBES):
                at = _positions(keys[alive], level, probe, bits[alive]).astype(np.int64)
                hit = self.data[start[alive] + (at >> 3)] >> (at & 7).astype(np.uint8) & 1
                alive = alive[hit.astype(bool)]
            if not len(alive):
                break
            out[alive] = level
        return out

    def read(self, keys: np.ndarray) -> np.ndarray:
        """Counts of n-grams, 0 for those that are not in the filter."""
        return middle(self.levels(keys))


def level_of(counts: np.ndarray) -> np.ndarray:
    """Level k holds the counts from 2 ** (k - 1) to 2 ** k - 1."""
    return np.frexp(counts.astype(float))[1].astype(np.int64)


def middle(level: np.ndarray) -> np.ndarray:
    """What a level is read as, the middle of its counts."""
    return np.where(level > 0, 0.75 * 2.0 ** level - 0.5, 0.0)


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    each = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    found, place = np.unique(every, return_inverse=True)
    return found, np.bincount(place, each, minlength=len(found)).astype(np.int64)


_CHUNK = 8 << 20  # bytes of the documents of a chunk, if they are several
_ROW = 16  # bytes that a document counts besides its text
_REPLIES_AT_ONCE = 64
_WORD_BITS, _PAIR_BITS = 48, 32  # what is kept of a hash besides its bucket
_CHUNKS = "chunk long, documents binary"
_KEYS = "bucket int, chunk long, words int, pairs int, records binary"
_REPLIES = "chunk long, bucket int, words int, pairs int, records binary, v long, n long, reads double"


def _squeezed(*columns: np.ndarray) -> bytes:
    """Columns of numbers, compressed. Bytes of the same weight stand together, as most of the upper ones are zeros."""
    planes = (c.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns)
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _numbers(records: pa.Scalar, *sizes: int) -> list[np.ndarray]:
    """The columns that ``_squeezed`` has compressed, of these sizes."""
    data = np.frombuffer(pa.decompress(records.as_buffer(), decompressed_size=8 * sum(sizes), codec="zstd"), np.uint8)
    ends = 8 * np.cumsum(sizes)
    return [data[end - 8 * k:end].reshape(8, k).T.copy().view("<u8").ravel() for end, k in zip(ends, sizes)]


def _chunks(docs: DataFrame, size: int) -> DataFrame:
    """Neighbouring documents as one compressed row, numbered; of about ``size`` bytes or a single document."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting, held = [], 0

        def packed_row() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, waiting[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(pa.Table.from_batches(waiting).combine_chunks())
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["chunk", "documents"]
            )

        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64) + _ROW)
            start, before = 0, 0
            while start < batch.num_rows:
                stop = int(np.searchsorted(ends, before + size - held, "right"))
                if stop == start and not waiting:
                    stop += 1
                if stop > start:
                    waiting.append(batch.slice(start, stop - start))
                    held += int(ends[stop - 1]) - before
                    start, before = stop, int(ends[stop - 1])
                if start < batch.num_rows:
                    yield packed_row()
                    number += 1
                    waiting, held = [], 0
        if waiting:
            yield packed_row()

    return docs.select("doc_id", "held_out", "text").mapInArrow(pack, _CHUNKS)


@dataclass(frozen=True)
class _Chunk:
    """Documents of a chunk as tokens, whose words and bigrams point to the chunk's distinct ones. These stand bucket
    by bucket, each with its bucket above the bits that are kept of it."""

    documents: pa.Table
    offsets: np.ndarray  # of the documents' tokens
    second: np.ndarray  # tokens that have one before them
    words: np.ndarray
    word: np.ndarray  # of each token
    pairs: np.ndarray
    pair: np.ndarray  # of each second token with the one before it

    @classmethod
    def of(cls, documents: pa.Scalar, n: int) -> _Chunk:
        table = pa.ipc.open_stream(documents.as_buffer()).read_all()
        found, ends = [], [np.zeros(1, np.int64)]
        for piece in texts(table.column("text")):
            own, offsets = tokens(piece.words())
            found.append(own)
            ends.append(offsets[1:] + ends[-1][-1])
        found, offsets = np.concatenate(found), np.concatenate(ends)
        both, second = bigrams(found, offsets)
        return cls(table, offsets, second, *_placed(found, n, _WORD_BITS), *_placed(both[second], n, _PAIR_BITS))


def _placed(keys: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    low = keys & np.uint64((1 << bits) - 1)
    return np.unique(bucket_of(keys, n).astype(np.uint64) << np.uint64(bits) | low, return_inverse=True)


def _counted(chunks: DataFrame, n: int) -> DataFrame:
    """Replies of the buckets: to chunks, packed, the training count and the filter's level of each word sent, and the
    filter's level of each bigram; and a row without a chunk with the figures of the bucket's words."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, documents in zip(batch.column("chunk").to_pylist(), batch.column("documents")):
                chunk = _Chunk.of(documents, n)
                held_out = chunk.documents.column("held_out").to_numpy().astype(bool)
                trains = np.repeat(~held_out, np.diff(chunk.offsets))
                every = []
                for keys, place, of, bits in (
                    (chunk.words, chunk.word, trains, _WORD_BITS), (chunk.pairs, chunk.pair, trains[chunk.second], _PAIR_BITS)
                ):
                    times = np.bincount(place[of], minlength=len(keys))
                    ends = np.searchsorted(keys, np.arange(n + 1, dtype=np.uint64) << np.uint64(bits))
                    ends[n] = len(keys)  # 2 ** 16 buckets would not fit
                    every.append((keys & np.uint64((1 << bits) - 1), times, ends))
                rows = []
                for bucket in range(n):
                    columns = []
                    for low, times, ends in every:
                        own = slice(ends[bucket], ends[bucket + 1])
                        columns += [np.diff(low[own], prepend=np.uint64(0)), times[own]]
                    if len(columns[0]) + len(columns[2]):
                        rows.append((bucket, number, len(columns[0]), len(columns[2]), _squeezed(*columns)))
                yield _batch(rows, _KEYS)

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket: dict[int, list] = {}
        for batch in batches:
            for bucket, *row in zip(*(c.to_pylist() for c in batch.columns[:4]), batch.column("records")):
                by_bucket.setdefault(bucket, []).append(row)
        for bucket in sorted(by_bucket):
            rows = by_bucket.pop(bucket)
            word, times, pair, pair_times = (list(c) for c in zip(*(_keys_of(records, w, p) for _, w, p, records in rows)))
            words, counts, levels = _filled(word, times)
            pairs, _, pair_levels = _filled(pair, pair_times)
            reads = float(middle(level_of(counts[counts > 0])).sum())
            out = [(None, bucket, 0, 0, b"", int((counts > 0).sum()), int(counts.sum()), reads)]
            for chunk, w, p, records in rows:
                word, _, pair, _ = _keys_of(records, w, p)
                word, pair = np.searchsorted(words, word), np.searchsorted(pairs, pair)
                out.append((chunk, bucket, w, p, _squeezed(counts[word], levels[word], pair_levels[pair]), None, None, None))
                if len(out) == _REPLIES_AT_ONCE:
                    yield _batch(out, _REPLIES)
                    out = []
            yield _batch(out, _REPLIES)

    sent = packed.deal(chunks.mapInArrow(send, _KEYS), n)
    return sent.mapInArrow(receive, _REPLIES)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows) if rows else ([] for _ in fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [f for f, _ in fields])


def _keys_of(records: pa.Scalar, words: int, pairs: int) -> tuple[np.ndarray, ...]:
    """A row's words, how often they occur in the training part, and the same of bigrams."""
    word, times, pair, pair_times = _numbers(records, words, words, pairs, pairs)
    return np.cumsum(word, dtype=np.uint64), times.astype(np.int64), np.cumsum(pair, dtype=np.uint64), pair_times.astype(np.int64)


def _filled(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of a bucket, their training counts, and their levels as read from the bucket's segment of the filter."""
    found, count = _merge(keys, counts)
    trained = count > 0
    bits = bits_for(count[trained])
    return found, count, Counts(segment(found[trained], count[trained], bits), 1, bits).levels(found)


def _scores(chunks: DataFrame, replies: DataFrame, id_type: str, n: int, reads: float, vocabulary: int, mass: float) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, base (the sum of log10(c + 0.5) over training counts c) and score."""

    def score(documents: pa.Table, answers: pa.Table) -> pa.Table:
        every = []
        for row in documents.column("documents"):  # one row
            chunk = _Chunk.of(row, n)
            order = np.argsort(answers.column("bucket").to_numpy())
            columns = [answers.column(c).combine_chunks() for c in ("words", "pairs", "records")]
            parts = []
            for k in order.tolist():
                words, pairs = columns[0][k].as_py(), columns[1][k].as_py()
                parts.append(_numbers(columns[2][k], words, words, pairs))
            counts, levels, pair_levels = (np.concatenate(c).astype(np.int64) for c in zip(*parts))
            count, level = counts[chunk.word], levels[chunk.word]
            left = np.zeros(len(level), np.int64)
            left[1:] = level[:-1]
            left = left[chunk.second]
            p = (middle(level) + 0.5) / (reads + 0.5 * (vocabulary + 1))
            # A word that reads as unseen has no words after it, whatever the filter says of the pair.
            seen = np.minimum(1.0, (left > 0) * middle(pair_levels[chunk.pair]) / np.maximum(middle(left), 1.0))
            p[chunk.second] = (1 - mass) * p[chunk.second] + mass * seen
            start = chunk.offsets[:-1]
            every.append(pa.table({
                "doc_id": chunk.documents.column("doc_id"), "held_out": chunk.documents.column("held_out"),
                "n_tokens": np.diff(chunk.offsets), "n_known": np.add.reduceat((count > 0).astype(np.int64), start),
                "base": np.add.reduceat(np.log10(count + 0.5), start),
                "score": np.add.reduceat(np.log10(np.minimum(p, 1.0)), start),
            }))
        return pa.concat_tables(every)

    return chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        score, f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, base double, score double"
    )


def score_documents(docs: DataFrame, *, filter_bits: int = 1 << 30, mass: float = 0.25) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    ``filter_bits`` was how much of the unigram filter is broadcast at a time. None of it is any more; it had no
    influence on what is scored.
    """
    n = packed.buckets(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), is_held_out(F.col("doc_id")).alias("held_out"))
    chunks = kept(_chunks(rows, _CHUNK), "chunks")
    replies = kept(_counted(chunks, n), "replies")
    totals = replies.filter("chunk IS NULL").agg(F.sum("n").alias("n"), F.sum("v").alias("v"), F.sum("reads").alias("reads")).first()
    total, vocabulary, reads = totals.n or 0, totals.v or 0, totals.reads or 0.0
    answers = replies.filter("chunk IS NOT NULL").select("chunk", "bucket", "words", "pairs", "records")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    spread = F.log10(F.lit(total + 0.5 * (vocabulary + 1)))
    return _scores(chunks, answers, id_type, n, reads, vocabulary, mass).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * spread).alias("base_score"), "score",
    )

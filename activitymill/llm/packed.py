"""Exchange of many small fixed-width records between tasks, packed into a few rows.

Text operators shuffle hundreds of records per document. As rows of their own these cost the JVM far more than their
bytes; packed, a row holds many records that a task sends to one bucket. Spark still partitions and shuffles the rows
and does them again when executors are lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SCHEMA = "bucket int, records binary"
_HEAD = 8  # bytes before a row's records
_ARROW = pa.schema([("bucket", pa.int32()), ("records", pa.binary())])


def buckets(spark: SparkSession) -> int:
    """As many as shuffle partitions, the figure that is set to fit the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def deal(df: DataFrame, n: int) -> DataFrame:
    """Bring each bucket's rows together, one bucket to a partition: by a hash, some would hold several and some none."""
    return df.repartitionById(n, "bucket")


def to_bucket(keys: np.ndarray, n: int) -> np.ndarray:
    """By the upper bits, so that a bucket's keys still differ in the lower ones."""
    return ((keys >> np.uint64(40)) % np.uint64(n)).astype(np.int32)


class Sender:
    """Gathers a task's columns of records and packs them by bucket, ``size`` bytes at a time.

    However many buckets there are, a task makes one row per bucket and ``size`` bytes. Within a bucket, records stand
    column by column, in the order of ``sort`` (a column's place), so that equal neighbours are compressed: by Spark, or
    with ``squeeze`` here already and closer, for where disk matters more than time.
    """

    def __init__(self, n: int, sort: int, size: int = 12 << 20, squeeze: bool = False):
        self.n, self.sort, self.size, self.squeeze = n, sort, size, squeeze
        self.waiting: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def add(self, bucket: np.ndarray, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.waiting.append((bucket, *columns))
        self.held += sum(c.nbytes for c in columns)
        if self.held >= self.size:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        bucket, *columns = (np.concatenate(c) for c in zip(*self.waiting))
        self.waiting, self.held = [], 0
        order = np.lexsort((columns[self.sort], bucket))
        bucket, columns = bucket[order], [c[order] for c in columns]
        at = np.flatnonzero(np.diff(bucket, prepend=-1))
        ends = np.append(at[1:], len(bucket))
        rows = [self._packed(b"".join(c[a:b].tobytes() for c in columns)) for a, b in zip(at, ends)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[at].astype(np.int32)), pa.array(rows, pa.binary())], schema=_ARROW
        )

    def _packed(self, data: bytes) -> bytes:
        """The bytes behind their number, if they are compressed, or a zero."""
        if not self.squeeze:
            return bytes(_HEAD) + data
        return len(data).to_bytes(_HEAD, "little") + pa.compress(data, codec="zstd", asbytes=True)


def columns_of(records: pa.Scalar, *kinds: str) -> list[np.ndarray]:
    """The columns of a row that a ``Sender`` has packed."""
    packed, types = records.as_buffer(), [np.dtype(k) for k in kinds]
    size, data = int.from_bytes(packed[:_HEAD], "little"), packed.slice(_HEAD)
    if size:
        data = pa.decompress(data, decompressed_size=size, codec="zstd")
    count, at, out = data.size // sum(t.itemsize for t in types), 0, []
    for t in types:
        out.append(np.frombuffer(data, t, count, at))
        at += count * t.itemsize
    return out


OCCURRENCE = np.dtype([("key", "<u8"), ("row", "<i8"), ("place", "<u4"), ("more", "<u4")])


def occurrences(
    out: Sender, key: np.ndarray, row: np.ndarray, place: np.ndarray, more: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """Send where keys occur, for ``repeated``; ``out`` sorts by the second column."""
    yield from out.add(to_bucket(key, out.n), key, row, place.astype(np.uint32), more.astype(np.uint32))


def places(records: pa.Scalar) -> np.ndarray:
    """Occurrences of a row, as records."""
    columns = columns_of(records, "<u8", "<i8", "<u4", "<u4")
    out = np.empty(len(columns[0]), OCCURRENCE)
    for name, column in zip(OCCURRENCE.names, columns):
        out[name] = column
    return out


def repeated(sent: DataFrame, n: int) -> DataFrame:
    """Of packed occurrences, those whose key occurs at more than one (row, place): row, place, more, key and
    ``times``, how many such places the key has.

    Tasks send a place once. A key that a third of all documents have makes as many records in its bucket; these are a
    few bytes each, and a bucket holds many keys.
    """

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for bucket, records in zip(batch.column("bucket").to_pylist(), batch.column("records")):
                by_bucket.setdefault(bucket, []).append(places(records))
        for bucket in sorted(by_bucket):
            every = np.concatenate(by_bucket.pop(bucket))
            order = np.argsort(every["key"], kind="stable")
            key = every["key"][order]
            same = np.zeros(len(key) + 1, bool)
            same[1:-1] = key[1:] == key[:-1]
            chosen = every[order[same[:-1] | same[1:]]]  # keys that come more than once
            chosen = chosen[np.lexsort((chosen["place"], chosen["row"], chosen["key"]))]
            fresh = np.ones(len(chosen), bool)
            for name in ("key", "row", "place"):
                fresh[1:] &= chosen[name][1:] == chosen[name][:-1]
            fresh[1:] = ~fresh[1:]
            chosen = chosen[fresh]
            _, which, times = np.unique(chosen["key"], return_inverse=True, return_counts=True)
            again = times[which] > 1
            chosen, times = chosen[again], times[which][again]
            yield pa.RecordBatch.from_arrays([
                pa.array(chosen["row"]), pa.array(chosen["place"].astype(np.int64)),
                pa.array(chosen["more"].astype(np.int64)), pa.array(chosen["key"].view(np.int64)), pa.array(times),
            ], ["row", "place", "more", "key", "times"])

    return deal(sent, n).mapInArrow(receive, "row long, place long, more long, key long, times long")

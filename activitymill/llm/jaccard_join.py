"""Similarity join of documents by the Jaccard index of their word shingles, with Bayesian candidate pruning.

1. A document becomes its set of five-word shingles. Documents with equal sets are one class, so copies are one row.
2. MinHash values in bands name candidates: classes that share a band are tied to the smallest of them, and what is
   connected is a candidate cluster. With 48 bands of 7 values, a pair at 0.8 shares none with probability 1e-5.
3. A cluster is cut into blocks of classes, and each pair of blocks is one unit of work, so a cluster with a third of
   all documents is many units. Pairs exist only inside a unit's arrays, never as rows.
4. In a unit, MinHash values are compared a few at a time. With a flat prior, the chance that the index reaches the
   threshold given m equal values of n follows a Beta distribution; pairs for which it is below ``tolerance`` are
   dropped. For the pairs that are left the exact index is computed from the sets.
5. Units give, per class, how many documents it is linked to, and its component within the unit. Components of these
   are the groups.

Defined cases: a null or empty text has no shingle; all such documents are one class that is linked to nothing else. A
text of one to four words has one shingle, all its words. Rows are told apart by a hash of id and text, so null ids and
repeated rows are documents like others. A class's or group's id is its smallest doc_id. Words are lower-cased (A-Z)
runs other than space and 0x09 to 0x0D; sets are of 64-bit hashes. Other columns are ignored by ``links`` and kept by
``one_of_each``. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activitymill.llm.components import components
from activitymill.llm.work import kept, unused
from activitymill.llm.words import Texts, distinct, mix, shingles, texts

BANDS, ROWS = 48, 7
BLOCK = 512  # classes
_STEP = 16  # values compared at a time
_C = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = (mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * _C) | np.uint64(1)).astype(np.uint32)


def sets(piece: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each document, and their offsets."""
    found, offsets, _ = distinct(*shingles(piece.words()))
    return found, offsets


def set_ids(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mix(values + _C), out=sums[1:])
    return mix(sums[offsets[1:]] - sums[offsets[:-1]] + np.diff(offsets).astype(np.uint64)).view(np.int64)


def signatures(values: np.ndarray, offsets: np.ndarray, count: int = BANDS * ROWS) -> np.ndarray:
    """MinHash values, a row per document; those of an empty set are all the greatest."""
    out = np.full((len(offsets) - 1, count), 0xFFFFFFFF, np.uint32)
    filled = np.flatnonzero(np.diff(offsets))
    if len(filled):
        small = (values ^ (values >> np.uint64(32))).astype(np.uint32)
        starts = offsets[:-1][filled]
        for k in range(count):
            out[filled, k] = np.minimum.reduceat(small * _FACTORS[k], starts)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A key per document and band."""
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(signature), BANDS)).copy()
    banded = signature.reshape(len(signature), BANDS, ROWS)
    for r in range(ROWS):
        key = mix(key * _C + banded[:, :, r])
    return key.view(np.int64)


def fewest_matches(threshold: float, tolerance: float, values: int = BANDS * ROWS, step: int = _STEP) -> dict[int, int]:
    """For each number n of values compared, the fewest matches m for which P(index >= threshold | m, n) is at least
    ``tolerance`` under a flat prior."""
    grid = (np.arange(20_000) + 0.5) / 20_000
    above, out = grid >= threshold, {}
    for n in range(step, values + 1, step):
        m = np.arange(n + 1)[:, None]
        density = m * np.log(grid) + (n - m) * np.log1p(-grid)
        density = np.exp(density - density.max(axis=1, keepdims=True))
        chance = density[:, above].sum(axis=1) / density.sum(axis=1)
        out[n] = int(np.argmax(chance >= tolerance))
    return out


def _with_rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64("doc_id", text).alias("rid"))


def _sketches(rows: DataFrame) -> DataFrame:
    """doc_id, rid, the class and the band keys of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in texts(batch.column("text")):
                values, offsets = sets(piece)
                keys = band_keys(signatures(values, offsets))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), BANDS).cast(pa.list_(pa.int64()))
                some = pa.array(np.diff(offsets) > 0)
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).slice(piece.first, len(piece)) for c in ("doc_id", "rid")),
                    pa.array(set_ids(values, offsets)), pc.if_else(some, lists, pa.scalar([], lists.type)),
                ], ["doc_id", "rid", "class", "keys"])

    return rows.mapInArrow(run, "doc_id long, rid long, class long, keys array<long>")


def _candidates(sketched: DataFrame) -> DataFrame:
    """Candidate clusters: class and cluster, for classes that share a band with another."""
    keyed = sketched.select("class", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("class").alias("first"), F.max("class").alias("last"))
    shared = shared.filter(F.col("first") < F.col("last")).select("key", "first")
    tied = keyed.join(shared, "key").select(F.col("class").alias("a"), F.col("first").alias("b"))
    return components(tied).select(F.col("node").alias("class"), F.col("root").alias("cluster"))


class _Unit:
    """Classes of one pair of blocks."""

    def __init__(self, rows: list[dict], fewest: dict[int, int], threshold: float):
        self.names = np.array([r["class"] for r in rows], np.int64)
        self.copies = np.array([r["copies"] for r in rows], np.int64)
        self.blocks = np.array([r["block"] for r in rows], np.int64)
        self.sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
        self.fewest, self.threshold = fewest, threshold

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of places whose index reaches the threshold."""
        i, j = np.triu_indices(len(self.names), 1)
        if self.blocks.min() != self.blocks.max():  # pairs within a block belong to that block's own unit
            apart = self.blocks[i] != self.blocks[j]
            i, j = i[apart], j[apart]
        sizes = np.array([len(s) for s in self.sets])
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        values = np.concatenate(self.sets) if len(self.sets) else np.zeros(0, np.uint64)
        signature = signatures(values, offsets)
        matches, at = np.zeros(len(i), np.int32), 0
        for n, least in self.fewest.items():
            matches += (signature[i, at:n] == signature[j, at:n]).sum(axis=1, dtype=np.int32)
            left = matches >= least
            i, j, matches, at = i[left], j[left], matches[left], n
        if not len(i):
            return i, j
        common = self._common(values, sizes, np.union1d(i, j))[i, j]
        similar = common >= self.threshold * (sizes[i] + sizes[j] - common) - 1e-9
        return i[similar], j[similar]

    def _common(self, values: np.ndarray, sizes: np.ndarray, used: np.ndarray) -> np.ndarray:
        """Number of shared shingles of all pairs of the places used, by products of incidence matrices."""
        owner = np.repeat(np.arange(len(sizes)), sizes)
        wanted = np.zeros(len(sizes), bool)
        wanted[used] = True
        values, owner = values[wanted[owner]], owner[wanted[owner]]
        _, column, times = np.unique(values, return_inverse=True, return_counts=True)
        shared = times[column] > 1
        column, owner = column[shared], owner[shared]
        names, column = np.unique(column, return_inverse=True)
        out, width = np.zeros((len(sizes), len(sizes)), np.float32), 4096
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        for start in range(0, len(names), width):
            a, b = np.searchsorted(column, [start, start + width])
            here, place = np.unique(owner[a:b], return_inverse=True)
            part = np.zeros((len(here), width), np.float32)
            part[place, column[a:b] - start] = 1
            out[np.ix_(here, here)] += part @ part.T
        return out


def _roots(count: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest place of the component of each place."""
    root = np.arange(count)
    while True:
        least = root.copy()
        np.minimum.at(least, i, root[j])
        np.minimum.at(least, j, root[i])
        least = least[least]
        if (least == root).all():
            return root
        root = least


def _linked(rows: DataFrame, clustered: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Per class and unit: links to documents of other classes, and a tie to the unit's component."""
    fewest = fewest_matches(threshold, tolerance)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in texts(batch.column("text")):
                values, offsets = sets(piece)
                data = [values[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).slice(piece.first, len(piece)) for c in ("class", "cluster", "copies", "blocks")),
                    pa.array(data, pa.binary()),
                ], ["class", "cluster", "copies", "blocks", "shingles"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, unit = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["cluster"], row["i"], row["j"]) != key:
                    if len(unit) > 1:
                        yield _compared(_Unit(unit, fewest, threshold))
                    key, unit = (row["cluster"], row["i"], row["j"]), []
                if not unit or row["class"] != unit[-1]["class"]:
                    unit.append(row)
        if len(unit) > 1:
            yield _compared(_Unit(unit, fewest, threshold))

    members = rows.select("rid", "text").join(clustered, "rid").drop("rid")
    found = members.mapInArrow(read, "class long, cluster long, copies long, blocks int, shingles binary")
    block = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    units = found.withColumn("block", block).withColumn("other", other).select(
        "cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "class",
        "copies", "shingles",
    )
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_units = units.repartition(n, "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "class")
    return sorted_units.mapInArrow(compare, "class long, links long, tie long")


def _compared(unit: _Unit) -> pa.RecordBatch:
    i, j = unit.links()
    links = np.bincount(i, unit.copies[j], len(unit.names)) + np.bincount(j, unit.copies[i], len(unit.names))
    root = _roots(len(unit.names), i, j)
    on = links > 0
    return pa.RecordBatch.from_arrays([
        pa.array(unit.names[on]), pa.array(links[on].astype(np.int64)), pa.array(unit.names[root[on]]),
    ], ["class", "links", "tie"])


def links(docs: DataFrame, threshold: float = 0.8, tolerance: float = 1e-7) -> DataFrame:
    """Per document: doc_id, class_id, copies (documents of its class), links (other documents whose index reaches
    ``threshold``, copies included) and group_id (what links connect). ``rid`` names the row."""
    rows = _with_rows(docs)
    sketched = kept(_sketches(rows), "sketches")
    classes = sketched.groupBy("class").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("copies"), F.min("rid").alias("rid")
    )
    clusters = kept(_candidates(sketched), "clusters")
    sizes = clusters.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    clustered = clusters.join(sizes, "cluster").join(classes, "class").select(
        "rid", "class", "cluster", "copies", "blocks"
    )
    linked = kept(_linked(rows, clustered, threshold, tolerance), "linked")
    groups = components(linked.select(F.col("class").alias("a"), F.col("tie").alias("b"))).select(
        F.col("node").alias("class"), F.col("root").alias("root")
    )
    counted = linked.groupBy("class").agg(F.sum("links").alias("links"))
    named = (
        classes.drop("rid").join(counted, "class", "left").join(groups, "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
    )
    named = kept(named, "named")
    least = named.groupBy("root").agg(F.min("class_id").alias("group_id"))
    whole = named.join(least, "root").select(
        "class", "class_id", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "group_id",
        "root",
    )
    return sketched.select("doc_id", "rid", "class").join(whole, "class").select(
        "doc_id", "class_id", "copies", "links", "group_id", "rid", "root"
    )


def one_of_each(docs: DataFrame, threshold: float = 0.8, tolerance: float = 1e-7) -> DataFrame:
    """The documents that are left when one of each group stays, that with the smallest doc_id (nulls last, then by
    the row's hash)."""
    found = links(docs, threshold, tolerance)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("first"))
    rid = unused(docs, "_rid")
    stays = first.select(F.col("first.rid").alias(rid))
    marked = docs.withColumn(rid, F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    # Repeated rows are equal in id and text; any one of them stays.
    return marked.join(stays, rid, "left_semi").dropDuplicates([rid]).drop(rid)


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT doc_id, list_sort(list_distinct(CASE
      WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END)) AS g
  FROM w
), c AS MATERIALIZED (
  SELECT md5(array_to_string(g, chr(10))) AS k, any_value(g) AS g, min(doc_id) AS class_id, count(*) AS copies
  FROM s GROUP BY 1
), u AS (SELECT k, len(g) AS n, unnest(g) AS x FROM c),
e AS MATERIALIZED (
  SELECT a.k AS a, b.k AS b FROM u AS a JOIN u AS b ON a.x = b.x AND a.k <> b.k
  GROUP BY a.k, b.k, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9
), reach AS (
  SELECT k, k AS r FROM c UNION SELECT reach.k, e.b FROM reach JOIN e ON reach.r = e.a
), named AS (
  SELECT reach.k, min(class_id) AS group_id FROM reach JOIN c ON c.k = reach.r GROUP BY reach.k
), counted AS (SELECT e.a AS k, sum(c.copies) AS links FROM e JOIN c ON c.k = e.b GROUP BY e.a)
SELECT s.doc_id, c.class_id, c.copies, CAST(coalesce(links, 0) + copies - 1 AS BIGINT) AS links, group_id
FROM s JOIN c ON c.k = md5(array_to_string(s.g, chr(10))) JOIN named USING (k) LEFT JOIN counted USING (k)
"""

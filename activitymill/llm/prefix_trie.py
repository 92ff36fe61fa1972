"""Trie over the beginnings of conversations: how many share each beginning, and what sharing it saves.

A beginning of d turns is known by a 128-bit digest that a turn at place d extends, so digests are running sums of
what single turns add and a long conversation is worked on in bands of ``band`` turns. Conversations are dealt over
shards, each band of one as a piece; a shard holds the beginnings of its pieces in a table of its own, whose slots
come from a minimal perfect hash over their digests. Everything that is summed over subtrees is a sum over members, so
a beginning that a third of all conversations share stands in many shards, and Spark adds up what they found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from activitymill.llm.ordered import numbered
from activitymill.llm.words import mix
from activitymill.llm.work import kept

BAND = 4096
SHARD_ROWS = 200_000
NODE = ["depth", "p1", "p2"]
EMPTY_SHA256 = hashlib.sha256().hexdigest()


class SlotTable:
    """Distinct 128-bit keys on the numbers 0 to n - 1, without gaps.

    Level by level, keys that are alone in their cell of a bitmap get the cell's rank as slot; the others go on to the
    next level. A slot keeps its key, so looking up a key that is not there is noticed.
    """

    def __init__(self, p1: np.ndarray, p2: np.ndarray):
        self.levels: list[tuple[np.ndarray, int]] = []
        self.p1, self.p2 = np.empty_like(p1), np.empty_like(p2)
        left, done = np.arange(len(p1)), 0
        while len(left):
            cell = self._cells(p1[left], p2[left], len(self.levels), size := 2 * len(left) + 1)
            alone = np.bincount(cell, minlength=size) == 1
            rank = np.where(alone, np.cumsum(alone) - 1 + done, -1)
            self.levels.append((rank, size))
            placed = alone[cell]
            slot = rank[cell[placed]]
            self.p1[slot], self.p2[slot] = p1[left[placed]], p2[left[placed]]
            done += int(placed.sum())
            left = left[~placed]
            if len(self.levels) > 60:
                raise ValueError("a key is there twice")

    @staticmethod
    def _cells(p1: np.ndarray, p2: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = mix(np.array([level + 1], np.uint64))
        return (mix((p1.view(np.uint64) ^ seed) + mix(p2.view(np.uint64))) % np.uint64(size)).astype(np.int64)

    def slots(self, p1: np.ndarray, p2: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 for keys that are not in the table."""
        out = np.full(len(p1), -1)
        left = np.arange(len(p1))
        for level, (rank, size) in enumerate(self.levels):
            if not len(left):
                break
            found = rank[self._cells(p1[left], p2[left], level, size)]
            out[left[found >= 0]] = found[found >= 0]
            left = left[found < 0]
        there = out >= 0
        there[there] = (self.p1[out[there]] == p1[there]) & (self.p2[out[there]] == p2[there])
        return np.where(there, out, -1)


def rebuilt(conversations: DataFrame, fives: int = 5, most: int = 9) -> DataFrame:
    """Turns of every conversation c after its beginning was exchanged: the first h = crc32(c) % ``most`` turns of
    conversation c - c % ``fives``, then c's own turns after its first h. Returns conv_id, depth (from 1; a row of
    depth 0 stands for the conversation), n_turns, x1 and x2 (128 bits of role and text), bytes (of the text).

    Turns are ordered by turn (null first), role and text. Null roles and texts are empty. Rows without conv_id belong
    to no conversation and are left out.
    """
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    rows = numbered(turns, "conv_id", ["turn", "role", "text"], {
        "x1": F.xxhash64(digest), "x2": F.xxhash64(F.lit("second"), digest),
        "bytes": F.octet_length("text").cast("long"),
    })
    sizes = rows.groupBy("conv_id").agg((F.max("pos") + 1).alias("n"))
    exchanged = sizes.select(
        "conv_id", "n", (F.col("conv_id") - F.col("conv_id") % fives).alias("base"),
        (F.crc32(F.col("conv_id").cast("string")) % most).alias("h"),
    ).join(sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base")), "base", "left")
    head = F.least("h", F.coalesce("n_base", F.lit(0)))
    exchanged = exchanged.select(
        "conv_id", "base", "h", head.alias("head"), (head + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns")
    )
    what = ["conv_id", "n_turns", "depth", "x1", "x2", "bytes"]
    firsts = rows.filter((F.col("conv_id") % fives == 0) & (F.col("pos") < most - 1)).withColumnRenamed("conv_id", "base")
    heads = exchanged.join(firsts, "base").filter(F.col("pos") < F.col("head")).withColumn("depth", F.col("pos") + 1)
    owns = rows.join(exchanged, "conv_id").filter(F.col("pos") >= F.col("h"))
    owns = owns.withColumn("depth", F.col("pos") - F.col("h") + F.col("head") + 1)
    tops = exchanged.select("conv_id", "n_turns", *(F.lit(0).cast("long").alias(c) for c in what[2:]))
    return tops.unionByName(heads.select(*what)).unionByName(owns.select(*what))


def paths(turns: DataFrame, band: int = BAND) -> DataFrame:
    """The beginning that each turn completes: p1 and p2, its digest, and q1 and q2, that of the beginning before it.

    A digest is the exclusive or of what each turn adds at its place, within a band first and then over bands.
    """
    turns = turns.withColumn("band", F.floor(F.col("depth") / band)).withColumns({
        c: F.when(F.col("depth") == 0, F.lit(0)).otherwise(F.xxhash64("depth", c)) for c in ("x1", "x2")
    })
    within = Window.partitionBy("conv_id", "band").orderBy("depth")
    before = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = turns.filter(F.col("n_turns") >= band).groupBy("conv_id", "band").agg(
        F.bit_xor("x1").alias("y1"), F.bit_xor("x2").alias("y2"))
    bands = bands.select("conv_id", "band", *(F.bit_xor(c).over(before).alias(c) for c in ("y1", "y2")))
    done = turns.withColumns({f"p{k}": F.bit_xor(f"x{k}").over(within) for k in (1, 2)})
    done = done.join(bands.filter(F.col("band") > 0), ["conv_id", "band"], "left")
    digest = {f"p{k}": F.col(f"p{k}").bitwiseXOR(F.coalesce(f"y{k}", F.lit(0))) for k in (1, 2)}
    done = done.withColumns(digest)
    return done.select(
        "conv_id", "n_turns", "band", *NODE, *(F.col(f"p{k}").bitwiseXOR(F.col(f"x{k}")).alias(f"q{k}") for k in (1, 2)),
        "bytes",
    )


def _later(found: DataFrame, nodes: DataFrame, band: int) -> DataFrame:
    """What the bands after one add to the last beginning of that band, per shard: only long conversations have any."""
    long = found.filter(F.col("n_turns") >= band)
    own = nodes.groupBy("conv_id", F.floor(F.col("depth") / band).alias("band")).agg(
        F.sum("bytes").alias("once"), F.sum("leaf").alias("leaves"))
    sums = long.groupBy("conv_id", "band").agg(F.sum("bytes").alias("every")).join(own, ["conv_id", "band"], "left")
    after = Window.partitionBy("conv_id").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        "conv_id", "band",
        F.sum(F.col("every") - F.coalesce("once", F.lit(0))).over(after).alias("more_saved"),
        F.sum(F.coalesce("leaves", F.lit(0))).over(after).alias("more_leaves"),
    ).filter(F.col("more_saved").isNotNull())
    last = long.filter(F.col("depth") % band == band - 1).join(sums, ["conv_id", "band"])
    return last.groupBy("shard", *NODE).agg(F.sum("more_saved").alias("more_saved"), F.sum("more_leaves").alias("more_leaves"))


def _accumulated(shard: pa.Table) -> pa.Table:
    """Of one shard's beginnings: their leaves, saved bytes and children as far as this shard has them, and the
    parent's conv_id."""
    column = {name: shard.column(name).to_numpy() for name in shard.column_names}
    table = SlotTable(column["p1"], column["p2"])
    n, slot = shard.num_rows, table.slots(column["p1"], column["p2"])
    flat = {name: np.empty(n, np.int64) for name in ("depth", "conv_id", "saved", "leaves", "owned", "inner")}
    for name in flat:
        flat[name][slot] = column[name]
    parent = np.full(n, -1)
    parent[slot] = np.where(column["inner"] > 0, table.slots(column["q1"], column["q2"]), -1)
    if ((parent < 0) & (flat["inner"] > 0)).any():
        raise ValueError("a beginning's parent is not in its shard")
    children = np.zeros(n, np.int64)
    linked = np.flatnonzero(parent >= 0)
    np.add.at(children, parent[linked], flat["owned"][linked])
    by_depth = linked[np.argsort(flat["depth"][linked], kind="stable")]
    edges = np.flatnonzero(np.diff(flat["depth"][by_depth], prepend=-1))
    for level in np.split(by_depth, edges)[:0:-1]:  # the deepest first
        np.add.at(flat["saved"], parent[level], flat["saved"][level])
        np.add.at(flat["leaves"], parent[level], flat["leaves"][level])
    return pa.table({
        "depth": flat["depth"], "p1": table.p1, "p2": table.p2, "leaves": flat["leaves"], "saved": flat["saved"],
        "children": children, "parent_conv_id": pa.array(flat["conv_id"][parent], mask=parent < 0),
    })


def _hashed_ends(ends: DataFrame) -> DataFrame:
    """SHA-256 of the conv_ids that end in each beginning. One value depends on all ids in order, so a beginning's ids
    pass through one task, as a stream of which only the hash is held."""
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*NODE, "conv_id"]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, open_key, digest = [*NODE, "ends_sha256"], None, None
        for batch in batches:
            out: list[tuple] = []
            for *key, conv_id in zip(*(batch.column(c).to_pylist() for c in order)):
                if key != open_key:
                    if digest is not None:
                        out.append((*open_key, digest.hexdigest()))
                    open_key, digest = key, hashlib.sha256()
                    digest.update(b"%d" % conv_id)
                else:
                    digest.update(b",%d" % conv_id)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*open_key, digest.hexdigest())], names)

    dealt = ends.select(*order).repartition(n, *NODE).sortWithinPartitions(*order)
    return dealt.mapInArrow(stream, "depth long, p1 long, p2 long, ends_sha256 string")


def trie(turns: DataFrame, band: int = BAND, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A row per different beginning of ``turns`` (as ``rebuilt`` returns them): conv_id (the smallest member), depth,
    parent_conv_id (null at the root), n_convs, n_children, n_leaves, saved_tokens (over the subtree, bytes of a
    beginning's last text for each member but one), ends_sha256 (of the members that end here, in order). An empty
    table has no beginnings, not even the root.
    """
    found = kept(paths(turns, band), "paths")
    shards = max(1, -(-found.count() // shard_rows))
    found = found.withColumn("shard", F.pmod(F.xxhash64("conv_id", "band"), F.lit(shards)).cast("int"))
    ends = (F.col("depth") == F.col("n_turns")).cast("long")
    local = kept(found.groupBy("shard", *NODE).agg(
        F.count(F.lit(1)).alias("members"), F.min("conv_id").alias("least"), F.sum(ends).alias("ends"),
        *(F.max(c).alias(c) for c in ("q1", "q2", "bytes", "band")),
    ), "local")
    nodes = kept(local.groupBy(*NODE).agg(
        F.sum("members").alias("n_convs"), F.min(F.struct("least", "shard")).alias("first"),
        (F.sum("members") == F.sum("ends")).cast("long").alias("leaf"),
        *(F.max(c).alias(c) for c in ("q1", "q2", "bytes")),
    ).select("*", F.col("first.least").alias("conv_id"), F.col("first.shard").alias("owner")).drop("first"), "nodes")

    owned = (F.col("shard") == F.col("owner")).cast("long")
    tabled = local.join(nodes.select(*NODE, "conv_id", "owner", "leaf"), NODE)
    tabled = tabled.join(_later(found, nodes, band), ["shard", *NODE], "left").select(
        "shard", *NODE, "q1", "q2", "conv_id", owned.alias("owned"), (F.col("depth") % band > 0).cast("long").alias("inner"),
        (F.col("bytes") * (F.col("members") - owned) + F.coalesce("more_saved", F.lit(0))).alias("saved"),
        (owned * F.col("leaf") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
    )
    sums = tabled.groupBy("shard").applyInArrow(
        _accumulated, "depth long, p1 long, p2 long, leaves long, saved long, children long, parent_conv_id long")
    # Where a band begins, the parent is in another piece.
    before = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"),
                          F.col("conv_id").alias("parent_conv_id"))
    first = nodes.filter((F.col("depth") > 0) & (F.col("depth") % band == 0))
    zero = F.lit(0).cast("long")
    sums = sums.unionByName(first.join(before, ["depth", "q1", "q2"]).select(
        *NODE, zero.alias("leaves"), zero.alias("saved"), zero.alias("children"), "parent_conv_id"))
    sums = sums.unionByName(first.groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2"))
                            .agg(F.count(F.lit(1)).alias("children"))
                            .withColumns({"leaves": zero, "saved": zero, "parent_conv_id": F.lit(None).cast("long")}))
    sums = sums.groupBy(*NODE).agg(
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"), F.sum("children").alias("n_children"),
        F.max("parent_conv_id").alias("parent_conv_id"),
    )
    hashed = _hashed_ends(found.filter(F.col("depth") == F.col("n_turns")))
    return nodes.join(sums, NODE).join(hashed, NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )


ORACLE_SQL = """
WITH RECURSIVE t AS (
  SELECT conv_id, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS turn_of,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(turn_of ORDER BY k) AS turns FROM t GROUP BY conv_id),
h AS (SELECT *, (xor(4294967295, list_reduce([4294967295] || list_transform(split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT)),
        lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0],
          lambda d, z: CASE WHEN d % 2 = 1 THEN xor(d // 2, 3988292384) ELSE d // 2 END))) % 9) AS h FROM c),
r AS (SELECT h.conv_id, list_concat(coalesce(list_slice(b.turns, 1, CAST(h.h AS INTEGER)), []), list_slice(h.turns, CAST(h.h + 1 AS INTEGER), len(h.turns))) AS path
      FROM h LEFT JOIN c b ON b.conv_id = h.conv_id - h.conv_id % 5),
p AS (SELECT conv_id, len(path) AS n, d AS depth, list_slice(path, 1, CAST(d AS INTEGER)) AS node FROM r, LATERAL (SELECT unnest(range(len(path) + 1)) AS d)),
g AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, bool_and(n = depth) AS leaf,
             string_agg(CASE WHEN n = depth THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id) AS ends
      FROM p GROUP BY node, depth),
w AS (SELECT *, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * octet_length(encode(node[-1].text)) END AS saved FROM g),
s AS (SELECT v.node, sum(w.saved) AS saved_tokens, count(*) FILTER (w.leaf) AS n_leaves, count(*) FILTER (w.depth = v.depth + 1) AS n_children
      FROM w v JOIN w ON w.depth >= v.depth AND list_slice(w.node, 1, CAST(v.depth AS INTEGER)) = v.node GROUP BY v.node)
SELECT w.conv_id, CAST(w.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, CAST(w.n_convs AS BIGINT) AS n_convs, CAST(n_children AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(w.ends, '')) AS ends_sha256
FROM w JOIN s USING (node) LEFT JOIN w u ON w.depth > 0 AND u.depth = w.depth - 1 AND u.node = list_slice(w.node, 1, CAST(w.depth - 1 AS INTEGER))
"""

"""Cheapest repair of a conversation's structure, by the method of Four Russians.

A row is one symbol: its role's kind, and whether it has to go or its text is cut off. What the rest of a conversation
costs from each state of the wanted pattern is a vector of four numbers. Less its smallest, it takes few values, so the
steps of all vectors under all blocks of ``BLOCK`` symbols fit a table. A conversation is read from its end, a block
per lookup; then it is read from its start, each block looked up again under the vector behind it, which gives the
edits in it. Of edits that cost the same the ASCII-least is taken: what is still to come is known by then, and no two
edits of one letter lead from a state to different ones, so the first letter that keeps the cost is the right one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activitymill.llm.ordered import numbered
from activitymill.llm.work import kept

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLOCK = 4
PIECE = 4096

# A row's symbol: the kind of its role (system, user, assistant or another) by letter, in capitals where its text is
# cut off; digits stand for the same kinds of rows that have to go.
SYMBOLS = "suaxSUAX0123"
START, SYSTEM, USER, ASSISTANT = range(4)  # states: nothing yet, or what came last
TURN = (USER, USER, ASSISTANT, USER)  # what a user's or assistant's turn leads to
WANTED = frozenset("su ua au".split())
EMPTY_SHA256 = hashlib.sha256().hexdigest()


def _kept_to(state: int, symbol: str) -> int | None:
    """The state after a row is kept, or None where it may not be."""
    kind = symbol.lower()
    if kind == "s":
        return SYSTEM if state == START else None
    return TURN[state] if kind == ("a" if TURN[state] == ASSISTANT else "u") else None


def _with_inserts(costs: list[int]) -> list[int]:
    """Cost from each state where turns may be put in first; after two of them states repeat."""
    out = list(costs)
    for state in range(4):
        to = state
        for n in (1, 2):
            to = TURN[to]
            out[state] = min(out[state], n * INSERT + costs[to])
    return out


END = tuple(_with_inserts([0, 10**6, 10**6, 0]))  # an empty conversation and one that ends with the assistant are right


def _row(symbol: str, after: tuple[int, ...]) -> list[dict[str, tuple[int, int]]]:
    """Per state, the edits of a row without inserts: letter to (cost with all that follows, next state)."""
    out = []
    for state in range(4):
        edits = {"D": (DELETE + after[state], state)}
        if not symbol.isdigit():
            cut = TRUNCATED if symbol.isupper() else 0
            edits["R"] = (REROLE + cut + after[TURN[state]], TURN[state])
            if (to := _kept_to(state, symbol)) is not None:
                edits["K"] = (KEEP + cut + after[to], to)
        out.append(edits)
    return out


def _before(symbol: str, after: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(_with_inserts([min(cost for cost, _ in edits.values()) for edits in _row(symbol, after)]))


def _normal(costs: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    least = min(costs)
    return tuple(c - least for c in costs), least


class Blocks:
    """The table of steps, and the edits of the blocks that were met."""

    def __init__(self, size: int = BLOCK):
        self.size = size
        self.vectors, number = [_normal(END)[0]], {_normal(END)[0]: 0}
        steps, lifts = [], []
        for vector in self.vectors:  # grows while it is read, until no step leads to a new vector
            found = [_normal(_before(symbol, vector)) for symbol in SYMBOLS]
            for to, _ in found:
                if to not in number:
                    number[to] = len(self.vectors)
                    self.vectors.append(to)
            steps.append([number[to] for to, _ in found])
            lifts.append([lift for _, lift in found])
        self.one_step, one_lift = np.array(steps), np.array(lifts)
        # The last symbol of a block is the first that is read; a symbol more in front is one more step.
        step, lift = self.one_step, one_lift
        tables = [(step, lift)]
        for _ in range(size - 1):
            lift = (lift[:, None, :] + one_lift[step].transpose(0, 2, 1)).reshape(len(steps), -1)
            step = self.one_step[step].transpose(0, 2, 1).reshape(len(steps), -1)
            tables.append((step, lift))
        # Per length of block: its symbols as a number, the first the most significant.
        self.tables = [
            {"".join(block): (step[:, k].tolist(), lift[:, k].tolist()) for k, block in enumerate(product(SYMBOLS, repeat=n + 1))}
            for n, (step, lift) in enumerate(tables)
        ]
        self.traced: dict[tuple[str, int, int], tuple[str, int]] = {}

    def solve(self, symbols: str) -> tuple[int, str]:
        """The least cost, and the edits' letters."""
        cuts = range(0, len(symbols), self.size)
        blocks = [symbols[k:k + self.size] for k in cuts]
        vector, cost, behind = 0, min(END), []
        for block in reversed(blocks):
            behind.append(vector)
            step, lift = self.tables[len(block) - 1][block]
            cost += lift[vector]
            vector = step[vector]
        cost += self.vectors[vector][START]
        state, audit = START, []
        for block in blocks:
            key = (block, behind.pop(), state)
            if key not in self.traced:
                self.traced[key] = self._trace(*key)
            letters, state = self.traced[key]
            audit.append(letters)
        while END[state]:
            audit.append("I")
            state = TURN[state]
        return cost, "".join(audit)

    def _trace(self, block: str, vector: int, state: int) -> tuple[str, int]:
        after = [self.vectors[vector]]
        for symbol in reversed(block):
            after.append(_before(symbol, after[-1]))
        letters = []
        for place, symbol in enumerate(block):
            rows = _row(symbol, after[len(block) - place - 1])
            cost = after[len(block) - place]
            while True:
                choices = {letter: to for letter, (c, to) in rows[state].items() if c == cost[state]}
                if cost[state] == INSERT + cost[TURN[state]]:
                    choices["I"] = TURN[state]
                letter = min(choices)
                state = choices[letter]
                letters.append(letter)
                if letter != "I":
                    break
        return "".join(letters), state


@cache
def _blocks(size: int) -> Blocks:
    return Blocks(size)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults planted by crc32(``conv_id:turn``) % 20: 0 drops the row, 1 empties its text, 2 takes
    ``.!?`` out of it, 3 repeats the row, 4 makes its role user. Nulls count as one space, but conv_id and turn stay."""
    space = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    fate, text = F.crc32(key) % 20, F.coalesce("text", space)
    return conversations.filter(fate != 0).select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.when(fate == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(fate == 3, 2).otherwise(1))).alias("again"),
    ).drop("again")


ORDER = ["turn", "role", "text"]


def _marked(rows: DataFrame) -> DataFrame:
    """Per row its place, turn, the kind of its role and its first fault."""
    numbered_rows = numbered(rows, "conv_id", ORDER, {
        "turn": F.col("turn"),
        "kind": F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("x"),
        "same": F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))),
        "blank": ~F.col("text").rlike(r"[^\x20\x09-\x0D]"),
        "cut": ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"),
    })
    # Only what is there more than once has to be looked up again.
    twice = numbered_rows.groupBy("conv_id", "same").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"))
    twice = twice.filter("n > 1").select(F.col("conv_id").alias("of"), F.col("same").alias("known"), "first")
    joined = numbered_rows.join(twice, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("same") == F.col("known")), "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("pos") > F.col("first"), "duplicate").when(F.col("cut"), "truncated")
    return joined.select("conv_id", "turn", "pos", "kind", fault.alias("fault"))


def _symbols(marked: DataFrame) -> DataFrame:
    """Per conversation its counts and its symbols, one byte a row, as many as the audit that is to be returned."""
    gone = F.col("fault").isin("blank", "duplicate")
    symbol = F.when(gone, F.translate("kind", "suax", "0123")).when(F.col("fault") == "truncated", F.upper("kind"))
    piece = F.floor(F.col("pos") / PIECE)
    faults = ("blank", "duplicate", "truncated")
    pieces = marked.groupBy("conv_id", piece.alias("piece")).agg(
        F.array_sort(F.collect_list(F.struct("pos", F.coalesce(symbol, "kind").alias("symbol")))).alias("rows"),
        *(F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in faults),
    ).withColumn("symbols", F.array_join("rows.symbol", ""))
    whole = pieces.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("piece", "symbols"))).alias("pieces"), *(F.sum(f).alias(f) for f in faults))
    turns = marked.filter("turn IS NOT NULL").select("conv_id", "turn").distinct().groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    turns = turns.withColumnRenamed("conv_id", "of")
    return whole.join(turns, F.col("conv_id").eqNullSafe(F.col("of")), "left").select(
        "conv_id", F.array_join("pieces.symbols", "").alias("symbols"), "gaps", *faults)


FOUND = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def plans(symbols: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per conversation ``illegal`` (neighbouring roles that may not follow each other), cost and audit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _blocks(block)
        kinds = str.maketrans("SUAX0123", "suaxsuax")
        for batch in batches:
            illegal, solved = [], []
            for text in batch.column("symbols"):
                text = text.as_py()
                roles = text.translate(kinds)
                illegal.append(sum(a + b not in WANTED for a, b in zip(roles, roles[1:])))
                solved.append(table.solve(text))
            columns = {c: batch.column(c) for c in ("conv_id", "gaps", "blank", "duplicate", "truncated")}
            columns |= {"illegal": pa.array(illegal, pa.int64()), "cost": pa.array([c for c, _ in solved], pa.int64()),
                        "audit": pa.array([a for _, a in solved], pa.string())}
            yield pa.RecordBatch.from_pydict(columns)

    return symbols.mapInArrow(run, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
                                   "cost long, audit string")


class _Rebuilder:
    """Hash of a repaired conversation, fed a row at a time."""

    def __init__(self, plan: tuple):
        self.plan, self.audit, self.at = plan, plan[-1], 0
        self.state, self.digest, self.empty = START, hashlib.sha256(), True

    def _put(self, role: str, text: str) -> None:
        self.digest.update(("" if self.empty else "\n").encode() + role.encode() + b":" + text.encode())
        self.empty = False

    def _turn(self, text: str, role: str | None = None) -> None:
        self.state = TURN[self.state]
        self._put(role or ("user" if self.state == USER else "assistant"), text)

    def _inserts(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            self._turn("")

    def row(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            self._turn(text)
        elif edit == "K" and role.startswith("s"):
            self.state = SYSTEM
            self._put(role, text)
        elif edit == "K":
            self._turn(text, role)

    def done(self) -> tuple:
        self._inserts()
        return (*self.plan, self.digest.hexdigest())


def repaired(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """``planned`` with the hash of each repaired conversation. One SHA-256 depends on all rows in order, so a
    conversation passes through one task; it is a stream of which only the audit and the hash are held."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = planned.withColumn("row", F.lit(False)).unionByName(rows.withColumn("row", F.lit(True)), allowMissingColumns=True)
    order = ["conv_id", "row", *ORDER]
    dealt = both.repartition(n, "conv_id").sortWithinPartitions(*(F.asc_nulls_first(c) for c in order))
    names = ["conv_id", *FOUND, "audit"]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in FOUND), ("audit", pa.string()),
                            ("repaired_sha256", pa.string())])
        open_one = None

        def out(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

        for batch in batches:
            done = []
            is_row = batch.column("row").to_pylist()
            role, text = batch.column("role"), batch.column("text")
            for k, row in enumerate(is_row):
                if row:
                    open_one.row(role[k].as_py(), text[k].as_py())
                    continue
                if open_one:
                    done.append(open_one.done())
                open_one = _Rebuilder(tuple(batch.column(c)[k].as_py() for c in names))
            if done:
                yield out(done)
        if open_one:
            yield out([open_one.done()])

    kinds = ", ".join(f"{c} long" for c in FOUND)
    return dealt.mapInArrow(stream, f"conv_id long, {kinds}, audit string, repaired_sha256 string")


def repair(conversations: DataFrame, rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per conv_id of ``conversations``: gaps, blank, duplicate, truncated and illegal of its ``rows`` (conv_id, turn,
    role, text without nulls in the latter two), the least cost of edits after which role initials read
    ``(s?(ua)+)?``, audit (their letters) and repaired_sha256.

    Rows go by turn (null first), role and text; null conv_ids are one conversation. A conversation without rows has
    zeros, an empty audit and the hash of nothing. Rows that are there twice are duplicates.
    """
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = plans(_symbols(_marked(rows)), block).withColumnRenamed("conv_id", "of")
    every = ids.join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left").select(
        "conv_id", *(F.coalesce(c, F.lit(0)).alias(c) for c in FOUND), F.coalesce("audit", F.lit("")).alias("audit"))
    return repaired(rows, kept(every, "plans"))


ORACLE_SQL = r"""
WITH RECURSIVE keyed AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
fated AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce([4294967295] || list_transform(split(key, ''), lambda x: CAST(ord(x) AS BIGINT)),
      lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda d, z: CASE WHEN d % 2 = 1 THEN xor(d // 2, 3988292384) ELSE d // 2 END))) % 20 AS fate
  FROM keyed),
rows_ AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
  FROM fated WHERE fate <> 0),
placed AS (
  SELECT *, row_number() OVER w AS i, left(role, 1) AS ini, lag(left(role, 1)) OVER w AS before,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
  FROM rows_ WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
marked AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
sums AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id),
-- what remains to be paid before row i from each state: 0 nothing yet, 1 system, 2 user, 3 assistant came last
ahead AS (
  SELECT conv_id, n + 1 AS i, 0 AS v0, 6 AS v1, 3 AS v2, 0 AS v3 FROM sums
  UNION ALL
  SELECT conv_id, i, least(w0, 3 + w2, 6 + w3), least(w1, 3 + w2, 6 + w3), least(w2, 3 + w3), least(w3, 3 + w2)
  FROM (
    SELECT m.conv_id, m.i,
      least(4 + v0, CASE WHEN gone THEN 999999 ELSE c + least(3 + v2, CASE ini WHEN 's' THEN v1 WHEN 'u' THEN v2 ELSE 999999 END) END) AS w0,
      least(4 + v1, CASE WHEN gone THEN 999999 ELSE c + v2 + CASE ini WHEN 'u' THEN 0 ELSE 3 END END) AS w1,
      least(4 + v2, CASE WHEN gone THEN 999999 ELSE c + v3 + CASE ini WHEN 'a' THEN 0 ELSE 3 END END) AS w2,
      least(4 + v3, CASE WHEN gone THEN 999999 ELSE c + v2 + CASE ini WHEN 'u' THEN 0 ELSE 3 END END) AS w3
    FROM ahead JOIN (SELECT *, fault IN ('blank', 'duplicate') AS gone, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS c FROM marked) m
      ON m.conv_id IS NOT DISTINCT FROM ahead.conv_id AND m.i = ahead.i - 1)),
vec AS (
  SELECT a.conv_id, a.i, [v0, v1, v2, v3] AS v, m.role, m.text, m.ini, coalesce(m.fault, '') AS fault, m.i IS NULL AS over
  FROM ahead a LEFT JOIN marked m ON m.conv_id IS NOT DISTINCT FROM a.conv_id AND m.i = a.i),
walk AS (
  SELECT conv_id, CAST(1 AS BIGINT) AS i, 0 AS q, '' AS audit, CAST([] AS VARCHAR[]) AS lines, false AS done FROM sums
  UNION ALL
  SELECT conv_id, CASE WHEN e IN ('I', 'end') THEN i ELSE i + 1 END,
    CASE WHEN e IN ('D', 'end') THEN q WHEN e = 'K' AND ini = 's' THEN 1 WHEN q = 2 THEN 3 ELSE 2 END,
    CASE WHEN e = 'end' THEN audit ELSE audit || e END,
    CASE e WHEN 'I' THEN list_append(lines, turn_role || ':') WHEN 'R' THEN list_append(lines, turn_role || ':' || text)
           WHEN 'K' THEN list_append(lines, role || ':' || text) ELSE lines END,
    e = 'end'
  FROM (
    SELECT w.*, x.ini, x.role, x.text, CASE WHEN q = 2 THEN 'assistant' ELSE 'user' END AS turn_role,
      CASE WHEN x.over AND x.v[q + 1] = 0 THEN 'end'
           WHEN NOT x.over AND x.v[q + 1] = 4 + y.v[q + 1] THEN 'D'
           WHEN x.v[q + 1] = 3 + x.v[CASE WHEN q = 2 THEN 4 ELSE 3 END] THEN 'I'
           WHEN x.v[q + 1] = CASE x.fault WHEN 'truncated' THEN 3 ELSE 0 END + CASE WHEN x.ini = 's' AND q = 0 THEN y.v[2]
                WHEN x.ini = 'u' AND q <> 2 THEN y.v[3] WHEN x.ini = 'a' AND q = 2 THEN y.v[4] ELSE 999999 END THEN 'K'
           ELSE 'R' END AS e
    FROM walk w JOIN vec x ON x.conv_id IS NOT DISTINCT FROM w.conv_id AND x.i = w.i
      LEFT JOIN vec y ON y.conv_id IS NOT DISTINCT FROM w.conv_id AND y.i = w.i + 1
    WHERE NOT w.done)),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT every.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(v0, 0) AS BIGINT) AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM every LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM every.conv_id
  LEFT JOIN walk ON walk.conv_id IS NOT DISTINCT FROM every.conv_id AND walk.done
  LEFT JOIN ahead ON ahead.conv_id IS NOT DISTINCT FROM every.conv_id AND ahead.i = 1
"""

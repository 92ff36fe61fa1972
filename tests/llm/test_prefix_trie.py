import hashlib
import random
import zlib

import numpy as np
import pytest

from activitymill.llm import prefix_trie
from activitymill.llm.ordered import numbered
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string, depth int, p1 string, shard int, n_turns string, pos int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def by_hand(rows):
    own = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own.setdefault(conv_id, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    own = {c: [r[2:] for r in sorted(turns)] for c, turns in own.items()}
    members = {}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        paths[c] = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(paths[c]) + 1):
            members.setdefault(paths[c][:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children.get(node, [])) or int(node not in children)
        saved[node] = sum(saved[k] for k in children.get(node, []))
        saved[node] += (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    return sorted(
        (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children.get(node, [])), leaves[node],
         saved[node], hashlib.sha256(",".join(str(c) for c in sorted(m) if paths[c] == node).encode()).hexdigest())
        for node, m in members.items())


def result(spark, rows, **options):
    table = spark.createDataFrame([(*r, 1, "p", 2, "n", 3) for r in rows], SCHEMA)
    df = prefix_trie.trie(prefix_trie.rebuilt(table), **options)
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


def sample(seed, n=60):
    rng, rows = random.Random(seed), []
    texts = ["", None, "a", "é", "long " * 500, "\x00", "b"]
    for c in range(n):
        first = rng.choice(["x", "x", "x", "y"])
        for turn in range(rng.randint(1, 12)):
            text = first if turn < 3 else rng.choice(texts)
            rows.append((rng.choice([c, c, c, c, None, -c]), rng.choice([turn, turn, turn, None]), rng.choice(["user", "user", None]), text))
    return rows + rows[:30]


@pytest.mark.parametrize("options", [{}, {"band": 2, "shard_rows": 25}, {"band": 3, "shard_rows": 10}, {"band": 1, "shard_rows": 50}])
def test_equals_plain_python(spark, options):
    rows = sample(len(options))
    assert result(spark, rows, **options) == by_hand(rows)


def test_a_long_conversation_and_its_copies(spark):
    """Subtrees over many bands, whose members are all the same few."""
    rows = [(c, t, "user", f"turn {t % 7} {t if c == 10 and t > 250 else ''}") for c in (0, 5, 10, 3) for t in range(300)]
    assert result(spark, rows, band=16, shard_rows=64) == by_hand(rows)


def test_a_beginning_that_all_share(spark):
    rows = [(c, t, "user", "hello" if t < 2 else f"{c}") for c in range(1500) for t in range(3)]
    assert result(spark, rows, shard_rows=200) == by_hand(rows)


def test_no_rows(spark):
    assert result(spark, []) == []
    assert result(spark, [(None, 1, "user", "x")]) == []


def test_slots_have_no_gaps_and_unknown_keys_are_noticed():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 5000):
        p1, p2 = rng.integers(-2**63, 2**63 - 1, n), rng.integers(0, 3, n)
        table = prefix_trie.SlotTable(p1, p2)
        slots = table.slots(p1, p2)
        assert sorted(slots) == list(range(n))
        assert (table.p1[slots] == p1).all() and (table.p2[slots] == p2).all()
        assert (table.slots(p1 + 1, p2) == -1).all() and (table.slots(p1, p2 + 5) == -1).all()
    with pytest.raises(ValueError, match="twice"):
        prefix_trie.SlotTable(np.array([1, 1]), np.array([2, 2]))


def test_places_over_many_tasks(spark):
    rng = random.Random(6)
    rows = [(rng.choice([1, 1, 1, 2, None, k % 50]), rng.choice([None, k]), rng.choice("ab"), "t" * rng.randint(0, 50)) for k in range(4000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = numbered(table, "conv_id", ["turn", "role", "text"], {c: F.col(c) for c in ("turn", "role", "text")}).collect()
    by_conv = {}
    for r in got:
        by_conv.setdefault(r.conv_id, []).append((r.pos, (r.turn is not None, r.turn or 0, r.role, r.text)))
    assert sum(map(len, by_conv.values())) == len(rows)
    for places in by_conv.values():
        places.sort()
        assert [p for p, _ in places] == list(range(len(places)))
        assert [k for _, k in places] == sorted(k for _, k in places)

import collections
import hashlib
import random

import numpy as np
import pytest

from activitymill.llm import suffix_dedup as s
from tests.llm import corpus


def best(segments, cap):
    """Most symbols that each suffix shares with one that starts elsewhere."""
    suffixes = [(tuple(x[k:]), i, k) for i, x in enumerate(segments) for k in range(len(x))]

    def shared(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    return [min(cap, max((shared(x, y) for y, i2, k2 in suffixes if (i2, k2) != (i, k)), default=0)) for x, i, k in suffixes]


def test_collection_against_all_pairs_of_suffixes():
    rng = random.Random(1)
    for _ in range(40):
        segments = [[rng.randint(1, 3) for _ in range(rng.randint(0, 12))] for _ in range(rng.randint(1, 8))]
        offsets = np.cumsum([0] + [len(x) for x in segments])
        symbols = np.array([c for x in segments for c in x], np.uint8)
        assert s.shared_prefixes(symbols, offsets, 7).tolist() == best(segments, 7)


def test_range_least():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 250, 5000).astype(np.uint8)
    low = rng.integers(0, 4999, 400)
    high = np.minimum(low + rng.integers(0, 4000, 400), 4999)
    assert s._range_least(values, low, high).tolist() == [values[a:b + 1].min() for a, b in zip(low, high)]


def expected(texts, length):
    data = [(t or "").encode() for t in texts]
    times = collections.Counter(b[p:p + length] for b in data for p in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 2, bool)
        for p in range(len(b) - length + 1):
            if times[b[p:p + length]] > 1:
                gone[p + 1:p + 1 + length] = True
        left = bytes(np.frombuffer(b, np.uint8)[~gone[1:-1]])
        out.append((len(b), len(b) - len(left), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize("windows, crowd", [
    (s.Windows(20, 8, 4), 20_000), (s.Windows(20, 8, 4), 2), (s.Windows(16, 5, 3), 3), (s.Windows(), 20_000),
])
def test_same_as_counting_every_window(spark, windows, crowd):
    docs = corpus.documents(spark, n=25)
    rows = docs.select("doc_id", "text").collect()
    want = [(r.doc_id, *e) for r, e in zip(rows, expected([r.text for r in rows], windows.length))]
    got = s.removals(docs, windows, crowd).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)
    assert sum(w[2] for w in want) > 2000


def test_long_texts_come_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(s, "_PIECE", 100)
    docs = corpus.documents(spark, n=10)
    w = s.Windows(20, 8, 4)
    rows = docs.select("doc_id", "text").collect()
    want = [(r.doc_id, *e) for r, e in zip(rows, expected([r.text for r in rows], 20))]
    # Pieces of one text are made in the task, so only its own code sees the patch; the pieces themselves are checked.
    from activitymill.llm.words import texts
    import pyarrow as pa
    whole = next(texts(pa.array([rows[-5].text or "x" * 3000])))
    pieces = [(start + x, start + y) for data, offsets, _, start in s._pieces(whole, w) for _, _, x, y in zip(*s.anchors(data, offsets, w))]
    covered = sorted({p for x, y in pieces for p in range(x, y + 1)})
    assert covered == list(range(len(whole.data) - 19))
    assert sorted((tuple(r) for r in s.removals(docs, w).collect()), key=repr) == sorted(want, key=repr)


def test_texts_are_cut(spark):
    docs = corpus.documents(spark, n=10)
    w = s.Windows(20, 8, 4)
    cut = s.without_repeats(docs, w)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    hashes = {r.doc_id: r.kept_sha256 for r in s.removals(docs, w).collect()}
    for r in cut.filter("doc_id < 5 and text is not null").collect():
        assert hashlib.sha256(r.text.encode()).hexdigest() == hashes[r.doc_id]
    assert s.removals(corpus.none(spark), w).collect() == [] and s.without_repeats(corpus.none(spark), w).collect() == []

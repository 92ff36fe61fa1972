import itertools
import math

import numpy as np
import pytest

from activitymill.llm import jaccard_join as j
from tests.llm import corpus


def shingles(text):
    w = corpus.words(text)
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def expected(rows):
    """Per row: smallest id of its class, copies, links and smallest id of its group."""
    sets = [shingles(t) for _, t in rows]
    linked = {k: {k} for k in range(len(rows))}
    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] == sets[b] or (both and both >= 0.8 * len(sets[a] | sets[b])):
            linked[a].add(b)
            linked[b].add(a)
    group = {}
    for k in range(len(rows)):
        seen, todo = {k}, [k]
        while todo:
            for x in linked[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        group[k] = seen
    least = lambda ks: min((rows[k][0] for k in ks if rows[k][0] is not None), default=None)
    out = []
    for k, (i, _) in enumerate(rows):
        same = [x for x in range(len(rows)) if sets[x] == sets[k]]
        out.append((i, least(same), len(same), len(linked[k]) - 1, least(group[k])))
    return sorted(out, key=repr), {min(g) for g in group.values()}


@pytest.mark.parametrize("block", [512, 2])
def test_same_as_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(j, "BLOCK", block)
    docs = corpus.documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want, groups = expected(rows)
    found = j.links(docs).select("doc_id", "class_id", "copies", "links", "group_id").collect()
    assert sorted((tuple(r) for r in found), key=repr) == want
    kept = j.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert len({i for i, c, n, _, g in want if n > 1}) > 4 and any(c == 1 and n > 0 for _, _, c, n, _ in want)


def test_no_documents(spark):
    assert j.links(corpus.none(spark)).collect() == [] and j.one_of_each(corpus.none(spark)).collect() == []


def test_fewest_matches_follow_the_posterior():
    fewest = j.fewest_matches(0.8, 1e-3, 64, 16)
    for n, least in fewest.items():
        def chance(m):
            # P(Beta(m + 1, n - m + 1) >= 0.8) as a binomial sum.
            return sum(math.comb(n + 1, k) * 0.8 ** k * 0.2 ** (n + 1 - k) for k in range(m + 1))
        assert chance(least) >= 1e-3 * 0.98 and (least == 0 or chance(least - 1) < 1e-3 * 1.02)


def test_signatures_estimate_the_index():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
    a, b = np.unique(pool[:600]), np.unique(pool[60:660])
    s = j.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((s[0] == s[1]).mean() - true) < 0.08
    assert (j.signatures(np.zeros(0, np.uint64), np.array([0, 0])) == 0xFFFFFFFF).all()

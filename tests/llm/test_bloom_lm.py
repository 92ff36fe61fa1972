import collections
import math
import zlib

import numpy as np

from activitymill.llm import bloom_lm as b
from tests.llm import corpus


def expected(rows):
    tokens = [(i, ["".join(w) for w in corpus.words(t)] + ["\0end"]) for i, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in tokens]
    counts = collections.Counter(w for (_, ws), h in zip(tokens, held) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    out = []
    for (i, ws), h in zip(tokens, held):
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        out.append((i, h, len(ws), sum(counts[w] > 0 for w in ws), n, round(base, 6)))
    return sorted(out, key=repr)


def test_base_scores_and_counts_are_exact(spark):
    docs = corpus.documents(spark)
    got = b.score_documents(docs).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(((*tuple(r)[:5], round(r.base_score, 6)) for r in got), key=repr) == expected(rows)
    assert all(r.score <= 0 and math.isfinite(r.score) for r in got)


def test_filter_never_reads_less_and_seldom_more():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    counts = rng.geometric(0.05, len(keys))
    n, bits = 4, 1 << 17
    data = np.concatenate([b.segment(keys[b.bucket_of(keys, n) == k], counts[b.bucket_of(keys, n) == k], bits) for k in range(n)])
    read = b.Counts(data, n, bits).read(keys)
    low, level = 2 ** (np.frexp(counts.astype(float))[1] - 1), np.frexp(counts.astype(float))[1]
    assert (read >= low).all()
    assert (read <= 0.75 * 2.0 ** level - 0.5).mean() > 0.95
    other = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    assert (b.Counts(data, n, bits).read(other) > 0).mean() < 0.1


def middle(c):
    """The middle of the range between powers of two that a count lies in."""
    return 0.75 * 2 ** c.bit_length() - 0.5 if c else 0


def model(token_lists, held):
    """Probability of a word after another (None: at the beginning), by the definition, from exact levels."""
    train = [ws for ws, h in zip(token_lists, held) if not h]
    single = collections.Counter(w for ws in train for w in ws)
    pairs = collections.Counter(p for ws in train for p in zip(ws, ws[1:]))
    reads = sum(map(middle, single.values()))

    def p(u, w, mass=0.25):
        one = (middle(single[w]) + 0.5) / (reads + 0.5 * (len(single) + 1))
        return one if u is None else (1 - mass) * one + mass * min(1, middle(pairs[u, w]) / max(1, middle(single[u])))

    return p, single


def log10(p, ws):
    return sum(math.log10(p(u, w)) for u, w in zip([None, *ws], ws))


def test_score_is_interpolated_from_quantised_counts(spark):
    one, two, three = [i for i in range(99) if zlib.crc32(str(i).encode()) % 5 != 1][:3]
    docs = spark.createDataFrame([(one, "a b a b a b"), (two, "a c"), (three, "a b")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in b.score_documents(docs, mass=0.25).collect()}
    # Counts by hand: a 5, b 4, c 1, end 3; a b 4, b a 2, b end 2, a c 1, c end 1.
    quantised = {0: 0, 1: 1, 2: 2.5, 3: 2.5, 4: 5.5, 5: 5.5}
    single = {"a": 5, "b": 4, "c": 1, "end": 3}
    spread = sum(quantised[c] for c in single.values()) + 0.5 * (4 + 1)
    p = {w: (quantised[c] + 0.5) / spread for w, c in single.items()}
    pairs = {("a", "b"): 4, ("b", "a"): 2, ("b", "end"): 2, ("a", "c"): 1, ("c", "end"): 1}

    def log(words):
        out = math.log10(p[words[0]])
        for u, w in zip(words, words[1:]):
            out += math.log10(0.75 * p[w] + 0.25 * min(1, quantised[pairs.get((u, w), 0)] / quantised[single[u]]))
        return out

    assert math.isclose(got[three], log(["a", "b", "end"]), rel_tol=1e-9)
    assert math.isclose(got[two], log(["a", "c", "end"]), rel_tol=1e-9)


def test_scores_are_those_of_plain_counts_but_for_false_readings(spark):
    docs = corpus.documents(spark, seed=3, n=200, repeat=False)
    rows = [(r.doc_id, ["".join(w) for w in corpus.words(r.text)] + ["\0end"]) for r in docs.collect()]
    p, _ = model([ws for _, ws in rows], [zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows])
    got = {r.doc_id: (r.score, r.n_tokens) for r in b.score_documents(docs).collect()}
    off = {i: (got[i][0] - log10(p, ws)) / got[i][1] for i, ws in rows}
    # A reading is too high with probability FALSE and never too low, but as the context of a bigram.
    tokens = sum(len(ws) for _, ws in rows)
    assert abs(sum(off[i] * len(ws) for i, ws in rows)) / tokens < 0.01
    assert sum(abs(v) < 1e-9 for v in off.values()) >= 10
    assert sum(abs(off[i]) < 0.05 for i, ws in rows if len(ws) > 50) >= 0.95 * sum(len(ws) > 50 for _, ws in rows)


def test_probabilities_sum_to_about_one(spark):
    docs = corpus.documents(spark, seed=4, n=100, repeat=False)
    p, single = model([["".join(w) for w in corpus.words(r.text)] + ["\0end"] for r in docs.collect()], [False] * docs.count())
    assert math.isclose(sum(p(None, w) for w in single) + p(None, "never seen"), 1)
    sums = [sum(p(u, w) for w in single) + p(u, "never seen") for u in single if u != "\0end"]
    assert 0.75 <= min(sums) and max(sums) <= 1.25 and abs(sum(sums) / len(sums) - 1) < 0.05


def test_held_out_texts_gain_from_pairs_of_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sums = b.score_documents(docs).filter("held_out").selectExpr("sum(score) / sum(n_tokens)", "sum(base_score) / sum(n_tokens)").first()
    assert sums[0] > sums[1] + 0.1


def test_empty_and_held_out_only(spark):
    assert b.score_documents(corpus.none(spark)).collect() == []
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    only = spark.createDataFrame([(held, "x y")], "doc_id long, text string")
    row = b.score_documents(only).collect()[0]
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 3, 0, 0)
    assert row.base_score == 0.0


def test_size_of_what_is_broadcast_has_no_influence(spark):
    docs = corpus.documents(spark)
    few, many = ({(r.doc_id, r.n_tokens): r.score for r in b.score_documents(docs, filter_bits=k).collect()} for k in (1 << 12, 1 << 27))
    assert few.keys() == many.keys() and all(math.isclose(few[k], many[k], rel_tol=1e-9) for k in few)


def test_reads_stay_near_the_counts_whatever_the_load(spark):
    rng = np.random.default_rng(6)
    for size in (100, 300_000):
        keys = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        counts = rng.geometric(0.3, size)
        bits = b.bits_for(counts)
        filled = b.Counts(b.segment(keys, counts, bits), 1, bits)
        level = np.frexp(counts.astype(float))[1]
        assert (filled.levels(keys) >= level).all() and (filled.levels(keys) > level).mean() <= 0.01
        assert (filled.levels(rng.integers(0, 1 << 63, size, dtype=np.uint64)) > 0).mean() <= 0.01
    # Unseen words read as unseen where a fixed filter would be full.
    train = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 != 1]
    values = [(i, " ".join(f"a{i}_{k}" for k in range(2000))) for i in train]
    held = next(i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 5 == 1)
    docs = spark.createDataFrame([*values, (held, " ".join(f"z{k}" for k in range(2000)))], "doc_id long, text string")
    row = b.score_documents(docs, filter_bits=1 << 16).filter(f"doc_id = {held}").first()
    p = math.log10(0.75 * 0.5 / (row.train_tokens + 0.5 * (2000 * len(train) + 2)))
    assert abs(row.score / row.n_tokens - p) < 0.02


def test_what_is_sent_does_not_grow_with_the_buckets(spark, monkeypatch):
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{k}" for k in rng.zipf(1.3, 150) % 5000) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).cache()
    deal, kept, sizes = b.packed.deal, b.kept, []

    def counted(df):
        columns = [f"sum(octet_length({f.name}))" for f in df.schema if f.dataType.typeName() == "binary"]
        sizes.append(sum(v or 0 for v in df.selectExpr(*columns).first()))

    def dealt(df, n):
        counted(df)
        return deal(df, n)

    def written(df, name):
        out = kept(df, name)
        counted(out)
        return out

    monkeypatch.setattr(b.packed, "deal", dealt)
    monkeypatch.setattr(b, "kept", written)
    before, totals, scores = spark.conf.get("spark.sql.shuffle.partitions"), [], []
    try:
        for n in (4, 64):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            sizes.clear()
            scores.append({r.doc_id: r.base_score for r in b.score_documents(docs).collect()})
            totals.append(sum(sizes))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert all(math.isclose(scores[0][i], scores[1][i], rel_tol=1e-9) for i in range(300))
    # Each chunk sends a word or bigram once; sums of a text from every bucket that has some of it would be many more.
    assert totals[1] < 1.5 * totals[0] and totals[1] < 2 * sum(map(len, texts))


def test_chunks_hold_every_row_once_whatever_their_size(spark):
    docs = corpus.documents(spark)
    packed = docs.selectExpr("doc_id", "coalesce(text, '') AS text", "false AS held_out")
    want = sorted(packed.collect(), key=repr)
    for size in (1, 300, 1 << 30):
        chunks = b._chunks(packed, size).collect()
        tables = [b.pa.ipc.open_stream(bytes(c.documents)).read_all().to_pylist() for c in chunks]
        got = [(r["doc_id"], r["text"], r["held_out"]) for t in tables for r in t]
        assert sorted(got, key=repr) == [tuple(r) for r in want]
        assert len({c.chunk for c in chunks}) == len(chunks) >= len(want) * (size == 1)
        assert all(len(t) == 1 or sum(len(r["text"].encode()) for r in t) <= size for t in tables)

"""A small corpus with what the operators have to put up with, and plain-Python counterparts."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size long, target string, rid string, "
    "same long, class string, links long, key string, _x int, _rid string, _all int, _ranges string"
)


def words(text):
    """Words with A-Z lower-cased only."""
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]


def prose(rng, n, vocabulary=400):
    out = []
    for k in range(n):
        out.append("w%d" % min(int(rng.expovariate(6 / vocabulary)), 2 * vocabulary) + rng.choice(["", "", "", ",", "."]))
        if rng.random() < 0.05:
            out.append("\n")
    return " ".join(out)


def texts(seed=0, n=60):
    """Prose, exact and near copies, a shared passage, a very long text, empty ones, odd spaces and letters."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(1, 150)) for _ in range(n)]
    base[3] = prose(rng, 120)
    passage = prose(rng, 70)
    near = prose(rng, 200).split()
    out = base + [base[3], base[3], base[5]]
    for k in range(4):
        changed = list(near)
        changed[40 + 30 * k] = "changed%d" % k
        out.append(" ".join(changed))
    out += [f"{prose(rng, 60)} {passage} {prose(rng, 40)}" for _ in range(4)] + [passage]
    out += ["", None, "   \t\n", "one", "one two three four", "éà ñ ß 　x", "a" * 3000, prose(rng, 5000), "in. " * 300, "x\x00y"]
    return out


def documents(spark, seed=0, n=60, repeat=True):
    """Ids are unique but for one row that is there twice, and one that is null."""
    rows = [
        (i, t, "en", [None, "b", "a", "é", ""][i % 5], None, 7, "t", "r", 1, "c", 2, "k", 3, "i", 4, "q")
        for i, t in enumerate(texts(seed, n))
    ]
    if repeat:
        rows += [rows[7], (None, *rows[8][1:])]
    return spark.createDataFrame(rows, SCHEMA)


def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    """Rows by doc_id, for ids that are there once."""
    found = {}
    for row in df.collect():
        found.setdefault(row.doc_id, []).append(row)
    return {k: v[0] for k, v in found.items() if len(v) == 1}

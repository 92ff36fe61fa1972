import math
import random
import zlib

import numpy as np

from activitymill.llm import language_id
from tests.llm.corpus import documents, none

SCHEMA = "doc_id long, text string, lang string, source string, best string, held_out int, cell int, n long"
LETTERS = {"en": "abcde ", "fr": "cdefg ", "él": "éàçfg ", "de": "stuvw "}


def table(spark, rows):
    return spark.createDataFrame([(*r, "s", "b", 0, 1, 2) for r in rows], SCHEMA)


def made(seed=0, n=300):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        lang = rng.choice(list(LETTERS))
        text = "".join(rng.choice(LETTERS[lang]) for _ in range(rng.randint(20, 200)))
        rows.append((k, text, lang))
    return rows


def cells_of(text, cells):
    """Cells of a text, read by plain Python."""
    out = []
    read = " "
    for c in text:
        c = (c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " "
        if c != " " or read[-1] != " ":
            read += c
    for n in language_id.SIZES:
        for at in range(len(read) - n + 1):
            gram = read[at:at + n]
            if gram == " ":
                continue
            total = 0
            for c in gram:
                total = (total * int(language_id._ODD) + ord(c)) % 2**64
            out.append(int(language_id.mix(np.array([(total + n) % 2**64], np.uint64))[0]) % cells)
    return out


def by_hand(rows, cells):
    learned = [r for r in rows if r[1] is not None and r[2] is not None and (r[0] is None or zlib.crc32(str(r[0]).encode()) % 5)]
    langs = sorted({r[2] for r in learned})
    counts = {lang: np.zeros(cells) for lang in langs}
    for _, text, lang in learned:
        for cell in cells_of(text, cells):
            counts[lang][cell] += 1
    share = {lang: sum(r[2] == lang for r in learned) / len(learned) for lang in langs}
    out = []
    for doc_id, text, _ in rows:
        if not any(c.isalpha() for c in text or "") or not langs:
            out.append((doc_id, "und", 0.0))
            continue
        logs = []
        for lang in langs:
            p = (counts[lang] + 0.5) / (counts[lang].sum() + 0.5 * cells)
            logs.append(math.log(share[lang]) + sum(math.log(p[c]) for c in cells_of(text, cells)))
        best = max(logs)
        out.append((doc_id, langs[logs.index(best)], 1 / sum(math.exp(v - best) for v in logs)))
    return out


def result(spark, rows, cells=language_id.CELLS):
    docs = table(spark, rows)
    df = language_id.predict(docs, language_id.fit(docs.filter(~language_id.held_out()), cells), cells)
    assert df.columns == ["doc_id", "held_out", "lang_pred", "score"]
    found = df.collect()
    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    return [(r.doc_id, r.lang_pred, r.score) for r in found]


ODD = [(900, None, "en"), (901, "", "en"), (902, "12 .,!\n", "fr"), (903, "x", None), (904, "É" * 4, "él"), (905, "İẞ ﬁ", None),
       (906, "a\x00b 𝔘 ", "en"), (None, "abc", "en"), (907, "ab. c!  d", None)]


def alike(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert all(abs(a[2] - b[2]) < 1e-3 for a, b in zip(got, want))


def test_equals_plain_python(spark):
    rows = made(1, 60) + ODD
    rows += rows[:10]
    alike(result(spark, rows, 256), by_hand(rows, 256))


def test_more_languages_than_are_held_at_once(spark, monkeypatch):
    rows = [(k, text, f"{lang}{k % 3}") for k, text, lang in made(2, 50)] + ODD
    want = by_hand(rows, 128)
    for most in (1, 4, 12):
        monkeypatch.setattr(language_id, "LANGUAGES", most)
        alike(result(spark, rows, 128), want)


def test_parts_of_long_texts_count_as_the_whole(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice("aB é.  1") for _ in range(n)) for n in (0, 500, 3, 1, 99, 200, 7)]
    whole = {k: sorted(cells_of(t, 512)) for k, t in enumerate(texts)}
    for piece in (1, 2, 10, 100, 1000):
        monkeypatch.setattr(language_id, "PIECE", piece)
        found = {k: [] for k in whole}
        for cell, owner in language_id.grams(texts, 512):
            for c, k in zip(cell.tolist(), owner.tolist()):
                found[k].append(c)
        assert {k: sorted(v) for k, v in found.items()} == whole


def test_languages_of_held_out_documents(spark):
    rows = made(4, 400)
    langs = {k: lang for k, _, lang in rows}
    held = [(k, p) for k, p, _ in result(spark, rows) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert len(held) > 50 and sum(langs[k] == p for k, p in held) / len(held) > 0.97


def test_the_language_column_of_a_held_out_document_is_not_looked_at(spark):
    rows = made(5, 100)
    changed = [(k, t, "zz" if zlib.crc32(str(k).encode()) % 5 == 0 else lang) for k, t, lang in rows]
    assert result(spark, rows) == result(spark, changed)


def test_nothing_learned_and_no_rows(spark):
    assert result(spark, []) == []
    assert result(spark, [(1, "abc", None)]) == [(1, "und", 0.0)]
    assert language_id.predict(none(spark), language_id.fit(none(spark))).collect() == []


def test_any_documents(spark):
    docs = documents(spark)
    assert language_id.predict(docs, language_id.fit(docs)).count() == docs.count()

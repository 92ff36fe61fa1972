"""Language of a text: multinomial naive Bayes over hashed character n-grams.

Texts are read as letters in lower case with one space for whatever stands between them, so numbers, links and signs
tell nothing. Counts per language and cell are summed by Spark over all documents that are learned from. The matrix of
log probabilities has ``CELLS`` rows and a column per language; it is broadcast, ``LANGUAGES`` columns at a time, so
its size has a bound however many values ``lang`` has.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activitymill.llm.words import mix
from activitymill.llm.work import kept

SIZES = (1, 2, 3)
CELLS = 1 << 15
LANGUAGES = 32
SMOOTHING = 0.5
PIECE = 1 << 17
UNKNOWN = "und"
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACE = ord(" ")


@cache
def _folds() -> np.ndarray:
    """What each code point is read as: letters in lower case, all others as a space."""
    out = np.full(0x110000, _SPACE, np.uint32)
    for k in range(0x110000):
        c = chr(k)
        if c.isalpha():
            low = c.lower()
            out[k] = ord(low) if len(low) == 1 else k
    return out


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _read(points: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters and single spaces, and the document of each."""
    points = _folds()[points]
    space = points == _SPACE
    stays = np.ones(len(points), bool)
    stays[1:] = ~(space[1:] & space[:-1] & (owner[1:] == owner[:-1]))
    return points[stays], owner[stays]


def _pieces(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Whole documents of some ``PIECE`` characters together, or a part of a long one: characters, the document of
    each, and how many at the start are the end of the part before. Every document begins with a space."""
    first = 0
    while first < len(texts):
        if len(texts[first]) > PIECE:
            behind = np.zeros(0, np.uint32)
            for at in range(0, len(texts[first]), PIECE):
                part = _points((" " if at == 0 else "") + texts[first][at:at + PIECE])
                part, _ = _read(np.concatenate([behind, part]), np.zeros(len(behind) + len(part), np.int8))
                yield part, np.full(len(part), first), len(behind)
                behind = part[-(max(SIZES) - 1):]
            first += 1
            continue
        last, total = first, 0
        while last < len(texts) and total + len(texts[last]) <= PIECE:
            total += len(texts[last]) + 1
            last += 1
        points = _points(" " + " ".join(texts[first:last]))
        owner = np.repeat(np.arange(first, last), [len(t) + 1 for t in texts[first:last]])
        yield *_read(points, owner), 0
        first = last


def grams(texts: list[str], cells: int = CELLS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Cells of all n-grams of some documents at a time, and the document of each, ascending."""
    for points, owner, known in _pieces(texts):
        wide = points.astype(np.uint64)
        for n in SIZES:
            size = len(wide) - n + 1
            if size <= 0:
                continue
            total = np.zeros(size, np.uint64)
            for k in range(n):
                total = total * _ODD + wide[k:k + size]
            inside = owner[:size] == owner[n - 1:]
            inside[:max(0, known - n + 1)] = False
            if n == 1:
                inside &= points != _SPACE
            yield (mix(total[inside] + np.uint64(n)) % np.uint64(cells)).astype(np.int64), owner[:size][inside]


def _counts(batches: Iterator[pa.RecordBatch], cells: int) -> Iterator[pa.RecordBatch]:
    """Per language, how often each cell occurs and (as cell -1) the number of documents. Only ``LANGUAGES`` languages
    are gathered at a time."""
    held: dict[str, np.ndarray] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array((at - 1).astype(np.int32)), pa.array(counts[at])],
                ["lang", "cell", "n"])
        held.clear()

    for batch in batches:
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            if lang not in held and len(held) >= LANGUAGES:
                yield from flush()
            counts = held.setdefault(lang, np.zeros(cells + 1, np.int64))
            counts[0] += len(texts)
            for cell, _ in grams(texts, cells):
                counts[1:] += np.bincount(cell, minlength=cells)
    yield from flush()


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning; one with a null doc_id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, cells: int = CELLS) -> DataFrame:
    """Counts (lang, cell, n) of ``docs`` that have a lang and a text."""
    learned = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    found = learned.mapInArrow(lambda batches: _counts(batches, cells), "lang string, cell int, n long")
    return kept(found.groupBy("lang", "cell").agg(F.sum("n").alias("n")), "languages")


def _matrix(counts: DataFrame, after: str | None, documents: int, cells: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The next languages by code point, their log probabilities (a row per cell) and log shares of documents."""
    names = counts.filter(F.col("cell") == -1)
    names = names if after is None else names.filter(F.col("lang") > after)
    found = names.orderBy("lang").limit(LANGUAGES).collect()
    langs = [r.lang for r in found]
    table = counts.filter((F.col("cell") >= 0) & F.col("lang").isin(langs)).toArrow()
    place = {lang: k for k, lang in enumerate(langs)}
    sums = np.zeros((cells, len(langs)))
    column = np.array([place[lang] for lang in table.column("lang").to_pylist()], np.int64)
    sums[table.column("cell").to_numpy(), column] = table.column("n").to_numpy()
    logs = np.log(sums + SMOOTHING) - np.log(sums.sum(0) + SMOOTHING * cells)
    return langs, logs.astype(np.float32), np.log([r.n / documents for r in found])


CARRIED = "best string, best_log double, log_sum double"


def predict(docs: DataFrame, counts: DataFrame, cells: int = CELLS) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score``, the probability of lang_pred among the learned values, for
    each row of ``docs``. Of equally probable values the least by code point is taken. A text that is null or has no
    letter is ``und`` with score 0, and so is every text if nothing was learned. Only doc_id and text are looked at.
    """
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    documents = counts.filter("cell = -1").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    none = {"best": F.lit(None).cast("string"), "best_log": F.lit(float("-inf")), "log_sum": F.lit(float("-inf"))}
    scored = docs.select("doc_id", "text").withColumns(none)
    after = None
    while True:
        langs, logs, shares = _matrix(counts, after, documents, cells)
        if not langs:
            break
        if after is not None:
            scored = kept(scored, "scored")  # so that one matrix is held at a time
        model = spark.sparkContext.broadcast((langs, logs, shares))
        scored = scored.mapInArrow(lambda b, m=model: _scored(b, *m.value, cells), f"doc_id {id_type}, text string, {CARRIED}")
        if len(langs) < LANGUAGES:
            break
        after = langs[-1]
    sure = F.least(F.lit(1.0), F.exp(F.col("best_log") - F.col("log_sum")))
    return scored.select(
        "doc_id", held_out().alias("held_out"), F.coalesce("best", F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(F.col("best").isNull(), 0.0).otherwise(sure).alias("score"),
    )


def _scored(
    batches: Iterator[pa.RecordBatch], langs: list[str], logs: np.ndarray, shares: np.ndarray, cells: int
) -> Iterator[pa.RecordBatch]:
    """The batches with the best of these languages and of those before, and the logarithm of the sum of all."""
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        sums = np.zeros((len(texts), len(langs)))
        letters = np.zeros(len(texts), bool)
        for cell, owner in grams(texts, cells):
            if len(cell):
                starts = np.flatnonzero(np.diff(owner, prepend=-1))
                sums[owner[starts]] += np.add.reduceat(logs[cell], starts, axis=0, dtype=np.float64)
                letters[owner[starts]] = True
        sums += shares
        best = sums.argmax(1) if len(texts) else np.zeros(0, int)
        own = sums[np.arange(len(texts)), best]
        was, was_sum = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("best_log", "log_sum"))
        better = letters & (own > was)
        total = np.logaddexp(was_sum, np.logaddexp.reduce(sums, axis=1))
        name = [langs[k] if new else old for k, new, old in zip(best, better, batch.column("best").to_pylist())]
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), batch.column("text"), pa.array(name, pa.string()), pa.array(np.where(better, own, was)),
            pa.array(np.where(letters, total, was_sum)),
        ], ["doc_id", "text", "best", "best_log", "log_sum"])

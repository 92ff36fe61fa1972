"""Toxicity by cumulative-link ordinal regression on sparse text features.

A document's features are its distinct words and word beginnings of several lengths, kept apart. The model has one
weight per feature, shared by all ordered thresholds: P(grade <= k) = logistic(threshold_k - weights . features).
It gives the probability of each grade and the expected severity. A document is rejected if the probability of any
grade above the lowest is at least ``reject``.

It is fitted on at most ``max_rows`` labelled documents, those with the smallest hash of the doc_id, each pair of id and
grade once. Features are kept
if they occur in ``least`` of these documents and their mean grade is ``z`` standard errors off what their number of
documents would have by chance, the ``max_features`` furthest. Features are counted by Spark; only the
sampled documents' chosen features and the model reach the driver. Scoring is one pass over all whole texts without a shuffle.

Defined cases: a null text is an empty one; text without a known feature gets what the thresholds alone say; rows
with a null label are left out of the fit; different labels of one document are several rows; repeated documents are
scored alike. Grades that no sampled row has are never predicted. Without labels the grade is 0. Other columns are
left out of scores and kept by ``keep_clean``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activitymill.llm.work import bounded_sample, kept
from activitymill.llm.words import Texts, distinct, hash_spans, mix, texts

_BEGINNINGS = (4, 6, 8, 10)  # bytes


def features(piece: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes, with repeats, and the document of each."""
    words = piece.words()
    found, owner = [words.hashes()], words.documents()
    of = [owner]
    for length in _BEGINNINGS:
        long = words.ends - words.starts >= length
        start = words.starts[long]
        found.append(mix(hash_spans(words.data, start, start + length) + np.uint64(1)))
        of.append(owner[long])
    return np.concatenate(found), np.concatenate(of)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass(frozen=True)
class OrdinalModel:
    terms: np.ndarray  # sorted hashes
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than grades
    grades: np.ndarray  # ascending

    def probabilities(self, score: np.ndarray) -> np.ndarray:
        """Of each grade, from weights . features."""
        upto = _logistic(self.thresholds[None, :] - score[:, None])
        full = np.concatenate([np.zeros((len(score), 1)), upto, np.ones((len(score), 1))], axis=1)
        return np.maximum(np.diff(full, axis=1), 0)

    def scores(self, piece: Texts) -> np.ndarray:
        found, owner = features(piece)
        place = np.minimum(np.searchsorted(self.terms, found), max(0, len(self.terms) - 1))
        known = self.terms[place] == found if len(self.terms) else np.zeros(len(found), bool)
        place, owner = place[known], owner[known]
        once = np.unique(owner * max(1, len(self.terms)) + place)
        owner, place = np.divmod(once, max(1, len(self.terms)))
        return np.bincount(owner, self.weights[place], minlength=len(piece))


def _sample(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """Features and grade of the labelled documents that the model is fitted on: of at most ``max_rows`` ids and grades
    at most as many different texts, however many rows an id has."""
    given = labels.filter(F.col("grade").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "grade")
    chosen = bounded_sample(given, max_rows)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in texts(batch.column("text")):
                found, owner = features(piece)
                order = np.argsort(owner, kind="stable")
                ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(piece)))])
                own, offsets, _ = distinct(found[order], ends)
                rows = [own[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]
                grades = batch.column("grade").slice(piece.first, len(piece))
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), grades], ["found", "grade"])

    named = docs.select("doc_id", "text", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("row"))
    met = named.join(F.broadcast(kept(chosen, "chosen")), "doc_id")  # max_rows ids
    rows = kept(bounded_sample(met.select("row", "grade"), max_rows), "chosen_rows")
    joined = named.join(F.broadcast(rows), "row").dropDuplicates(["row", "grade"])  # max_rows rows
    return kept(joined.select("text", F.col("grade").cast("int")).mapInArrow(read, "found binary, grade int"), "sample")


def _in_batch(batch: pa.RecordBatch, grades: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of a batch, the document of each, and each document's grade as a place in ``grades``."""
    found = [np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column("found")]
    y = np.searchsorted(grades, batch.column("grade").to_numpy())
    owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
    return np.concatenate(found) if found else np.zeros(0, np.uint64), owner, y


def _chosen_features(
    sample: DataFrame, grades: np.ndarray, mean: float, spread: float, least: int, z: float, max_features: int
) -> tuple[np.ndarray, np.ndarray]:
    """Sorted features that say something of the grade, and whether they point upwards; counted by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, owner, y = _in_batch(batch, grades)
            terms, place, times = np.unique(found, return_inverse=True, return_counts=True)
            yield pa.RecordBatch.from_pydict({
                "term": terms.view(np.int64), "n": times.astype(np.int64),
                "total": np.bincount(place, y[owner], minlength=len(terms)).astype(np.int64),
            })

    off = (F.col("total") - F.col("n") * mean) / F.sqrt("n") / spread
    rows = (
        sample.mapInArrow(count, "term long, n long, total long").groupBy("term")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total")).filter(F.col("n") >= least)
        .select("term", off.alias("off")).filter(F.abs("off") >= z)
        .orderBy(F.abs("off").desc(), "term").limit(max_features).collect()
    )
    terms = np.array([r.term for r in rows], np.int64).view(np.uint64)
    order = np.argsort(terms)
    return terms[order], np.array([r.off > 0 for r in rows], bool)[order]


def _documents(sample: DataFrame, grades: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sampled documents by their chosen features only: features, the document of each, and grades."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, owner, y = _in_batch(batch, grades)
            place = np.minimum(np.searchsorted(terms, found), max(0, len(terms) - 1))
            known = terms[place] == found if len(terms) else np.zeros(len(found), bool)
            place, owner = place[known].astype(np.int32), owner[known]
            ends = np.searchsorted(owner, np.arange(len(y) + 1))
            rows = [place[a:b].tobytes() for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), pa.array(y)], ["places", "y"])

    rows = sorted((r.y, bytes(r.places)) for r in sample.mapInArrow(choose, "places binary, y long").collect())
    places = [np.frombuffer(p, np.int32) for _, p in rows]
    return (np.concatenate(places).astype(np.int64), np.repeat(np.arange(len(rows)), [len(p) for p in places]),
            np.array([y for y, _ in rows], np.int64))


def _graded(grades: np.ndarray, y: np.ndarray, evidence: np.ndarray, severities: int) -> tuple[np.ndarray, np.ndarray]:
    toxic = grades[y] > 0
    if toxic.any():
        cuts = np.quantile(evidence[toxic], np.arange(1, severities) / severities, method="higher")
        grade = np.where(toxic, 1 + np.searchsorted(cuts, evidence, "left"), 0)
        return np.unique(grade, return_inverse=True)
    return grades, y


def fit(
    docs: DataFrame, labels: DataFrame, *, max_rows: int = 8192, max_features: int = 20_000, least: int = 5,
    z: float = 6.0, severities: int = 1, penalty: float = 1e-3, rounds: int = 800,
) -> OrdinalModel:
    """``labels`` has doc_id and ``grade``, a whole number of 0 or more. Where grades only say whether a document is
    toxic (1) or not (0), ``severities`` splits the toxic ones into so many grades of equal size, by the number of
    their different features that point upwards."""
    sample = _sample(docs, labels, max_rows)
    per_grade = {r.grade: r["count"] for r in sample.groupBy("grade").count().collect()}  # a row per grade
    grades = np.array(sorted(per_grade), np.int64)
    none = np.zeros(0)
    if len(grades) < 2:
        return OrdinalModel(none.astype(np.uint64), none, none, grades if len(grades) else np.zeros(1, np.int64))
    ranks = np.repeat(np.arange(len(grades)), [per_grade[g] for g in grades])
    terms, upwards = _chosen_features(sample, grades, float(ranks.mean()), float(ranks.std()), least, z, max_features)
    column, row, y = _documents(sample, grades, terms)
    if severities > 1:
        grades, y = _graded(grades, y, np.bincount(row, upwards[column], minlength=len(y)), severities)

    shares = np.cumsum(np.bincount(y, minlength=len(grades)))[:-1] / len(y)
    weights, thresholds = np.zeros(len(terms)), np.log(shares / (1 - shares))
    lower = np.where(y > 0, y - 1, 0)
    upper = np.minimum(y, len(thresholds) - 1)
    moments = [np.zeros(len(terms) + len(thresholds)) for _ in range(2)]
    for t in range(1, rounds + 1):  # Adam on the mean log-likelihood
        score = np.bincount(row, weights[column], minlength=len(y))
        a = np.where(y < len(thresholds), _logistic(thresholds[upper] - score), 1.0)
        b = np.where(y > 0, _logistic(thresholds[lower] - score), 0.0)
        p = np.maximum(a - b, 1e-9)
        da, db = a * (1 - a) / p, b * (1 - b) / p
        gain = np.bincount(upper, da, minlength=len(thresholds)) - np.bincount(lower, db, minlength=len(thresholds))
        slope = np.bincount(column, (db - da)[row], minlength=len(terms))
        gradient = np.concatenate([slope, gain]) / len(y)
        gradient[:len(terms)] -= penalty * weights / max(1, len(terms))
        for m, value, keep in zip(moments, (gradient, gradient ** 2), (0.9, 0.999)):
            m *= keep
            m += (1 - keep) * value
        step = 0.2 * (moments[0] / (1 - 0.9 ** t)) / (np.sqrt(moments[1] / (1 - 0.999 ** t)) + 1e-8)
        weights = weights + step[:len(terms)]
        thresholds = np.maximum.accumulate(thresholds + step[len(terms):])
    return OrdinalModel(terms, weights, thresholds, grades)


def score(docs: DataFrame, model: OrdinalModel, reject: float = 0.5) -> DataFrame:
    """Per document: doc_id, expected severity, the likeliest grade, the probability of any grade above the lowest,
    and whether it is rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most max_features weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            at = 0
            for piece in texts(batch.column("text")):
                p = own.probabilities(own.scores(piece))
                above = p[:, own.grades > 0].sum(axis=1)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(at, len(piece)), pa.array(p @ own.grades),
                    pa.array(own.grades[p.argmax(axis=1)].astype(np.int32)), pa.array(above), pa.array(above >= reject),
                ], ["doc_id", "severity", "grade", "p_toxic", "toxic"])
                at += len(piece)

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, severity double, grade int, p_toxic double, toxic boolean"
    )


def keep_clean(docs: DataFrame, model: OrdinalModel, reject: float = 0.5) -> DataFrame:
    """The documents that are not rejected, with all their columns, in the same pass that scores them."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            clean = [np.zeros(0, bool)]
            for piece in texts(batch.column("text")):
                p = own.probabilities(own.scores(piece))
                clean.append(p[:, own.grades > 0].sum(axis=1) < reject)
            yield batch.filter(pa.array(np.concatenate(clean)))

    return docs.mapInArrow(run, docs.schema)


def toxic_grades(labels: DataFrame) -> DataFrame:
    """Grades from binary labels: 1 for toxic documents, 0 for others."""
    return labels.select("doc_id", F.col("toxic").alias("grade"))

import random

import numpy as np
import pyarrow as pa
import pytest

from activitymill.llm import toxicity as t
from activitymill.llm.words import texts
from tests.llm import corpus

BAD = ["vile", "nasty", "awful", "rotten"]


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(3)
    rows = []
    for i in range(900):
        words = corpus.prose(rng, rng.randint(20, 200)).split(" ")
        bad = [0, 0, 1, 3, 9][i % 5]
        for _ in range(bad):
            words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", "ly", "est"]))
        rows.append((i, " ".join(words), int(bad > 0), bad))
    return rows


def test_held_out_accuracy_and_severity_rises_with_evidence(spark, labelled):
    docs = spark.createDataFrame([r[:2] for r in labelled], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in labelled if r[0] < 600], "doc_id long, toxic int")
    model = t.fit(docs, t.toxic_grades(labels), severities=3)
    assert len(model.thresholds) == 3 and (np.diff(model.thresholds) >= 0).all()
    got = {r.doc_id: r for r in t.score(docs, model).collect()}
    held = [r for r in labelled if r[0] >= 600]
    assert sum(got[i].toxic == bool(y) for i, _, y, _ in held) >= 0.97 * len(held)
    mean = [np.mean([got[i].severity for i, _, _, n in held if n == k]) for k in (0, 1, 3, 9)]
    assert mean == sorted(mean) and mean[3] > mean[1] + 0.5
    assert t.keep_clean(docs, model).count() == sum(not r.toxic for r in got.values())


def test_given_grades_share_one_weight_per_feature(spark, labelled):
    grade = {0: 0, 1: 1, 3: 2, 9: 5}
    docs = spark.createDataFrame([r[:2] for r in labelled], "doc_id long, text string")
    model = t.fit(docs, spark.createDataFrame([(r[0], grade[r[3]]) for r in labelled], "doc_id long, grade int"))
    assert model.grades.tolist() == [0, 1, 2, 5] and len(model.weights) == len(model.terms)
    piece = next(texts(pa.array([r[1] for r in labelled])))
    p = model.probabilities(model.scores(piece))
    assert np.allclose(p.sum(axis=1), 1) and (p >= 0).all()


def test_odd_texts_labels_and_columns(spark, labelled):
    docs = corpus.documents(spark)
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(40)] + [(None, 1), (3, None), (3, 0), (3, 0), (10_000, 1)], "doc_id long, toxic int"
    )
    model = t.fit(docs, t.toxic_grades(labels), severities=3)
    scored = t.score(docs, model)
    assert scored.count() == docs.count() and scored.filter("severity is null or p_toxic is null").count() == 0
    assert t.keep_clean(docs, model).columns == docs.columns
    one = t.fit(docs, t.toxic_grades(labels.filter("toxic = 1")))
    assert {r.grade for r in t.score(docs, one).collect()} == {1}
    nothing = t.fit(docs, t.toxic_grades(labels.limit(0)))
    assert t.keep_clean(docs, nothing).count() == docs.count()
    assert t.score(corpus.none(spark), model).collect() == [] and t.keep_clean(corpus.none(spark), model).collect() == []


def test_the_sample_is_bounded_and_does_not_depend_on_partitions(spark, labelled):
    docs = spark.createDataFrame([r[:2] for r in labelled], "doc_id long, text string")
    labels = t.toxic_grades(spark.createDataFrame([(r[0], r[2]) for r in labelled], "doc_id long, toxic int"))
    assert t._sample(docs, labels, 100).count() == 100
    a, b = (t.fit(d, labels, max_rows=300) for d in (docs, docs.repartition(5)))
    assert (a.terms == b.terms).all() and np.allclose(a.weights, b.weights)

import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm import corpus


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Clean documents, and planted ones of each kind: toxic, copies, near copies, a passage, benchmark leaks."""
    rng = random.Random(21)
    clean = [corpus.prose(rng, rng.randint(60, 160)) for _ in range(150)]
    toxic = [corpus.prose(rng, 60) + " vile nasty " + corpus.prose(rng, 40) for _ in range(30)]
    item, passage = corpus.prose(rng, 30), corpus.prose(rng, 70)
    near = corpus.prose(rng, 200).split(" ")
    changed = [*near[:100], "changed", *near[101:]]
    planted = {
        "copy": [clean[0], clean[0]], "near": [" ".join(near), " ".join(changed)],
        "passage": [corpus.prose(rng, 90) + " " + passage, passage + " " + corpus.prose(rng, 90)],
        "leak": [corpus.prose(rng, 50) + " " + item + " " + corpus.prose(rng, 50)],
    }
    texts = clean + toxic + [t for v in planted.values() for t in v]
    rows = [(i, t, "en", ["a", "b", "c"][i % 3], len(t)) for i, t in enumerate(texts)] + [(None, None, None, None, None)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(150 <= i < 180)) for i in range(180)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_each_stage_takes_what_was_planted_and_leaves_the_rest(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns, left = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, tables)
        assert docs.columns == columns and docs.schema["n_chars"].dataType.typeName() == "long"
        folder = f"{tables}/out_{name}"
        docs.write.parquet(folder)
        docs = spark.read.parquet(folder)
        left[name] = {r.doc_id: r for r in docs.collect()}
    ids = {name: set(rows) for name, rows in left.items()}
    everything = set(range(187)) | {None}
    assert ids["toxicity"] == everything - set(range(150, 180))
    assert ids["ngram_jaccard_join"] == ids["toxicity"] - {180, 181, 183}
    cut = left["substring_dedup"]
    assert set(cut) == ids["ngram_jaccard_join"]
    assert {i for i in cut if i is not None and cut[i].text != left["ngram_jaccard_join"][i].text} == {185}
    assert len(corpus.words(cut[185].text)) == 90 and cut[185].n_chars == len(cut[185].text)
    assert ids["benchmark_decontamination"] == set(cut) - {186}


def test_run_is_the_stages_one_after_the_other(spark, tables):
    found = corpus_pipeline.run(spark, tables)
    assert found.columns == ["doc_id", "size", "source_size", "target", "taken"]
    rows = {r.doc_id: r for r in found.collect()}
    assert len(rows) == 154 and rows[185]["size"] == 90 and rows[None]["taken"] == 0
    total = sum(r["size"] for r in rows.values())
    assert abs(sum(r.taken for r in rows.values()) - 1.5 * total) < 100
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in entry.oracle_sql()


def test_everything_is_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(entry.oracle_sql()) <= set(names)

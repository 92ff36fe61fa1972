"""The corpus pipeline: toxic documents go, one of each group of near copies stays, repeated passages are cut out,
documents that hold benchmark items go, and the rest is mixed to target weights.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activitymill.llm import decontaminate, jaccard_join, mixing, paragraphs, toxicity
from activitymill.llm.work import kept, ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model, fitted on the labelled ones, does not reject."""
    ship(spark)
    model = toxicity.fit(docs, toxicity.toxic_grades(_table(spark, sf_dir, "labels")), severities=3)
    return toxicity.keep_clean(docs, model)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies."""
    ship(spark)
    return jaccard_join.one_of_each(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; ``n_chars`` follows the text."""
    ship(spark)
    cut = paragraphs.without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship(spark)
    return decontaminate.keep_clean(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document, the words that the mix takes."""
    return mixing.mix_sources(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", one_of_each_group),
    ("substring_dedup", cut_repeated_passages),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix),
]

# The classifier, the join and the dedup cannot be put in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), name)
    return docs

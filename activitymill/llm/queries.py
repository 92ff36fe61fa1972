"""The registered queries of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from activitymill.llm import (
    bloom_lm, decontaminate, imatch, jaccard_join, language_id, mixing, paragraphs, prefix_trie, repair, suffix_dedup,
    toxicity, url_filter, warc,
)
from activitymill.llm.work import ship
from activitymill.plans.shared import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("rid")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score(docs, toxicity.fit(docs, toxicity.toxic_grades(labels), severities=3))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    listed = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return warc.read_archives(spark, folder, listed, columns=columns).select(*columns)


def op4_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score_documents(table(spark, sf_dir, "documents"))


def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return imatch.with_next(docs, imatch.lexicon(docs))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removals(table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.fit(url_filter.labelled_by_rules(pages)))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.links(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "copies", "links", "group_id")


def op9_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.removals(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.repair(conversations, repair.damaged(conversations))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.fit(docs.filter(~language_id.held_out())))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuilt(table(spark, sf_dir, "conversations")))


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    found = (
        op1_decontaminate, op2_toxicity, op3_warc, op4_bloom_lm, op5_imatch, op6_suffix_dedup, op7_url_filter,
        op8_jaccard_join, op9_paragraphs, op10_mixing, op11_repair, op12_language_id, op13_prefix_trie,
    )
    return {query.__name__: _shipped(query) for query in found}


OP3_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
m AS (SELECT *, octet_length(payload) AS n, max(page_id) OVER (PARTITION BY payload) AS first FROM p),
r AS (SELECT *, n >= 1000 AND page_id IS DISTINCT FROM first AND first IS NOT NULL AS again FROM m)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to
FROM r
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_warc": OP3_SQL, "op6_suffix_dedup": suffix_dedup.ORACLE_SQL, "op8_jaccard_join": jaccard_join.ORACLE_SQL,
        "op10_mixing": mixing.ORACLE_SQL, "op11_repair": repair.ORACLE_SQL, "op13_prefix_trie": prefix_trie.ORACLE_SQL,
    }

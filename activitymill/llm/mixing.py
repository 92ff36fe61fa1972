"""Mixing sources to target weights by Sainte-Lague apportionment, with DataFrame functions only.

Sources in code-point order, null last, weigh ``weights`` in turn and share ``share`` times all words. A target stops at
``limit`` times its source's words; the excess goes to the others by weight until none is above.

The words of a source are dealt to shards and, within a shard, laid end to end in a seeded order and cut into blocks of
``block_words``. Sainte-Lague (highest quotients votes / (2k + 1)) gives each source a whole number of blocks, and
within a source each shard. A shard then takes its quota by systematic selection with a seeded offset: of n blocks and
a quota q, block b is taken floor(((b + 1) q + o) / n) - floor((b q + o) / n) times, at most ``limit`` times. What a
document gives follows from where its words begin and end, so no block is ever a row.

Defined cases: a null or empty text has no words and gives none; a null source is a source; a null id is ordered as
an empty one; repeated rows are separate documents; other columns are ignored; an empty table gives no rows. Equal
quotients go to the earlier source or shard. A source capped at its limit may miss a few blocks by rounding.

One row per source and about five per shard of a source pass through one task; documents never do. A shard has about
``shard_words`` words, so a source with a third of all rows is split into as many shards as it needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from activitymill.llm.work import kept

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: Sequence[int], share: float, limit: int) -> DataFrame:
    """Sources with ``source_size``, to which ``place`` and ``target`` are added."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sources.withColumn("place", F.row_number().over(by_name))
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    # In the order in which targets reach their limits, what is left for a source if all before it are at theirs.
    filling = Window.orderBy(F.col("most") / F.col("weight"), "place")
    before = F.coalesce(F.sum("most").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rate = (
        ranked.withColumn("weight", turn)
        .withColumn("most", F.col("source_size") * limit)
        .withColumn("rate", (F.sum("source_size").over(everything) * share - before) / left)
    )
    fits = F.max(F.when(F.col("most") >= F.col("rate") * F.col("weight"), F.col("rate"))).over(everything)
    target = F.least(F.col("most").cast("double"), F.coalesce(fits, F.lit(0.0)) * F.col("weight"))
    return rate.withColumn("target", target).drop("weight", "most", "rate")


def apportion(parties: DataFrame, within: Sequence[str], votes: str, seats: str, most: str, place: str) -> DataFrame:
    """Add ``quota``: how many of ``seats`` each party gets by highest quotients, none more than ``most``.

    Seats that any divisor near the right one gives are counted at once; only those in doubt, about five per party,
    are compared one by one.
    """
    group = Window.partitionBy(*within)
    share = F.try_divide(F.col(votes) * F.col(seats), F.sum(votes).over(group))
    slack = F.try_divide(F.count("*").over(group) / 2, F.col(seats))
    sure = F.greatest(F.lit(0), F.floor(F.coalesce(share * (1 - slack), F.lit(0)) + 0.5) - 1)
    open_to = F.ceil(F.coalesce(share * (1 + slack), F.lit(0)) + 0.5) + 1
    bounds = (
        parties.withColumn("sure", F.least(sure, F.col(most)).cast("long"))
        .withColumn("open_to", F.least(open_to, F.col(most)).cast("long"))
        .withColumn("left", F.col(seats) - F.sum("sure").over(group))
    )
    doubtful = F.when(F.col("open_to") > F.col("sure"), F.sequence("sure", F.col("open_to") - 1))
    each = bounds.withColumn("k", F.explode_outer(doubtful)).withColumn(
        "quotient", F.when(F.col(votes) > 0, F.col(votes) / (2 * F.col("k") + 1))
    )
    order = group.orderBy(F.col("quotient").desc_nulls_last(), place, "k")
    won = F.col("quotient").isNotNull() & (F.row_number().over(order) <= F.col("left"))
    ranked = each.withColumn("won", F.when(won, 1).otherwise(0))
    return ranked.groupBy(*parties.columns).agg((F.first("sure") + F.sum("won")).alias("quota"))


def mix_sources(
    docs: DataFrame, *, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, limit: int = 2,
    block_words: int = 16, shard_words: int = 1 << 19, seed: str = "mix",
) -> DataFrame:
    """Per document: doc_id, size, source_size, target of its source, and taken, the words the mix takes."""
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized = kept(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("key")), "sized")

    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, limit)
    blocks = F.ceil(F.sum("target").over(Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)) / block_words - 0.5)
    parties = sources.withColumn("seats", blocks).withColumn(
        "most", F.ceil(F.col("source_size") / block_words) * limit
    ).withColumn("whole", F.lit(1))
    by_source = apportion(parties, ["whole"], "target", "seats", "most", "place").select(
        F.col("source").alias("of"), "source_size", "target", "quota",
        F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).alias("shards"),
    )

    number = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    dealt = (
        sized.join(by_source, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("shard", number % F.col("shards"))
    )
    per_shard = dealt.groupBy("of", "quota", "shard").agg(F.sum("size").alias("shard_size")).select(
        "of", F.col("quota").alias("source_quota"), "shard", "shard_size",
        F.ceil(F.col("shard_size") / block_words).alias("blocks"),
    ).withColumn("most", F.col("blocks") * limit)
    start = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce("shard_of", F.lit("")), F.col("at_shard").cast("string")))
    quotas = apportion(per_shard, ["of"], "shard_size", "source_quota", "most", "shard").select(
        F.col("of").alias("shard_of"), F.col("shard").alias("at_shard"), F.col("blocks"), F.col("quota").alias("takes")
    ).withColumn("offset", F.conv(F.substring(start, 1, 8), 16, 10).cast("long") % F.greatest(F.lit(1), "blocks"))

    placed = dealt.join(
        quotas, F.col("of").eqNullSafe(F.col("shard_of")) & (F.col("shard") == F.col("at_shard"))
    )
    laid = Window.partitionBy("of", "shard").orderBy("key", "doc_id", "size")
    end = F.sum("size").over(laid.rowsBetween(Window.unboundedPreceding, 0))

    def taken_before(block: Column) -> Column:
        picked = F.floor((block * F.col("takes") + F.col("offset")) / F.col("blocks"))
        return picked

    def words_before(x: Column) -> Column:
        block = F.floor(x / block_words)
        times = taken_before(block + 1) - taken_before(block)
        return taken_before(block) * block_words + (x - block * block_words) * times

    taken = F.when(F.col("blocks") > 0, words_before(F.col("end")) - words_before(F.col("end") - F.col("size")))
    return placed.withColumn("end", end).select(
        "doc_id", "size", "source_size", "target", F.coalesce(taken, F.lit(0)).cast("long").alias("taken")
    )


ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(concat('mix:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS key
  FROM documents
), src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS place FROM src
), weighed AS (
  SELECT *, [5, 2, 1][CAST((place - 1) % 3 AS INTEGER) + 1] AS weight, source_size * 2 AS most FROM ranked
), rated AS (
  SELECT *, (sum(source_size) OVER () * CAST(1.5 AS DOUBLE)
      - coalesce(sum(most) OVER (ORDER BY CAST(most AS DOUBLE) / weight, place
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY CAST(most AS DOUBLE) / weight, place
                          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
  FROM weighed
), targets AS (
  SELECT source, source_size, place, least(CAST(most AS DOUBLE), coalesce(
      max(CASE WHEN most >= rate * weight THEN rate END) OVER (), 0) * weight) AS target FROM rated
), parties AS (
  SELECT *, CAST(ceil(sum(target) OVER () / 16 - 0.5) AS BIGINT) AS seats,
         CAST(ceil(source_size / CAST(16 AS DOUBLE)) AS BIGINT) * 2 AS most FROM targets
), source_seat AS (
  SELECT source, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, place, k) AS n, seats
  FROM (SELECT *, unnest(range(most)) AS k FROM parties WHERE target > 0)
), by_source AS (
  SELECT source, source_size, target,
         (SELECT count(*) FROM source_seat s WHERE s.source IS NOT DISTINCT FROM p.source AND n <= s.seats) AS quota,
         greatest(1, CAST(ceil(source_size / CAST(524288 AS DOUBLE)) AS BIGINT)) AS shards
  FROM parties p
), dealt AS (
  SELECT d.*, b.source_size, b.target, b.quota, CAST('0x' || substr(key, 1, 8) AS BIGINT) % shards AS shard
  FROM sized d JOIN by_source b ON d.source IS NOT DISTINCT FROM b.source
), shards AS (
  SELECT source, quota, shard, CAST(sum(size) AS BIGINT) AS shard_size,
         CAST(ceil(sum(size) / CAST(16 AS DOUBLE)) AS BIGINT) AS blocks FROM dealt GROUP BY ALL
), shard_seat AS (
  SELECT source, shard, quota,
         row_number() OVER (PARTITION BY source ORDER BY shard_size / CAST(2 * k + 1 AS DOUBLE) DESC, shard, k) AS n
  FROM (SELECT *, unnest(range(2 * blocks)) AS k FROM shards WHERE shard_size > 0)
), quotas AS (
  SELECT source, shard, blocks, (SELECT count(*) FROM shard_seat t WHERE t.source IS NOT DISTINCT FROM s.source
      AND t.shard = s.shard AND n <= t.quota) AS takes,
      CAST('0x' || substr(md5(concat('mix:', coalesce(source, ''), ':', shard)), 1, 8) AS BIGINT)
        % greatest(1, blocks) AS start_at
  FROM shards s
), laid AS (
  SELECT d.*, q.blocks, q.takes, q.start_at,
         CAST(sum(size) OVER (PARTITION BY d.source, d.shard ORDER BY key, doc_id, size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS x1
  FROM dealt d JOIN quotas q ON d.source IS NOT DISTINCT FROM q.source AND d.shard = q.shard
), ends AS (
  SELECT *, x1 - size AS x0, x1 // 16 AS b1, (x1 - size) // 16 AS b0 FROM laid
)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN blocks = 0 THEN 0 ELSE
    ((b1 * takes + start_at) // blocks) * 16
      + (x1 - b1 * 16) * (((b1 + 1) * takes + start_at) // blocks - (b1 * takes + start_at) // blocks)
    - ((b0 * takes + start_at) // blocks) * 16
      - (x0 - b0 * 16) * (((b0 + 1) * takes + start_at) // blocks - (b0 * takes + start_at) // blocks)
  END AS BIGINT) AS taken
FROM ends
"""

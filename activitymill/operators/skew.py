"""Keys that hold a large share of all rows: finding them in bounded memory, and joining rows in spite of them.

``key_skew`` of the profiles counts every key, which shuffles a row per key and task. Here a sketch of fixed size is
kept per day instead; sketches add up, so days are sketched once and merged for any span. A sketch may be wrong about
counts but misses no key of the asked share, so the few keys it names are counted again exactly.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_HEAVY = 100_000  # rows of the other side that may be broadcast for heavy keys
SALTS = 32


def _tracked(share: float) -> int:
    """Keys a sketch has to track: its error is 3.5 / tracked of all rows, here less than a quarter of ``share``."""
    return 1 << max(10, int(16 / share - 1).bit_length())


def key_sketches(df: DataFrame, key: str, by: Sequence[str] = (), share: float = 0.01) -> DataFrame:
    """Per group one row: how many rows it has and a sketch of its keys, nulls left out. Fit for storing."""
    sketch = F.expr(f"approx_top_k_accumulate(`{key}`, {_tracked(share)})")
    return df.filter(F.col(key).isNotNull()).groupBy(*by).agg(sketch.alias("sketch"))


def candidates(sketches: DataFrame, share: float = 0.01) -> DataFrame:
    """Keys (``value``) that may have ``share`` of the rows that were sketched, of all groups together.

    At most 1 / share keys have that much, and a sketch may name others of nearly that much; twice as many are kept.
    """
    merged = sketches.agg(F.expr(f"approx_top_k_combine(sketch, {_tracked(share)})").alias("sketch"))
    found = merged.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {int(2 / share)})")).alias("found"))
    return found.select(F.col("found.item").alias("value"))


def heavy_keys(df: DataFrame, key: str, share: float = 0.01, sketches: DataFrame | None = None) -> DataFrame:
    """Keys with at least ``share`` of all rows, null keys included in the total: key, row_count and share.

    ``sketches`` are those of ``df``, if they are stored. Only candidates are counted, so what is shuffled is bounded
    by them and does not grow with the number of keys. A null key is never listed.
    """
    found = candidates(key_sketches(df, key, share=share) if sketches is None else sketches, share)
    total = df.agg(F.count("*").alias("total")).scalar()
    named = df.select(F.col(key).alias("value")).join(F.broadcast(found), "value")  # 2 / share rows
    counted = named.groupBy("value").agg(F.count("*").alias("row_count")).withColumn("share", F.col("row_count") / total)
    return counted.filter(F.col("share") >= share).select(F.col("value").alias(key), "row_count", "share")


def split_join(
    fact: DataFrame, other: DataFrame, key: str, how: str = "left", *, share: float = 0.001, most_heavy: int = MOST_HEAVY,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """``fact`` with the columns of ``other`` that have the same ``key``, row by row, for ``how`` left or inner.

    Rows go three ways. Keys with ``share`` of the rows meet the rows that ``other`` has for them where they are, if
    those are few (``most_heavy``); if the keys are not unique there and have more, both sides are dealt over salts.
    Null keys meet nothing and stay where they are. All others are joined as Spark sees fit, and no key of theirs
    holds more than ``share``. Where no key is heavy this is a plain join.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"left or inner, not {how}")
    columns = [*fact.columns, *(c for c in other.columns if c != key)]
    listed = heavy_keys(fact, key, share) if heavy is None else heavy
    values = [r[0] for r in listed.select(key).collect()]  # at most 1 / share
    null, is_heavy = F.col(key).isNull(), F.col(key).isin(*values)
    if not values:
        return fact.join(other, key, how).select(*columns)
    rest = fact.filter(~null & ~is_heavy).join(other.filter(~is_heavy), key, how)
    few = other.filter(is_heavy)
    met = fact.filter(is_heavy)
    if few.limit(most_heavy + 1).count() <= most_heavy:
        hot = met.join(F.broadcast(few), key, how)
    else:
        hot = _salted(met, few, key, how)
    parts = [rest, hot]
    if how == "left":
        added = [F.lit(None).cast(f.dataType).alias(f.name) for f in other.schema if f.name != key]
        parts.append(fact.filter(null).select("*", *added))
    return reduce(DataFrame.unionByName, [p.select(*columns) for p in parts])


def _salted(fact: DataFrame, other: DataFrame, key: str, how: str) -> DataFrame:
    """Each row of ``other`` meets a part of the fact rows of its key once per salt; a fact row has one salt."""
    salt = _unused("salt", [*fact.columns, *other.columns])
    dealt = fact.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    every = other.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(every, [key, salt], how).drop(salt)


def _unused(name: str, taken: Sequence[str]) -> str:
    while name in taken:
        name += "_"
    return name


def fact_with_names(events: DataFrame, dim: DataFrame, key: str, names: dict[str, str], **options) -> DataFrame:
    """Every fact row with current attributes of a dimension under new names; unknown and null keys have none."""
    attributes: list[Column] = [F.col(c).alias(to) for c, to in names.items()]
    return split_join(events, dim.select(key, *attributes), key, **options)

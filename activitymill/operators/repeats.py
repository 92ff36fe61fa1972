"""Keys that stand in several rows of several days, without shuffling the rows of earlier days.

Each day keeps a filter of its keys beside its rows. Keys of new days are probed in the filters of earlier ones; only
the keys that a filter may hold are looked up in the rows of that day. So a filter can cost time, never a result.

A filter is a Bloom filter cut into blocks: a key sets ``PROBES`` bits of one block, so probing needs one row per key
and day. Blocks are as large as Spark's bitmaps, and a day has a power of two of them by how many rows it has, so that
filters stay as selective on large days. At 32 bits a row some 6 keys in 100,000 pass the filter of a day wrongly.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activitymill.operators.checks import duplicate_keys

BLOCK_BITS = 32_768  # fixed value: bits in a bitmap of Spark's bitmap functions
BITS_PER_ROW = 32
PROBES = 5
_LEAST_LEVEL = 6  # 64 blocks, so that the probes of a small day's filter spread over tasks
# Columns of a filter besides those it is kept by: it has 2 ** level blocks.
FILTER = "level INT, block BIGINT, bitmap BINARY"


def _all_set(names: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in names])


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("_h"), F.xxhash64(key, F.lit(1)).alias("_g")]


def _block() -> Column:
    return F.expr("shiftrightunsigned(_h, 64 - level)").alias("block")


def _positions() -> list[Column]:
    """Places in the block: four from the second hash, and one from the end of the first, whose beginning is the block."""
    low = F.lit(BLOCK_BITS - 1).cast("long")
    return [F.shiftrightunsigned("_g", 15 * i).bitwiseAND(low) for i in range(PROBES - 1)] + [F.col("_h").bitwiseAND(low)]


def _is_set(bitmap: str, position: Column) -> Column:
    byte = F.substring(F.col(bitmap), (F.floor(position / 8) + 1).cast("int"), F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), (position % 8).cast("int")) == 1


def key_filters(df: DataFrame, key: str, by: Sequence[str], bits_per_row: int = BITS_PER_ROW) -> DataFrame:
    """Filters of the keys of each group (``by``), a row per block: ``by``, level, block, bitmap. Fit for storing.

    Null keys and rows without a group are left out; a group of null keys only has no filter.
    """
    by = list(by)
    keyed = df.filter(_all_set([key, *by])).select(*by, F.col(key).alias("_key"))
    level = F.greatest(F.lit(_LEAST_LEVEL), F.ceil(F.log2(F.count("*") * bits_per_row / BLOCK_BITS)).cast("int"))
    levels = keyed.groupBy(*by).agg(level.alias("level"))
    hashed = keyed.join(levels, by).select(*by, "level", *_hashes(F.col("_key")))
    bits = hashed.select(*by, "level", _block(), F.explode(F.array(*_positions())).alias("bit"))
    return bits.groupBy(*by, "level", "block").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def candidates(df: DataFrame, filters: DataFrame, key: str) -> DataFrame:
    """Keys of ``df`` with each group whose filter may hold them: ``key`` and the columns of the group."""
    by = [c for c in filters.columns if c not in ("level", "block", "bitmap")]
    levels = [r.level for r in filters.select("level").distinct().collect()]  # at most 49
    if not levels:
        return filters.select(F.lit(None).cast(df.schema[key].dataType).alias(key), *by)
    keys = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("_key")).distinct()
    probes = keys.select("_key", *_hashes(F.col("_key")), F.explode(F.array(*map(F.lit, levels))).alias("level"))
    met = probes.select("*", _block()).join(filters, ["level", "block"])
    for position in _positions():
        met = met.filter(_is_set("bitmap", position))
    return met.select(F.col("_key").alias(key), *by)


def known_rows(new: DataFrame, old: DataFrame, filters: DataFrame, key: str) -> DataFrame:
    """Rows of ``old`` whose key is also in ``new``. ``filters`` are those of ``old``, by columns that it has.

    Rows of days whose filter names no key are not read where Spark can prune them, and no row of ``old`` is shuffled
    where the candidates are few enough for Spark to broadcast. Rows without a group have no filter and are all read.
    """
    by = [c for c in filters.columns if c not in ("level", "block", "bitmap")]
    grouped = old.join(candidates(new, filters, key), [key, *by], "left_semi")
    return grouped.unionByName(old.filter(~_all_set(by)).join(new.select(key).distinct(), key, "left_semi"))


def repeated_keys(new: DataFrame, old: DataFrame, filters: DataFrame, key: str) -> DataFrame:
    """Keys of ``new`` that stand in more than one row of ``new`` and ``old`` together, with how often.

    Nulls are ignored. What was repeated before and is not in ``new`` is not reported again.
    """
    return duplicate_keys(new.select(key).unionByName(known_rows(new, old, filters, key).select(key)), key)

"""Validation profiles: figures that show whether a build holds together."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from activitymill.contract import PUSH, RAW_SCHEMA
from activitymill.operators.facts import target_events


def _side_by_side(**counts: DataFrame) -> DataFrame:
    """Single-row, single-column frames as the columns of one row."""
    rows = [df.toDF("n").select(F.lit(name).alias("side"), "n") for name, df in counts.items()]
    return reduce(DataFrame.unionByName, rows).agg(
        *[F.max(F.when(F.col("side") == name, F.col("n"))).alias(name) for name in counts]
    )


def grain(raw: DataFrame, fact_events: DataFrame) -> DataFrame:
    """Kept raw records against fact rows; they are equal when no row fanned out or got lost."""
    pair = _side_by_side(
        raw_events=target_events(raw).agg(F.count("*")), fact_rows=fact_events.agg(F.count("*"))
    )
    return pair.withColumn("holds", F.col("raw_events") == F.col("fact_rows"))


def fan_out(raw: DataFrame, fact_commits: DataFrame) -> DataFrame:
    """Pushes, the commits listed in them, and commit rows; the last two are equal."""
    listed = F.coalesce(F.sum(F.array_size("payload.commits")), F.lit(0)).alias("listed_commits")
    pushes = raw.filter(F.col("type") == PUSH).agg(F.count("*").alias("pushes"), listed)
    row = pushes.withColumn("commit_rows", fact_commits.agg(F.count("*")).scalar())
    return row.withColumn("holds", F.col("listed_commits") == F.col("commit_rows"))


def dimension_sizes(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per dimension against the fact; a dimension that is not smaller did not deduplicate."""
    def counted(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")

    fact_rows = fact.agg(F.count("*").alias("fact_rows")).scalar()
    sizes = reduce(DataFrame.unionByName, [counted(name, df) for name, df in dims.items()])
    return sizes.withColumn("fact_rows", fact_rows).withColumn("smaller", F.col("row_count") < F.col("fact_rows"))


def reconcile(fact_events: DataFrame, mart: DataFrame, measure: str = "event_count") -> DataFrame:
    """Events per type in the fact and in a mart by type, with the difference."""
    fact = fact_events.groupBy("event_type").agg(F.count("*").alias("fact_count"), F.lit(0).alias("mart_count"))
    counted = mart.groupBy("event_type").agg(F.lit(0).alias("fact_count"), F.sum(measure).alias("mart_count"))
    # Stacked and summed, which pairs up missing types and a null type like a null-safe full join would.
    both = fact.unionByName(counted).groupBy("event_type").agg(
        F.sum("fact_count").alias("fact_count"), F.sum("mart_count").alias("mart_count")
    )
    return both.withColumn("difference", F.col("fact_count") - F.col("mart_count"))


def fingerprint(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per group the number of rows, and the sum and exclusive or of their hashes, whatever order they are in.

    A row's hash takes in which of its columns are null. The sum tells apart what an exclusive or does not (a row that
    is there twice too often), and the other way round.
    """
    row = F.xxhash64(*columns, *(F.col(c).isNull() for c in columns))
    return df.withColumn("_row", row).groupBy(*by).agg(
        F.count("*").alias("row_count"), F.sum(F.col("_row").cast("decimal(20,0)")).alias("row_sum"),
        F.bit_xor("_row").alias("row_xor"),
    )


def reconcile_content(left: DataFrame, right: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Groups of two tables that should hold the same rows: rows on each side, and whether their content differs.

    Counts alone agree where rows were swapped, doubled or changed. Both sides are read once and become a row per group
    before they meet; no row is joined.
    """
    sides = [fingerprint(df, by, columns).withColumn("_side", F.lit(side)) for side, df in ((0, left), (1, right))]
    both = sides[0].unionByName(sides[1])

    def of(side: int, name: str) -> Column:
        return F.max(F.when(F.col("_side") == side, F.col(name)))

    differs = F.lit(False)
    for name in ("row_count", "row_sum", "row_xor"):
        differs = differs | ~of(0, name).eqNullSafe(of(1, name))
    return both.groupBy(*by).agg(
        F.coalesce(of(0, "row_count"), F.lit(0)).alias("left_rows"),
        F.coalesce(of(1, "row_count"), F.lit(0)).alias("right_rows"), differs.alias("differs"),
    )


def payload_completeness(raw: DataFrame) -> DataFrame:
    """Share of pushes that carry commits."""
    pushes = raw.filter(F.col("type") == PUSH)
    counts = pushes.agg(
        F.count("*").alias("pushes"), F.count_if(F.array_size("payload.commits") > 0).alias("pushes_with_commits")
    )
    return counts.withColumn("share", F.try_divide("pushes_with_commits", "pushes"))


def key_skew(df: DataFrame, key: str) -> DataFrame:
    """Rows per key and their share of all rows."""
    total = df.agg(F.count("*").alias("total")).scalar()
    counts = df.groupBy(key).agg(F.count("*").alias("row_count"))
    return counts.withColumn("share", F.col("row_count") / total)


def has_schema(df: DataFrame, ddl: str = RAW_SCHEMA) -> bool:
    """Whether names, types and order are those of the contract, of raw records or of a table."""
    return df.schema.simpleString() == StructType.fromDDL(ddl).simpleString()


def contract_report(df: DataFrame, ddl: str) -> DataFrame:
    """Per declared column: its declared and found type, and how many rows have a value."""
    declared = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(ddl)}
    found = dict(df.dtypes)
    counts = df.agg(*[(F.count(name) if name in found else F.lit(None).cast("long")).alias(name) for name in declared])
    rows = F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.lit(kind).alias("declared_type"),
                 F.lit(found.get(name)).cast("string").alias("found_type"), F.col(name).alias("filled_rows"))
        for name, kind in declared.items()
    ])
    return counts.select(F.inline(rows))


def preview_check(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """How many rows a preview has, and how many of them are rows of the table."""
    shown = preview(df, n)
    known = shown.join(df.select(key), key, "left_semi")
    return _side_by_side(shown=shown.agg(F.count("*")), known=known.agg(F.count("*")))


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """Some n rows, in no order."""
    return df.limit(n)


def line_health(scanned: DataFrame) -> DataFrame:
    """Per landed day: lines read, lines that parse as no record, and records with a field that does not fit.

    ``scanned`` carries its source (see ``scan_events``).
    """
    bad = F.col("bad_line").isNotNull()
    return scanned.groupBy("landed_day").agg(
        F.count("*").alias("lines"),
        F.count_if(bad & F.col("type").isNull()).alias("broken_lines"),
        F.count_if(bad & F.col("type").isNotNull()).alias("misfit_records"),
    )

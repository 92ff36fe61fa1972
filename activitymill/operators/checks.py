"""Data-quality checks. A check is a rule on one column; it passes when no row fails it.

``failing_rows`` shows what fails. ``report`` counts failures for many checks at once: it reduces each checked
column to one row per value before comparing, so one value holding a third of the table is one row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


_BLOCK = 10_000  # rows written out at a time


@dataclass(frozen=True)
class Check:
    kind: str  # unique, not_null or relationship
    table: str
    column: str
    parent: str | None = None
    parent_column: str | None = None

    @property
    def name(self) -> str:
        target = f"_in_{self.parent}" if self.parent else ""
        return f"{self.kind}_{self.table}_{self.column}{target}"


# The columns of failing rows are unique_field, n_records and from_field.

# The eleven checks that gate a run.
GATE = (
    Check("unique", "dim_actor", "actor_id"),
    Check("not_null", "dim_actor", "actor_id"),
    Check("unique", "dim_repo", "repo_id"),
    Check("not_null", "dim_repo", "repo_id"),
    Check("unique", "dim_org", "org_id"),
    Check("not_null", "dim_org", "org_id"),
    Check("unique", "dim_time", "date_key"),
    Check("not_null", "dim_time", "date_key"),
    Check("not_null", "fact_events", "actor_id"),
    Check("relationship", "fact_events", "actor_id", "dim_actor", "actor_id"),
    Check("relationship", "fact_events", "repo_id", "dim_repo", "repo_id"),
)


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """Values seen more than once, with how often; nulls are ignored."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count("*").alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.filter(F.col(column).isNull())


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent row, once per child row; nulls are ignored.

    Values are counted before the join and written out again after it, in blocks, so that one that a third of the
    rows have is one row in the join.
    """
    keys = parent.select(F.col(parent_column).alias("from_field"))
    counted = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("from_field"))
        .agg(F.count("*").alias("n"))
        .join(keys, "from_field", "left_anti")
    )
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(_BLOCK).cast("long")))
    size = F.least(F.lit(_BLOCK).cast("long"), F.col("n") - F.col("block"))
    blocks = counted.withColumn("block", block).select("from_field", size.alias("size"))
    return blocks.select("from_field", F.explode(F.array_repeat(F.lit(0), F.col("size").cast("int")))).select("from_field")


def failing_rows(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    df = tables[check.table]
    if check.kind == "unique":
        return duplicate_keys(df, check.column)
    if check.kind == "not_null":
        return null_rows(df, check.column)
    return orphans(df, check.column, tables[check.parent], check.parent_column)


def _column_failures(df: DataFrame, column: str, checks: list[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Failures of all checks on one column, in one pass over it."""
    if all(c.kind == "not_null" for c in checks):
        totals = df.agg(*[F.count_if(F.col(column).isNull()).alias(c.name) for c in checks])
    else:
        values = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
        for c in checks:
            if c.kind == "relationship":
                parents = tables[c.parent].select(F.col(c.parent_column).alias("value")).distinct()
                values = values.join(parents.withColumn(c.name, F.lit(True)), "value", "left")
        totals = values.agg(*[_failures(c).alias(c.name) for c in checks])
    rows = F.array(*[
        F.struct(F.lit(c.name).alias("check_name"), F.col(c.name).cast("long").alias("failures")) for c in checks
    ])
    return totals.select(F.inline(rows))


def _failures(check: Check) -> Column:
    value, n = F.col("value"), F.col("n")
    if check.kind == "unique":
        return F.count_if(value.isNotNull() & (n > 1))
    failing = value.isNull() if check.kind == "not_null" else value.isNotNull() & F.col(check.name).isNull()
    return F.coalesce(F.sum(F.when(failing, n)), F.lit(0))


def report(tables: Mapping[str, DataFrame], checks: Iterable[Check] = GATE) -> DataFrame:
    """One row per check: name, number of failures, and the verdict."""
    def place(c: Check) -> tuple[str, str]:
        return c.table, c.column

    parts = [
        _column_failures(tables[table], column, list(group), tables)
        for (table, column), group in groupby(sorted(checks, key=place), key=place)
    ]
    failed = F.col("failures") != 0
    return reduce(DataFrame.unionByName, parts).select(
        "check_name", "failures", failed.alias("should_warn"), failed.alias("should_error")
    )

"""Table sources and sinks. The format and its options are parameters, so another connector needs no other code."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activitymill.sources.state import removed

_BEFORE = "activitymill.before"  # property of a table: the location it was moved from


class SchemaChange(Exception):
    """A table was to be replaced by rows of another schema."""


def read_table(
    spark: SparkSession, name: str, fmt: str | None = None, options: Mapping[str, str] | None = None
) -> DataFrame:
    """A catalog table by name, or with ``fmt`` the data at a path."""
    if fmt is None:
        return spark.table(name)
    return spark.read.format(fmt).options(**(options or {})).load(name)


def write_table(
    df: DataFrame,
    path: str | None,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> None:
    """Replace the whole table. Without a path the connector finds its table in ``options``."""
    writer = df.write.format(fmt).mode("overwrite").options(**(options or {}))
    if fmt in ("parquet", "orc", "json", "csv"):
        writer = writer.option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> None:
    """Replace only the partitions that have rows in ``df``."""
    (
        df.write.format(fmt)
        .mode("overwrite")
        .options(**(options or {}))
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .save(path)
    )


def stored_partitions(stored: DataFrame, days: tuple[int, int], by: Sequence[str]) -> set[tuple]:
    """Partitions holding rows of a span of landed days: one or two per day, so small enough for the driver."""
    within = stored.filter(F.col("landed_day").between(*days))
    return {tuple(row) for row in within.select(*by).distinct().collect()}


def replace_days(df: DataFrame, path: str, days: tuple[int, int], sub_partition: str | None = None) -> None:
    """Replace everything stored for a span of landed days, which ``df`` must cover, and leave all other days.

    Dynamic overwrite keeps old partitions for which ``df`` has no rows any more; these are emptied here. There is
    normally none: it takes a day landed again with fewer distinct event days, or with no rows for this table.
    """
    by = ["landed_day"] + ([sub_partition] if sub_partition else [])
    stored = read_if_exists(df.sparkSession, path, df)
    before = stored_partitions(stored, days, by) if stored is not None else set()
    stale = before - stored_partitions(df, days, by) if before else set()
    write_partitions(df, path, by)
    for values in stale:
        folder = "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in zip(by, values))
        write_table(df.drop(*by).limit(0), f"{path}/{folder}")


def read_if_exists(spark: SparkSession, path: str, like: DataFrame | str) -> DataFrame | None:
    """Parquet at a path under a known schema, or None if nothing was written there yet."""
    try:
        return spark.read.schema(like if isinstance(like, str) else like.schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def create_table_as(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None) -> None:
    """Create a catalog table from a query, replacing one of that name; below ``path`` if one is given."""
    df.write.format(fmt).mode("overwrite").options(**({"path": path} if path else {})).saveAsTable(name)


def replace_table_as(df: DataFrame, name: str, root: str, fmt: str = "parquet", new_columns: bool = False) -> str:
    """Create a catalog table from a query, or replace the rows of one that this made, without readers noticing.

    Rows are written to a new folder below ``root`` first; then the table's location moves there, which is one step of
    the catalog. A query that fails leaves the table as it was and removes its folder. The rows before stay on disk
    until the next time, for readers that have begun with them. A session that has read the table keeps its rows until
    ``REFRESH TABLE``. Returns the folder.

    Another schema raises ``SchemaChange`` after nothing was changed, unless ``new_columns`` is given: the catalog cannot
    change columns and location at once, so the table is then made anew, and is not there for a moment in between.
    """
    spark = df.sparkSession
    folder = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    there = spark.catalog.tableExists(name)
    if there:
        have = [(f.name, f.dataType) for f in spark.table(name).schema]
        if have != [(f.name, f.dataType) for f in df.schema] and not new_columns:
            raise SchemaChange(f"{name} has {spark.table(name).schema.simpleString()}, not {df.schema.simpleString()}")
    try:
        df.write.format(fmt).save(folder)
    except BaseException:
        removed(spark, folder)
        raise
    before = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()} if there else {}
    own = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()} if there else {}
    same = there and before.get("Provider", "").lower() == fmt and have == [(f.name, f.dataType) for f in df.schema]
    if same:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{_literal(folder)}'")
    else:
        if there:
            spark.sql(f"DROP TABLE {name}")  # its files stay, as the table has a location of its own
        columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt} LOCATION '{_literal(folder)}'")
    if there:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_BEFORE}' = '{_literal(before['Location'])}')")
        # Only what this has written is removed, and never what the table was moved from just now.
        old = own.get(_BEFORE)
        if old and old not in (before["Location"], folder):
            removed(spark, old)
    return folder


def _literal(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def create_view(df: DataFrame, name: str) -> None:
    """Register a query under a name; it is worked out when read."""
    df.createOrReplaceTempView(name)


def balanced(df: DataFrame, column: str) -> DataFrame:
    """Rows of one value near each other before a partitioned write, in files of even size.

    Adaptive execution splits a value that is too large for one task and joins small ones.
    """
    return df.hint("rebalance", F.col(column))

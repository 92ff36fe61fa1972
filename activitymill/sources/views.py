"""Views that outlast a session: SQL text in the catalog, created in the order in which they need each other.

A text names other views and tables in braces, as in ``SELECT * FROM {seen_types}``. With a metastore that is stored,
the views are there for every later session of any application; without one, for all sessions of this application.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from graphlib import TopologicalSorter
from string import Formatter

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession


def needs(text: str) -> set[str]:
    """What a text names in braces."""
    return {name for _, name, _, _ in Formatter().parse(text) if name}


def in_order(texts: Mapping[str, str]) -> list[str]:
    """Names of the texts, each after those it needs. Two that need each other raise ``graphlib.CycleError``."""
    given = {name: sorted(needs(text) & texts.keys()) for name, text in sorted(texts.items())}
    return list(TopologicalSorter(given).static_order())


def quoted(*parts: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def create_views(spark: SparkSession, database: str, texts: Mapping[str, str], known: Iterable[str] = ()) -> list[str]:
    """Create or replace a lasting view per text in ``database``, which is made if it is not there.

    Names in braces are other texts, or tables and views the database has already (``known``); any other name raises
    before anything is created. Each view changes in one step of the catalog, and what it is made of comes first, so a
    reader never meets a view that names what is not there.
    """
    missing = sorted({(name, n) for name, text in texts.items() for n in needs(text) - texts.keys() - {*known}})
    if missing:
        raise KeyError("; ".join(f"{name} needs {n}" for name, n in missing))
    order = in_order(texts)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
    for name in order:
        body = texts[name].format(**{n: quoted(database, n) for n in needs(texts[name])})
        spark.sql(f"CREATE OR REPLACE VIEW {quoted(database, name)} AS {body}")
    return order


def folder(spark: SparkSession, path: str, schema: str, where: str = "") -> str:
    """Text that reads Parquet below a folder under a schema, so that it is the same whatever the files say."""
    try:
        spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return nothing(schema)  # no file was written, as there was no row
    columns = ", ".join(f"CAST(`{name}` AS {kind}) AS `{name}`" for name, kind in (c.split(maxsplit=1) for c in schema.split(", ")))
    # Braces of the path stand for themselves.
    source = f"parquet.{quoted(path)}".replace("{", "{{").replace("}", "}}")
    return f"SELECT {columns} FROM {source}" + (f" WHERE {where}" if where else "")


def nothing(schema: str) -> str:
    """Text of a table without rows."""
    columns = ", ".join(f"CAST(NULL AS {kind}) AS `{name}`" for name, kind in (c.split(maxsplit=1) for c in schema.split(", ")))
    return f"SELECT {columns} WHERE FALSE"

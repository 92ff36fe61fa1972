"""Small tables written between steps of an operator, and the package's way to the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activitymill.plans.shared import shared_folder


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe when executors are lost."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or one like it that no column has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def bounded_sample(df: DataFrame, max_rows: int) -> DataFrame:
    """At most ``max_rows`` different rows, those with the smallest hash, in that order; all if there are fewer.

    Rows beyond twice the share that is wanted of the different rows are left out before any sort, so what tasks send
    does not grow with their number. Rows that are there many times count once.
    """
    place = F.xxhash64(*df.columns)
    different = df.agg(F.approx_count_distinct(place)).first()[0]
    share = min(1.0, 2 * max_rows / max(1, different))
    below = place <= int(-(1 << 63) + share * ((1 << 64) - 1) * (1 - 1e-9)) if share < 1 else F.lit(True)
    return df.filter(below).distinct().orderBy(place, *df.columns).limit(max_rows)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for clusters on which it is not installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    path = f"{tempfile.mkdtemp()}/{package.name}.zip"  # the driver serves it for as long as the application lives
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(path)
    _shipped.add(context.applicationId)

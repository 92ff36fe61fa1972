"""Hourly landing files: which are there, which are still needed, and reading them under the contract.

An hour is ``YYYY-MM-DD-H.json.gz`` with H from 0 to 23 and no leading zero. It is one file, or a folder of that
name holding parts. A gzip file is read by one task, so parts are what lets a very large hour spread.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activitymill.contract import BAD_LINE, MIN_HOUR_BYTES, RAW_SCHEMA
from activitymill.functions.time import date_key, parse_day

# Fixed value: the name of an hour inside a path.
HOUR_NAME = r"(\d{4}-\d{2}-\d{2})-(\d|1\d|2[0-3])\.json\.gz"
_IN_PATH = rf"(?:^|[/=]){HOUR_NAME}(?:/|$)"
_TO_HOUR = rf"^(.*?{HOUR_NAME})(?:/|$)"


def day_glob(landing_dir: str, day: str, prefix: str = "") -> str:
    """Path pattern of one day's hours, whose names may have a prefix; the day is 20240602 or 2024-06-02."""
    return f"{landing_dir.rstrip('/')}/{prefix}{parse_day(day).isoformat()}-*.json.gz"


def landed_day(path: Column) -> Column:
    """Day key in the name of an hour; null for a file of another name."""
    return date_key(_day_in(path))


def landed_hour(path: Column) -> Column:
    """Hour in the name of an hour; null for a file of another name."""
    return F.regexp_extract(path, _IN_PATH, 2).try_cast("int")


def hour_path() -> Column:
    """Plain path of the hour that a file being read belongs to."""
    return _plain(F.regexp_extract(F.col("_metadata.file_path"), _TO_HOUR, 1))


def _day_in(path: Column) -> Column:
    return F.regexp_extract(path, _IN_PATH, 1).try_cast("date")


def _plain(uri: Column) -> Column:
    """The hidden column holds the path as a URI."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def scan_events(spark: SparkSession, paths: str | Sequence[str], with_source: bool = False) -> DataFrame:
    """Raw records under the contract: undeclared fields are dropped, a line that does not parse is all null.

    ``with_source`` adds ``bad_line``, the text of any line that does not fit, and ``landed_day`` and ``landed_hour``,
    the day and the hour in the file name.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not with_source:
        return spark.read.schema(RAW_SCHEMA).json(paths)
    read = (
        spark.read.schema(f"{RAW_SCHEMA}, {BAD_LINE} STRING")
        .option("columnNameOfCorruptRecord", BAD_LINE)
        .json(paths)
    )
    # Spark only notices misfits in fields the query reads. This reads them all, so that a line is bad or not
    # whatever else is asked; the text is made for bad lines only, and is never empty.
    record = [c for c in read.columns if c != BAD_LINE]
    bad_line = F.when(F.col(BAD_LINE).isNotNull() & (F.to_json(F.struct(*record)) != ""), F.col(BAD_LINE))
    path = F.col("_metadata.file_path")
    return read.select(
        *record, bad_line.alias(BAD_LINE), landed_day(path).alias("landed_day"), landed_hour(path).alias("landed_hour")
    )


def hour_files(spark: SparkSession, landing_dir: str, first_day: str, last_day: str | None = None) -> DataFrame:
    """Files of the days' hours: day, hour, path, size and time. Only names and sizes are read, never content."""
    first, last = parse_day(first_day), parse_day(last_day or first_day)
    path = F.col("_metadata.file_path")
    # The months of these days, or the one day, so that a run does not list the files of years.
    months = {(first + timedelta(days=d)).isoformat()[:7] for d in range((last - first).days + 1)}
    begins = first.isoformat() if first == last else "{" + ",".join(sorted(months)) + "}"
    try:
        listed = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .load(f"{landing_dir.rstrip('/')}/*{begins}*.json.gz")
        )
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "day DATE, hour INT, path STRING, size BIGINT, modified TIMESTAMP")
    # Filters on the hidden file columns drop other days' files before any task is made for them.
    day = _day_in(path)
    return listed.filter(path.rlike(_IN_PATH) & day.between(F.lit(first), F.lit(last))).select(
        day.alias("day"),
        F.regexp_extract(path, _IN_PATH, 2).cast("int").alias("hour"),
        F.regexp_extract(path, _TO_HOUR, 1).alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def landed_hours(spark: SparkSession, landing_dir: str, first_day: str, last_day: str | None = None) -> DataFrame:
    """Hours present in the folder: day, hour, path, bytes, time of the last change, and at how many paths the hour
    is (one, normally)."""
    return (
        hour_files(spark, landing_dir, first_day, last_day)
        .groupBy("day", "hour")
        .agg(
            _plain(F.max("path")).alias("path"), F.sum("size").alias("bytes"), F.max("modified").alias("modified"),
            F.when(F.min("path") == F.max("path"), 1).otherwise(2).alias("paths"),
        )
    )


def expected_hours(spark: SparkSession, first_day: str, last_day: str | None = None) -> DataFrame:
    """All 24 hours of each day."""
    first, last = parse_day(first_day), parse_day(last_day or first_day)
    hours = spark.range(24 * ((last - first).days + 1))
    return hours.select(
        F.date_add(F.lit(first), F.floor(F.col("id") / 24).cast("int")).alias("day"),
        (F.col("id") % 24).cast("int").alias("hour"),
    )


def landing_manifest(
    spark: SparkSession,
    landing_dir: str,
    first_day: str,
    last_day: str | None = None,
    min_bytes: int = MIN_HOUR_BYTES,
) -> DataFrame:
    """Every expected hour with its file and status: ok, stub (below ``min_bytes``), missing, or ambiguous (landed
    under more than one path, of which none is to be preferred)."""
    status = (
        F.when(F.col("bytes").isNull(), "missing").when(F.col("paths") > 1, "ambiguous")
        .when(F.col("bytes") < min_bytes, "stub").otherwise("ok")
    )
    return (
        expected_hours(spark, first_day, last_day)
        .join(landed_hours(spark, landing_dir, first_day, last_day), ["day", "hour"], "left")
        .select("day", "hour", "path", "bytes", "modified", status.alias("status"))
    )


def hours_to_fetch(
    spark: SparkSession,
    landing_dir: str,
    first_day: str,
    last_day: str | None = None,
    min_bytes: int = MIN_HOUR_BYTES,
) -> DataFrame:
    """Hours still to be landed. One is skipped only when larger than ``min_bytes``, so landing twice is safe."""
    valid = landed_hours(spark, landing_dir, first_day, last_day).filter(F.col("bytes") > min_bytes)
    wanted = expected_hours(spark, first_day, last_day).join(valid, ["day", "hour"], "left_anti")
    name = F.concat(F.col("day").cast("string"), F.lit("-"), F.col("hour").cast("string"), F.lit(".json.gz"))
    return wanted.select("day", "hour", name.alias("file_name"))

"""A ledger of landed hours: what each hour held when it was parsed, and where its rows are kept since.

An hour that lands late, or again, is parsed by itself; the other hours of its day are read from the rows that were
kept. Hours of the size and time that the ledger has are taken as they are. Of any other the files are hashed: where
the hash is the ledger's, they were only copied or touched. With ``verify`` all are hashed, which also notices an hour
that was changed without another size or time.

Below the ledger's folder are ``hours/run=<run>`` with the rows, by landed day and hour, and ``entries/<number>`` with
all entries, 24 a day. Entries are written last, into a new folder, so a run that breaks off leaves the ledger as it
was. Rows of an hour that was replaced stay for one more run, for readers that have begun.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from activitymill.functions.time import day_key
from activitymill.sources.landing import hour_path
from activitymill.sources.state import listed, removed

ENTRY = "day DATE, hour INT, bytes BIGINT, modified TIMESTAMP, digest STRING, run STRING"
_KEY = ("day", "hour")


class Ledger:
    """The ledger below one folder. ``parse`` reads landed hours given by their paths and writes their rows to a
    folder, partitioned by ``landed_day`` and ``landed_hour``; ``schema`` is that of the rows without ``landed_hour``."""

    def __init__(self, spark: SparkSession, root: str, schema: str, parse: Callable[[list[str], str], object]):
        self.spark, self.root, self.schema, self.parse = spark, root.rstrip("/"), schema, parse

    def _numbers(self) -> list[int]:
        names = [n for n in listed(self.spark, f"{self.root}/entries") if n.isdigit()]
        return sorted(int(n) for n in names if "_SUCCESS" in listed(self.spark, f"{self.root}/entries/{n}"))

    def _entries(self, number: int | None) -> DataFrame:
        if number is None:
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).parquet(f"{self.root}/entries/{number}")

    def entries(self) -> DataFrame:
        """One row per hour that was parsed: day, hour, bytes, modified, digest and run."""
        return self._entries(max(self._numbers(), default=None))

    def compare(self, hours: Sequence[Row], verify: bool = False) -> list[Row]:
        """Landed hours (rows of the manifest) with their digest, run and status: new, changed, or same.

        A new or changed hour has no run yet.
        """
        days = sorted({h.day for h in hours})
        known = {(r.day, r.hour): r for r in self.entries().filter(F.col("day").isin(days)).collect()} if days else {}

        def untouched(h: Row) -> bool:
            old = known.get((h.day, h.hour))
            return not verify and old is not None and (old.bytes, old.modified) == (h.bytes, h.modified)

        read = digests(self.spark, [h.path for h in hours if not untouched(h)])
        found = []
        for h in hours:
            old = known.get((h.day, h.hour))
            digest = old.digest if untouched(h) else read[h.path]
            status = "new" if old is None else "same" if old.digest == digest else "changed"
            found.append(Row(
                day=h.day, hour=h.hour, path=h.path, bytes=h.bytes, modified=h.modified, digest=digest,
                run=old.run if status == "same" else None, status=status,
            ))
        return found

    def update(self, hours: Sequence[Row], verify: bool = False) -> list[Row]:
        """Parse the hours that are new or changed, and return all as ``compare`` does, each with its run."""
        compared, run = self.compare(hours, verify), uuid.uuid4().hex
        paths = [h.path for h in compared if h.status != "same"]
        if paths:
            self.parse(paths, f"{self.root}/hours/run={run}")
        after = [Row(**h.asDict() | {"run": h.run or run}) for h in compared]
        touched = [h for h in after if h.status == "same"]
        if paths or self._stale(touched):
            self._write(after)
        return after

    def _stale(self, same: Sequence[Row]) -> bool:
        """Whether entries of equal hours have another size or time than is listed now."""
        if not same:
            return False
        found = self.spark.createDataFrame([tuple(h[c] for c in ("day", "hour", "bytes", "modified")) for h in same],
                                           "day DATE, hour INT, bytes BIGINT, modified TIMESTAMP")
        return not found.join(self.entries(), found.columns, "left_anti").isEmpty()

    def _write(self, hours: Sequence[Row]) -> None:
        names = [part.split()[0] for part in ENTRY.split(", ")]
        new = self.spark.createDataFrame([tuple(h[c] for c in names) for h in hours], ENTRY)
        numbers = self._numbers()
        before, last = ([None, None] + numbers)[-2:]
        kept = self._entries(last).join(new, list(_KEY), "left_anti")
        number = (last or 0) + 1
        kept.unionByName(new).coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/entries/{number}")
        # What the run before replaced is read by nobody now.
        used = [*_KEY, "run"]
        gone = self._entries(before).join(self._entries(last), used, "left_anti").join(self._entries(number), used, "left_anti")
        for h in gone.select(*used).collect():  # hours that one run replaced
            removed(self.spark, f"{self.root}/hours/run={h.run}/landed_day={day_key(h.day)}/landed_hour={h.hour}")
        for old in numbers[:-1]:
            removed(self.spark, f"{self.root}/entries/{old}")

    def rows(self, hours: Sequence[Row]) -> DataFrame:
        """The rows of hours that ``update`` returned, with ``landed_hour``. Other hours' files are not listed as tasks."""
        schema = f"{self.schema}, landed_hour INT"
        runs: dict[str, list[int]] = {}
        for h in hours:
            runs.setdefault(h.run, []).append(day_key(h.day) * 100 + h.hour)
        if not runs:
            return self.spark.createDataFrame([], schema)
        read = self.spark.read.schema(f"{schema}, run STRING").option("basePath", f"{self.root}/hours")
        held = F.lit(False)
        for run, own in runs.items():
            held = held | ((F.col("run") == run) & (F.col("landed_day") * 100 + F.col("landed_hour")).isin(own))
        return read.parquet(*[f"{self.root}/hours/run={run}" for run in runs]).filter(held).drop("run")


def digests(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """SHA-256 per hour, whatever its path; of an hour in parts, that of the parts' sorted hashes.

    One file is hashed by one task, which holds it: parts have to be below 2 GB.
    """
    if not paths:
        return {}
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    hashed = files.select(hour_path().alias("path"), F.sha2("content", 256).alias("part"))
    parts = F.sort_array(F.collect_list("part"))
    one = F.when(F.size(parts) == 1, F.element_at(parts, 1)).otherwise(F.sha2(F.concat_ws(",", parts), 256))
    return {r.path: r.digest for r in hashed.groupBy("path").agg(one.alias("digest")).collect()}  # a row per hour

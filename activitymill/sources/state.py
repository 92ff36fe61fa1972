"""The one small file that says which runs' folders make up a warehouse.

States are numbered. A new one is written beside the others and renamed into place, which either happens or does not;
the greatest number holds. Two runs at a time would rename to the same number, and the second fails.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import SparkSession


class ConcurrentRun(Exception):
    """Another run has published meanwhile."""


@dataclass
class State:
    number: int = 0
    days: dict[str, str] = field(default_factory=dict)  # landed day to the run that holds it
    hours: dict[str, int] = field(default_factory=dict)  # landed day to the hours that were loaded
    merged: str | None = None  # the run that holds dimensions and merged sightings
    marts: str | None = None  # the run that holds stored marts, if they are stored

    def runs(self) -> set[str]:
        return {*self.days.values(), *filter(None, (self.merged, self.marts))}


def _file_system(spark: SparkSession, path: str) -> tuple[Any, Any]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder; none if it is not there."""
    files, where = _file_system(spark, path)
    return [f.getPath().getName() for f in files.listStatus(where)] if files.exists(where) else []


def removed(spark: SparkSession, path: str) -> None:
    files, where = _file_system(spark, path)
    files.delete(where, True)


def read_state(spark: SparkSession, root: str) -> State:
    numbers = [int(n.removesuffix(".json")) for n in listed(spark, f"{root}/_state") if n.endswith(".json")]
    if not numbers:
        return State()
    text = spark.read.text(f"{root}/_state/{max(numbers)}.json", wholetext=True).first()
    return State(**json.loads(text.value))


def write_state(spark: SparkSession, root: str, state: State) -> None:
    target = f"{root}/_state/{state.number}.json"
    files, final = _file_system(spark, target)
    _, draft = _file_system(spark, f"{target}.draft")
    out = files.create(draft, True)
    out.write(bytearray(json.dumps(asdict(state)).encode()))
    out.close()
    if files.exists(final) or not files.rename(draft, final):
        files.delete(draft, False)
        raise ConcurrentRun(f"state {state.number} of {root} was written by another run")
    for name in listed(spark, f"{root}/_state"):
        if name.endswith(".json") and int(name.removesuffix(".json")) < state.number - 1:
            removed(spark, f"{root}/_state/{name}")

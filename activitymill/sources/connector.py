"""A connector in Python, under the format name ``parts``: a store that takes all rows of a write, or none.

Each task writes its rows to a Parquet file of its own in a folder of the write and reports it in a message. When all
have, the files in the messages become the table by one small list, renamed into place on the driver; lists are
numbered, and the greatest number holds. If a task fails for good, the folder of the write goes. A file of an attempt
that was lost or doubled is in no message, so it is in no list.

It stands for an external store: ``write_table`` and ``daily.export`` reach it by ``format`` and ``options`` alone.
Paths are those that PyArrow reaches (local, HDFS, S3, GCS).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage,
)
from pyspark.sql.types import StructType

_LISTS = "_lists"


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    rows: int


@dataclass
class File(InputPartition):
    path: str


def _store(path: str) -> tuple[fs.FileSystem, str]:
    files, root = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return files, root.rstrip("/")


def _numbers(files: fs.FileSystem, root: str) -> list[int]:
    found = files.get_file_info(fs.FileSelector(f"{root}/{_LISTS}", allow_not_found=True))
    return sorted(int(f.base_name.removesuffix(".json")) for f in found if f.base_name.endswith(".json"))


def _read_list(files: fs.FileSystem, root: str) -> dict | None:
    numbers = _numbers(files, root)
    if not numbers:
        return None
    with files.open_input_stream(f"{root}/{_LISTS}/{numbers[-1]}.json") as f:
        return json.loads(f.read())


class PartsSource(DataSource):
    """Options: ``path``."""

    @classmethod
    def name(cls) -> str:
        return "parts"

    def _path(self) -> str:
        if not self.options.get("path"):
            raise ValueError("the format parts needs a path")
        return self.options["path"]

    def schema(self) -> StructType:
        found = _read_list(*_store(self._path()))
        if found is None:
            raise FileNotFoundError(f"nothing was written to {self._path()}")
        return StructType.fromJson(found["schema"])

    def reader(self, schema: StructType) -> PartsReader:
        return PartsReader(self._path(), schema)

    def writer(self, schema: StructType, overwrite: bool) -> PartsWriter:
        return PartsWriter(self._path(), schema, overwrite)


class PartsWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, overwrite: bool):
        self.path, self.schema, self.overwrite = path, schema, overwrite
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = _store(self.path)
        task = TaskContext.get()
        file = f"{self.job}/{task.partitionId():06d}-{task.taskAttemptId()}.parquet"
        writer, rows = None, 0
        try:
            for batch in iterator:
                if writer is None:
                    files.create_dir(f"{root}/{self.job}", recursive=True)
                    writer = pq.ParquetWriter(f"{root}/{file}", batch.schema, filesystem=files)
                writer.write_batch(batch)
                rows += batch.num_rows
        except BaseException:
            if writer is not None:
                writer.close()
                files.delete_file(f"{root}/{file}")
            raise
        if writer is None:
            return Written(None, 0)
        writer.close()
        return Written(file, rows)

    def commit(self, messages: list[Written | None]) -> None:
        """One list makes the files the table; it is renamed into place, so a reader meets the old or the new one."""
        files, root = _store(self.path)
        before = _read_list(files, root)
        kept = [] if self.overwrite or before is None else before["files"]
        if kept and before["schema"] != self.schema.jsonValue():
            raise ValueError("rows of another schema cannot be added")
        new = sorted(m.file for m in messages if m is not None and m.file)
        content = {"schema": self.schema.jsonValue(), "files": kept + new,
                   "rows": sum(m.rows for m in messages if m is not None) + (before["rows"] if kept else 0)}
        files.create_dir(f"{root}/{_LISTS}", recursive=True)
        number = (_numbers(files, root) or [0])[-1] + 1
        draft, final = f"{root}/{_LISTS}/{self.job}.draft", f"{root}/{_LISTS}/{number}.json"
        with files.open_output_stream(draft) as out:
            out.write(json.dumps(content).encode())
        files.move(draft, final)
        self._sweep(files, root, number, {*content["files"], *(before["files"] if before else [])})

    def _sweep(self, files: fs.FileSystem, root: str, number: int, held: set[str]) -> None:
        """Of what earlier lists named, only files of this list and of the one before it stay."""
        for old in _numbers(files, root):
            if old >= number - 1:
                continue
            name = f"{root}/{_LISTS}/{old}.json"
            with files.open_input_stream(name) as f:
                gone = [x for x in json.loads(f.read())["files"] if x not in held]
            for file in gone:
                if files.get_file_info(f"{root}/{file}").type != fs.FileType.NotFound:
                    files.delete_file(f"{root}/{file}")
            files.delete_file(name)

    def abort(self, messages: list[Written | None]) -> None:
        files, root = _store(self.path)
        if files.get_file_info(f"{root}/{self.job}").type != fs.FileType.NotFound:
            files.delete_dir(f"{root}/{self.job}")


class PartsReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.schema = path, schema

    def partitions(self) -> list[File]:
        found = _read_list(*_store(self.path))
        return [File(f) for f in found["files"]] if found else []

    def read(self, partition: File | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark asks once where there are no partitions
            return
        files, root = _store(self.path)
        with files.open_input_file(f"{root}/{partition.path}") as f:
            yield from pq.ParquetFile(f).iter_batches(columns=self.schema.names)


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    spark.dataSource.register(PartsSource)

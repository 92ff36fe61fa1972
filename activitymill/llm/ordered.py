"""Places of rows within their group, without bringing a group into one task.

Rows are sorted over ranges of (group, order), so a group with a third of all rows covers a third of the tasks. Only a
task's first group can go on from the task before, so one number per task is all that has to be carried over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activitymill.llm.work import kept

RANGE_CHARS = 32


def numbered(df: DataFrame, key: str, order: list[str], columns: dict[str, Column]) -> DataFrame:
    """``key``, ``columns`` and ``pos``, the place (from 0) of each row among those of its ``key`` (a long) in the
    ``order``, nulls first. Rows that are alike in key and order may change places. Null keys are a group.

    Ranges are cut by the first characters of texts, so long texts never reach the driver with Spark's sample of them.
    """
    spark = df.sparkSession
    kinds = dict(df.dtypes)
    cuts = [F.substring(c, 1, RANGE_CHARS) if kinds[c] == "string" else F.col(c) for c in order]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, F.asc_nulls_first(key), *(c.asc_nulls_first() for c in cuts))
    placed = placed.sortWithinPartitions(*(F.asc_nulls_first(c) for c in (key, *order)))
    placed = placed.select(key, *(c.alias(name) for name, c in columns.items()))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), (), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(0)
            null = column.is_null().to_numpy(zero_copy_only=False)
            ids = pc.fill_null(column, 0).to_numpy(zero_copy_only=False)
            fresh = np.ones(len(ids), bool)
            fresh[1:] = (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])
            starts = np.flatnonzero(fresh)
            at = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
            if last == (ids[0], null[0]):
                at[:starts[1] if len(starts) > 1 else len(ids)] += seen
            last, seen = (ids[-1], null[-1]), int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(at), pa.array(np.full(len(ids), part, np.int32))],
                [*batch.schema.names, "_at", "_part"],
            )

    schema = ", ".join(f"`{c}` {t}" for c, t in placed.dtypes)
    rows = kept(placed.mapInArrow(number, f"{schema}, _at long, _part int"), "numbered")
    # One row per task, at most as many as shuffle partitions.
    edges = rows.groupBy("_part").agg(F.min(F.struct(key)).alias("first"), F.max(F.struct(key, "_at")).alias("last"))
    carry, last, moved = 0, (), []
    for edge in sorted(edges.collect()):
        carry = carry if last == (edge.first[0],) else 0
        if carry:
            moved.append((edge._part, edge.first[0], carry))
        carry = edge.last[1] + 1 + (carry if edge.first[0] == edge.last[0] else 0)
        last = (edge.last[0],)
    moved = spark.createDataFrame(moved, "_p int, _k long, _before long")
    joined = rows.join(F.broadcast(moved), (F.col("_part") == F.col("_p")) & F.col(key).eqNullSafe(F.col("_k")), "left")
    return joined.select(key, *columns, (F.col("_at") + F.coalesce("_before", F.lit(0))).alias("pos"))

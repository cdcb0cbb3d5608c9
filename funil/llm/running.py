"""Running totals over sorted rows, without sorting a key or all rows in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from funil.settings import write_once


def running_totals(rows: DataFrame, key: str, order: list[str], amount: str, name: str = "_before") -> DataFrame:
    """``rows`` with ``name``: the sum of ``amount`` over all rows of the same key that come before in ``order``.

    ``key`` holds strings and no null, ``amount`` whole numbers and no null.  Rows that tie in
    ``order`` come in any order, which is fixed when the rows are written.  Besides,
    ``_part`` and ``_place`` number the rows: together they are unique.

    Rows are range-partitioned by key and order, so a key with very many rows is spread.
    Each task adds up its own range; only its totals per key are put together, of which
    there are as many as ranges and keys.
    """

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, last, total = TaskContext.get().partitionId(), 0, None, 0
        for batch in given:
            n = batch.num_rows
            if not n:
                continue
            keys, amounts = batch.column(key), batch.column(amount).to_numpy()
            ends = np.cumsum(amounts)
            before = ends - amounts
            head = np.ones(n, bool)
            head[1:] = pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(head)
            first = before[starts]
            if keys[0].as_py() == last:  # the key goes on from the batch before
                first[0] -= total
            before = before - np.repeat(first, np.diff(np.append(starts, n)))
            last, total = keys[n - 1].as_py(), int(before[-1] + amounts[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part)), pa.array(np.arange(place, place + n)), pa.array(before)],
                [*batch.schema.names, "_part", "_place", "_within"],
            )
            place += n

    schema = StructType(rows.schema.fields).add("_part", "long").add("_place", "long").add("_within", "long")
    placed = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order).mapInArrow(run, schema)
    placed = write_once(placed, "running")
    sums = placed.groupBy("_part", key).agg(F.sum(amount).alias("_sum"))
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("_part", key, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    joined = placed.join(bases, ["_part", key])
    return joined.withColumn(name, F.col("_base") + F.col("_within")).select(*rows.columns, "_part", "_place", name)

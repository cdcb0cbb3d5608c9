"""Dense ids in a stated order, without sorting in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from funil.settings import write_once


def assign_ids(rows: DataFrame, order: list[str], after: Column | int = 0, name: str = "id") -> DataFrame:
    """Number ``rows`` as ``after + 1, after + 2, ...`` in ``order``, which must be unique.

    Rows are range-partitioned and sorted; each one's number is its place in its
    partition plus the sizes of the partitions before.  Partition numbers are only
    stable for one run of the shuffle, so the placed rows are written first.
    """
    placed = write_once(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "placed",
    )
    # One row per partition: a single-task window over it stays small.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    after = F.lit(after) if isinstance(after, int) else after
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, (after + F.col("_offset") + F.col("_place") + 1).cast("bigint"))
        .drop("_part", "_place", "_offset")
    )


def last_id(df: DataFrame) -> Column:
    """The highest id of a table (0 when empty) as a scalar subquery."""
    return df.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()

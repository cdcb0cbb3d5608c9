"""Hot keys, and a per-key top-N that never gathers a hot key in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from funil.settings import write_once

# Keys above 1/HOT_PARTS of all rows are hot, so there are fewer than HOT_PARTS of
# them: the list may be broadcast whatever the size of the table.
HOT_PARTS = 100_000
# A key of fewer rows is not worth treating apart.
HOT_FLOOR = 1_000_000
# Slices a hot key is spread over.
SLICES = 256


def hot_keys(df: DataFrame, key: str, parts: int = HOT_PARTS, floor: int = HOT_FLOOR) -> DataFrame:
    """Keys with more than ``floor`` and more than 1/``parts`` of the rows; reads one column."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    share = counts.agg((F.coalesce(F.sum("_rows"), F.lit(0)) / parts).alias("share")).scalar()
    return counts.filter((F.col("_rows") > floor) & (F.col("_rows") > share)).select(key)


def first_per_key(
    df: DataFrame,
    key: str,
    order: list[Column],
    n: int,
    parts: int = HOT_PARTS,
    floor: int = HOT_FLOOR,
    slices: int = SLICES,
    census: DataFrame | None = None,
) -> DataFrame:
    """The first ``n`` rows of each key in ``order`` (a total order within the key).

    Hot keys are looked for once, in ``census`` if ``df`` is a costly part of it.
    Without any, which is usual, this is one window: every task sends ``n`` rows of a
    key at most.  A hot key is first cut to ``n`` rows within each slice, so that
    at most ``n * slices`` of its rows meet, however many tasks have some.
    """
    def cut(rows, *by):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        return rows.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")

    found = write_once(hot_keys(df if census is None else census, key, parts, floor), "hot")
    if found.isEmpty():
        return cut(df, key)
    hot = F.broadcast(found)  # fewer than ``parts`` rows
    sliced = df.join(hot, key, "left_semi").withColumn(
        "_slice", F.pmod(F.xxhash64(*df.columns), F.lit(slices))
    )
    ordinary = cut(df.join(hot, key, "left_anti"), key)
    return ordinary.unionByName(cut(cut(sliced, key, "_slice").drop("_slice"), key))

"""Row counts of the four tables, in the shapes reports and manifests use."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from funil.tables import SalesTables


def count_rows(tables: SalesTables) -> DataFrame:
    """One row per table."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        for name, df in tables.by_name().items()
    ])


def _count_of(name: str) -> Column:
    return F.max(F.when(F.col("table_name") == name, F.col("n_rows")))


def _counts(tables: SalesTables) -> DataFrame:
    return count_rows(tables).agg(*[_count_of(name).alias(name) for name in tables.by_name()])


def count_columns(tables: SalesTables, prefix: str = "") -> DataFrame:
    """One row with a column per table."""
    return _counts(tables).select([F.col(name).alias(prefix + name) for name in tables.by_name()])


def count_manifest(tables: SalesTables) -> DataFrame:
    """The counts as one JSON object."""
    return _counts(tables).select(F.to_json(F.struct(*tables.by_name())).alias("manifest"))


def count_text(tables: SalesTables) -> DataFrame:
    """The counts as one line, such as ``5 provedores, 25 planos, 20 leads, 45 mensagens``."""
    parts = []
    for name in tables.by_name():
        parts += [F.lit(", " if parts else ""), F.col(name).cast("string"), F.lit(f" {name}")]
    return _counts(tables).select(F.concat(*parts).alias("summary"))


def count_difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """Counts before and after a restore, side by side."""
    old = before.select("table_name", F.col("n_rows").alias("rows_before"))
    new = after.select("table_name", F.col("n_rows").alias("rows_after"))
    return old.join(new, "table_name", "full").withColumn(
        "difference", F.coalesce("rows_after", F.lit(0)) - F.coalesce("rows_before", F.lit(0))
    )

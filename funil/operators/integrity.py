"""Constraints as violation reports: no rows means the tables are sound.

Every report groups or counts before it shuffles, so one very frequent value
costs one row per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DataType

from funil import schema as S, values as V
from funil.functions import config
from funil.tables import SalesTables


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def duplicate_keys(df: DataFrame, table: str) -> DataFrame:
    """Ids that are NULL or occur more than once."""
    return (
        df.groupBy("id")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter("n_rows > 1 OR id IS NULL")
        .select(F.lit(table).alias("table_name"), "id", "n_rows")
    )


def primary_keys(tables: SalesTables) -> DataFrame:
    return _union([duplicate_keys(df, name) for name, df in tables.by_name().items()])


def null_counts(df: DataFrame, table: str) -> DataFrame:
    """NULLs in each required column, for columns that have some; one pass."""
    required = [c for c in S.required_columns(table) if c in df.columns]
    return (
        df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
        .unpivot([], required, "column_name", "n_nulls")
        .filter("n_nulls > 0")
        .select(F.lit(table).alias("table_name"), "column_name", "n_nulls")
    )


def not_null(tables: SalesTables) -> DataFrame:
    return _union([null_counts(df, name) for name, df in tables.by_name().items()])


def orphans(child: DataFrame, key: str, parent: DataFrame, child_name: str) -> DataFrame:
    """Foreign-key values without a parent, and how many rows hold each."""
    return (
        child.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .join(parent.select(F.col("id").alias(key)), key, "left_anti")
        .select(
            F.lit(child_name).alias("table_name"), F.lit(key).alias("key_name"),
            F.col(key).alias("key_value"), "n_rows",
        )
    )


def foreign_keys(tables: SalesTables) -> DataFrame:
    by_name = tables.by_name()
    return _union([
        orphans(by_name[child], key, by_name[parent], child) for child, key, parent in S.FOREIGN_KEYS
    ])


def lost_casts(df: DataFrame, column: str, to: DataType = S.PRICE) -> DataFrame:
    """One row: texts that are given, and those the target type cannot hold."""
    cast = F.col(column).try_cast(to)
    return df.agg(
        F.count(column).alias("n_values"),
        F.count_if(F.col(column).isNotNull() & cast.isNull()).alias("n_lost"),
    )


def shared_contacts(leads: DataFrame) -> DataFrame:
    """Contacts with several leads at one provider; an upsert would change the lowest id."""
    return (
        leads.filter("remotejid IS NOT NULL AND provedor_id IS NOT NULL")
        .groupBy("remotejid", "provedor_id")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.min("id").alias("updated_id"))
        .filter("n_rows > 1")
    )


def config_problems(providers: DataFrame, expected=V.CONFIG_KEYS) -> DataFrame:
    """Providers whose settings are malformed, repeat a key, or lack an expected one."""
    text = F.col("config_bot")
    return providers.select(
        "id",
        config.malformed(text).alias("malformed"),
        F.coalesce(config.has_duplicate_keys(text), F.lit(False)).alias("repeats_key"),
        F.array_join(config.missing_keys(text, expected), ",").alias("missing"),
    ).filter("malformed OR repeats_key OR missing <> ''")


class IntegrityError(ValueError):
    """Tables that break a constraint."""


def _require_empty(reports: dict[str, DataFrame]) -> None:
    broken = [name for name, report in reports.items() if not report.isEmpty()]
    if broken:
        raise IntegrityError("violated: " + ", ".join(broken))


def require_sound(tables: SalesTables) -> None:
    """Raise unless keys and references hold; a load counts required columns and looks at types while it writes."""
    _require_empty({
        "primary key": primary_keys(tables),
        "foreign key": foreign_keys(tables),
    })


def require_types(df: DataFrame, table: str) -> None:
    """Raise unless a table has exactly its declared columns and types."""
    declared = {f.name: f.dataType for f in S.SCHEMAS[table]}
    given = {f.name: f.dataType for f in df.schema}
    wrong = [
        f"{table}.{name} is {given[name].simpleString() if name in given else 'missing'}, not {kind.simpleString()}"
        for name, kind in declared.items() if given.get(name) != kind
    ] + [f"{table}.{name} is not declared" for name in given if name not in declared]
    if wrong:
        raise IntegrityError("violated: column type: " + "; ".join(wrong))


def require_intact(providers: DataFrame) -> None:
    """Raise if a provider's settings are not a JSON object."""
    _require_empty({"settings": config_problems(providers).filter("malformed")})

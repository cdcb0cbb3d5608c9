"""Fields of the JSON settings column, as Column expressions.

``fields`` parses the text once for any number of keys and, like a binary JSON
type, keeps the last of duplicate keys.  Numbers are compared after a cast.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType, StructField, StructType


def fields(config: Column, *keys: str) -> Column:
    """A struct with the text of each key; NULL where a key is absent or JSON null."""
    return F.from_json(config, StructType([StructField(key, StringType()) for key in keys]))


def text(config: Column, key: str) -> Column:
    return fields(config, key)[key]


def has_key(config: Column, key: str) -> Column:
    """True when the key is present, also with a JSON null as its value."""
    return F.array_contains(F.json_object_keys(config), key)


def integer(value: Column) -> Column:
    """Text as an integer; bad text is an error (ANSI mode)."""
    return value.cast("int")


def number(value: Column, precision: int = 10, scale: int = 4) -> Column:
    """Text as a decimal of stated precision; a bare ``decimal`` would drop the fraction."""
    return value.cast(f"decimal({precision},{scale})")


def dirty_integer(value: Column) -> Column:
    return value.try_cast("int")


def dirty_number(value: Column, precision: int = 10, scale: int = 4) -> Column:
    return value.try_cast(f"decimal({precision},{scale})")


def malformed(config: Column) -> Column:
    """True for text that is not a JSON object; false for NULL."""
    return config.isNotNull() & F.json_object_keys(config).isNull()


def missing_keys(config: Column, expected) -> Column:
    return F.array_except(F.array(*[F.lit(key) for key in expected]), F.json_object_keys(config))


def has_duplicate_keys(config: Column) -> Column:
    keys = F.json_object_keys(config)
    return F.size(keys) != F.size(F.array_distinct(keys))

"""Small Column expressions shared by the plans."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, SparkSession, functions as F

from funil import values as V


def tagged(tags: Column, tag: str) -> Column:
    """Membership with SQL's three values: NULL array, or no match beside a NULL, is NULL."""
    return F.array_contains(tags, tag)


def sender(is_bot: Column) -> Column:
    return F.when(is_bot, V.SENDER_ASSISTANT).otherwise(V.SENDER_LEAD)


def chat_role(is_bot: Column) -> Column:
    return F.when(is_bot, V.ROLE_ASSISTANT).otherwise(V.ROLE_USER)


def moment(value: datetime | Column | None = None) -> Column:
    """A zone-free timestamp; the time of this call in the session's zone when none is given.

    A fixed value, so that all results of one change carry the same time.
    """
    if value is None:
        value = SparkSession.active().sql("SELECT localtimestamp()").first()[0]
    if isinstance(value, Column):
        return value
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def shift(ts: Column, *steps: timedelta) -> Column:
    """A timestamp moved by a sum of intervals, such as two hours back and 30 s on."""
    for step in steps:
        ts = ts + F.lit(step)
    return ts


def random_key() -> Column:
    """64 hex digits per row; synthetic, not for cryptography, and new on each run."""
    return F.sha2(F.uuid().cast("string"), 256)

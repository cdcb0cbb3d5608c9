"""Exact duplicates: groups by a 128-bit content hash, confirmed by comparing the bytes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from funil.settings import write_once


def content_hash(text: Column) -> Column:
    """128 bits of the text's UTF-8 bytes."""
    return F.unhex(F.md5(text))


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    digest: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Rows belong together when their texts have the same bytes.  The row with the
    smallest id stays, or with the largest for ``keep="largest"``.

    * A null text counts as empty, so null and empty texts are one group.
    * A null id never becomes ``keep_id`` while the group has another id.  In a group
      with null ids only, ``keep_id`` is null and the rows are kept.
    * Rows repeated under one id are the same document: each counts in
      ``group_size`` and all are marked alike.
    * Other columns are ignored, whatever their names.  No rows give no rows.

    Hashes and ids are written once, without texts.  Texts are read again only for
    hashes that occur more than once; equal texts collapse within each task before
    they are shuffled, so a group of any size is one row per task.  A hash whose
    texts differ (a collision) is matched by the whole text instead.
    """
    best = {"smallest": F.min, "largest": F.max}[keep]
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).alias("_id"), text.alias("_text")).withColumn("_hash", digest(F.col("_text")))
    rows = write_once(source.select("_id", "_hash", F.unhex(F.sha2("_text", 256)).alias("_sha")), "hashes")
    repeated = write_once(
        rows.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_hash"), "repeated"
    )
    # The hash finds the groups; grouping by the text as well compares the bytes.
    groups = (
        source.join(repeated, "_hash", "left_semi")
        .groupBy("_hash", "_text")
        .agg(best("_id").alias("_keep"), F.count(F.lit(1)).alias("_size"))
    )
    texts_of_hash = groups.groupBy("_hash").agg(F.count(F.lit(1)).alias("_texts"))
    collided = write_once(texts_of_hash.where("_texts > 1").select("_hash"), "collided")
    known = rows.join(
        write_once(groups.drop("_text"), "groups").join(collided, "_hash", "left_anti"), "_hash", "left"
    )
    if not collided.isEmpty():
        apart = source.join(collided, "_hash", "left_semi")
        exact = groups.join(collided, "_hash", "left_semi").drop("_hash")
        known = known.join(collided, "_hash", "left_anti").unionByName(
            apart.join(exact, "_text").withColumn("_sha", F.unhex(F.sha2("_text", 256))).drop("_text")
        )
    keep_id = F.when(F.col("_size").isNull(), F.col("_id")).otherwise(F.col("_keep"))
    return known.select(
        F.col("_id").alias(id_col),
        keep_id.alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(keep_id).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )

"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and
read again as the next stage's ``docs``.  All stages but the last return the columns
of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from funil.llm.jaccard_join import TOLD, similar_groups
from funil.llm.line_dedup import drop_boilerplate
from funil.llm.packing import pack
from funil.llm.pii import mask_documents
from funil.llm.quality import accepted
from funil.settings import discard, write_once


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers among their language and source."""
    return accepted(docs)


def _row_key() -> Column:
    """What tells rows apart: the id and the text, so that a text under a repeated id is a document of its own."""
    text = F.coalesce(F.concat(F.lit("="), F.md5(F.col("text").cast("binary"))), F.lit(""))
    return F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text)


def _groups(docs: DataFrame) -> DataFrame:
    """(``key``, ``id``, ``group``) of every row, where rows whose texts are similar, directly or through others, are a group."""
    rows = docs.select(_row_key().alias("key"), "text")
    found = similar_groups(rows, id_col="key").select("key", F.col("component_id").alias("group"))
    ids = F.split("key", "=")[0].try_cast("long")
    return write_once(found.select("key", ids.alias("id"), "group"), "groups")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that more than a tenth of their source's documents have.

    Similar documents of a source count as one, so what only copies share is no
    boilerplate; all other repeated lines go, however much of a document they are.  No
    document is dropped.
    """
    columns = {c: f"_doc{k}" for k, c in enumerate(docs.columns)}
    # A group of one is its own page without being named.
    groups = _groups(docs).select("key", "group").distinct()
    shared = groups.groupBy("group").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("group")
    copies = write_once(groups.join(shared, "group", "left_semi").select("key", F.col("group").alias("page")), "copies")
    pages = docs.select(_row_key().alias("key"), *[F.col(f"`{c}`").alias(own) for c, own in columns.items()])
    text, length = columns["text"], columns["n_chars"]
    shorter = drop_boilerplate(pages, columns["source"], text, max_ratio=0.1, page_col="key", joint=copies)
    n_chars = F.when(F.col("n_dropped") > 0, F.length(text).cast("long")).otherwise(F.col(length))
    return shorter.select(*[(n_chars if c == "n_chars" else F.col(own)).alias(c) for c, own in columns.items()])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of similar documents: the one with the smallest id, one without id last.

    Rows are told apart by id and text: under a repeated id, each text is judged for itself, and of rows
    equal in both one stays.  A text without words is similar to none.
    """
    groups = _groups(docs)
    first = F.min(F.struct(F.col("id").isNull(), "id", "key"))["key"].alias("key")
    kept = groups.groupBy("group").agg(first).select("key")
    gone = write_once(groups.select("key").join(kept, "key", "left_anti").distinct(), "gone")
    repeated = write_once(groups.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("key"), "repeated")
    discard(groups)
    rows = docs.select(_row_key().alias("key"), *[F.col(f"`{c}`").alias(f"_doc{k}") for k, c in enumerate(docs.columns)])
    few = gone.limit(TOLD + 1).count() <= TOLD  # texts stay where they are while the keys that go can be told to all tasks
    rows = rows.join(F.broadcast(gone) if few else gone, "key", "left_anti")
    if not repeated.isEmpty():  # of the few rows whose key is repeated, one each
        once = rows.join(repeated, "key", "left_semi").dropDuplicates(["key"])
        rows = rows.join(repeated, "key", "left_anti").unionByName(once)
    return rows.select(*[F.col(f"_doc{k}").alias(c) for k, c in enumerate(docs.columns)])


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return mask_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2,048 tokens, mixed by source."""
    pieces = pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mask_personal_data", mask_personal_data),
    ("packing", packing),
]

# Covariance determinants, trees and tokenizers are not SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_once(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

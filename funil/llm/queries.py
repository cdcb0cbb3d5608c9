"""The operators as named queries over a folder of input tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from funil.llm import merkle
from funil.llm.exact_dedup import exact_groups
from funil.llm.jaccard_join import similar_groups
from funil.llm.license_scan import document_licences
from funil.llm.line_dedup import drop_boilerplate, host_of, page_text
from funil.llm.mixing import mix
from funil.llm.packing import pack
from funil.llm.piece_codec import encode_decode
from funil.llm.pii import KINDS, find_personal_data
from funil.llm.quality import quality_rules
from funil.llm.sharding import shard_rows
from funil.llm.token_files import read_files, write_files
from funil.llm.whitening import whiten
from funil.settings import new_folder, write_once

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a function of (session, folder) under its name."""
    QUERIES[run.__name__] = run
    return run


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


@query
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(documents(spark, folder), keep="largest")


@query
def op2_ring_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_rows(documents(spark, folder), shards=8).withColumns(
        {"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")}
    )


@query
def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return similar_groups(documents(spark, folder))


@query
def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    coded = encode_decode(documents(spark, folder), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return document_licences(documents(spark, folder))


@query
def op6_mixture_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = pack(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet").select(
        "page_id", host_of(F.col("url")).alias("host"), page_text(F.col("html")).alias("text")
    )
    return drop_boilerplate(write_once(pages, "pages"), "host")  # read twice, taken out of the HTML once


@query
def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    index = write_files(
        documents(spark, folder), new_folder(spark, "token_files"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return read_files(index).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = find_personal_data(documents(spark, folder))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind, plain):
        return F.size(F.filter("spans", lambda s: (s["kind"] == kind) & (s["plain"] | F.lit(not plain)))).cast("long")

    return found.select(
        "doc_id",
        *[count(kind, True).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(listed(F.filter("spans", lambda s: s["plain"])), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        *[count(kind, False).alias(f"n_all_{kind}") for kind in KINDS],
    )


@query
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(documents(spark, folder))


@query
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = whiten(spark.read.parquet(f"{folder}/embeddings.parquet"))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


@query
def op12_mixing(spark: SparkSession, folder: str) -> DataFrame:
    passes = mix(documents(spark, folder))
    return passes.groupBy("row", "doc_id", "size", "source_size", "target").agg(F.sum("taken").alias("taken")).drop("row")


@query
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    capitals, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    tampered = [F.translate(c, capitals, small) if c == "text" else F.col(c) for c in columns]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = merkle.manifest(
        documents(spark, folder), columns, carried={"tampered": F.when(chosen, merkle.leaf(*tampered))}
    )
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings_of(F.col("path")), 256).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == F.col("root")).alias("verified"),
    )

"""Message arrival as streams.

Messages are identified by stream-static joins in the streaming plan and land in a file sink, which takes
every micro-batch exactly once.  Running counts are a streaming aggregation: the state store
holds them.  The write streams keep append-only logs with one folder per micro-batch, so a
repeated micro-batch overwrites its own folder and what it writes does not grow
with the tables; the base tables with the logs applied are the present ones, and
a batch job makes them the new base from time to time.  ``start_conversation``
instead applies every micro-batch to a store at once.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from funil.functions import config
from funil.operators.changes import (
    apply_defaults, fold_contacts, split_messages, touch, upsert_leads,
)
from funil.operators.numbering import assign_ids
from funil.settings import write_once
from funil.sources.store import TableStore
from funil.tables import SalesTables

MESSAGE_LOG = "id BIGINT, mensagem STRING, is_bot BOOLEAN, created_at TIMESTAMP_NTZ, lead_id BIGINT"
CONTACT_LOG = (
    "remotejid STRING, provedor_id BIGINT, seq BIGINT, nome STRING, cpf_cnpj STRING, "
    "endereco_instalacao STRING, whatsapp STRING, tags ARRAY<STRING>"
)
RANGE_LOG = "last_id BIGINT"


def _log(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    """A log with its batch number; ``batch_id`` is the partition column."""
    return spark.read.schema(f"{schema}, batch_id BIGINT").parquet(f"{folder}/{name}")


def _write_batch(df: DataFrame, folder: str, name: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{folder}/{name}/batch_id={batch_id}")


def _start(stream: DataFrame, on_batch, folder: str, name: str, **trigger) -> StreamingQuery:
    """Land each micro-batch as files, then hand it on.

    Landed, it is read from its source once however often it is used, and its
    size is known, so that a small one is broadcast to the tables it meets.
    """
    def land(batch, batch_id):
        _write_batch(batch, folder, f"landed_{name}", batch_id)
        landed = f"{folder}/landed_{name}/batch_id={batch_id}"
        on_batch(batch.sparkSession.read.schema(batch.schema).parquet(landed), batch_id)

    return (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", f"{folder}/progress/{name}")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


# Who wrote, and how to answer.

def identify(messages: DataFrame, tables: SalesTables) -> DataFrame:
    """Add lead and assistant settings to incoming ``(remotejid, instancia, ...)`` rows.

    Rows of unknown contacts or inactive providers have no match.  The contacts
    of all rows are looked up first, so a busy contact is one row of that join;
    the settings, which are long, are attached last.
    """
    active = tables.provedores.filter("ativo")
    contacts = messages.select("remotejid", "instancia").distinct()
    found = (
        tables.leads.select(
            "remotejid", F.col("id").alias("lead_id"), F.col("nome").alias("lead_nome"), "provedor_id"
        )
        .join(active.select(F.col("id").alias("provedor_id"), "instancia"), "provedor_id")
        .join(contacts, ["remotejid", "instancia"])
    )
    settings = active.select(
        F.col("id").alias("provedor_id"),
        F.col("config_bot").alias("config"),
        config.text(F.col("config_bot"), "modelo").alias("modelo"),
    )
    return messages.join(write_once(found, "found"), ["remotejid", "instancia"]).join(settings, "provedor_id")


def start_identify(messages: DataFrame, tables: SalesTables, folder: str, **trigger) -> StreamingQuery:
    """Write identified messages, by stream-static joins in the plan and a file sink.

    The joins give the rows that ``identify`` gives; the lead table and the settings are read for
    every micro-batch, the settings, which are long, joined last.  The sink's own list says which
    files count, so a micro-batch that is made again after a failure is there once.
    """
    active = tables.provedores.filter("ativo")
    contacts = tables.leads.select(
        "remotejid", F.col("id").alias("lead_id"), F.col("nome").alias("lead_nome"), "provedor_id"
    ).join(active.select(F.col("id").alias("provedor_id"), "instancia"), "provedor_id")
    settings = active.select(
        F.col("id").alias("provedor_id"),
        F.col("config_bot").alias("config"),
        config.text(F.col("config_bot"), "modelo").alias("modelo"),
    )
    found = messages.join(contacts, ["remotejid", "instancia"]).join(settings, "provedor_id")
    return (
        found.writeStream.format("parquet").outputMode("append")
        .option("path", f"{folder}/identified").option("checkpointLocation", f"{folder}/progress/identified")
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def identified(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/identified")


# Whole conversations.

def start_conversation(
    messages: DataFrame, store: TableStore, folder: str, as_of: datetime | None = None, name: str = "conversation", **trigger
) -> StreamingQuery:
    """Apply micro-batches of arrived messages to a store: contacts first, then their messages.

    A micro-batch is one version of the store, which remembers it, so a repeated one
    changes nothing.  What cannot be identified is logged under ``unidentified``;
    ``replay`` offers it again, for instance after a provider was added.
    """

    def on_batch(batch, batch_id):
        unknown = store.record_conversation(batch, as_of, (name, batch_id))
        _write_batch(unknown, folder, f"unidentified_{name}", batch_id)

    return _start(messages, on_batch, folder, name, **trigger)


def unidentified(spark: SparkSession, folder: str, name: str = "conversation") -> DataFrame:
    return spark.read.parquet(f"{folder}/unidentified_{name}").drop("batch_id")


def replay(store: TableStore, folder: str, as_of: datetime | None = None, name: str = "conversation") -> DataFrame:
    """Apply the unidentified messages that can be identified by now; returns those that still cannot."""
    waiting = unidentified(store.spark, folder, name)
    return store.record_conversation(waiting, as_of)


# Contacts.

def start_upserts(contacts: DataFrame, folder: str, **trigger) -> StreamingQuery:
    """Fold each micro-batch of contact calls to patches and log them."""

    def on_batch(batch, batch_id):
        _write_batch(fold_contacts(batch), folder, "contacts", batch_id)

    return _start(contacts, on_batch, folder, "contacts", **trigger)


def leads_after(tables: SalesTables, folder: str, as_of: datetime | Column | None = None) -> SalesTables:
    """The tables with the logged contact patches applied."""
    log = _log(tables.spark, folder, "contacts", CONTACT_LOG)
    patches = log.withColumn("seq", F.struct("batch_id", "seq"))
    return upsert_leads(tables, patches, as_of).tables


# Messages.

def start_register(
    messages: DataFrame, tables: SalesTables, folder: str, as_of: datetime | Column | None = None, **trigger
) -> StreamingQuery:
    """Log each micro-batch of messages ``(seq, lead_id, mensagem, ...)`` under final ids.

    The row in the ``ranges`` log, written last, holds the last id given out.
    """
    spark = tables.spark

    def ranges():
        return _log(spark, folder, "ranges", RANGE_LOG)

    # Batch -1 stands for the base table; a restarted stream overwrites it alike.
    base = tables.mensagens.agg(F.coalesce(F.max("id"), F.lit(0)).cast("bigint").alias("last_id"))
    _write_batch(base, folder, "ranges", -1)

    def on_batch(batch, batch_id):
        accepted, rejected, _ = split_messages(batch, tables.leads)
        before = ranges().filter(F.col("batch_id") < batch_id).agg(F.max("last_id")).first()[0]
        numbered = apply_defaults(assign_ids(accepted, ["seq"], before), "mensagens", as_of)
        _write_batch(numbered, folder, "messages", batch_id)
        _write_batch(rejected, folder, "rejected_messages", batch_id)
        written = spark.read.schema(MESSAGE_LOG).parquet(f"{folder}/messages/batch_id={batch_id}")
        last = written.agg(F.coalesce(F.max("id"), F.lit(before)).cast("bigint").alias("last_id"))
        _write_batch(last, folder, "ranges", batch_id)

    return _start(messages, on_batch, folder, "messages", **trigger)


def messages_after(
    tables: SalesTables, folder: str, as_of: datetime | Column | None = None
) -> SalesTables:
    """The tables with the logged messages appended and their leads touched."""
    log = _log(tables.spark, folder, "messages", MESSAGE_LOG).drop("batch_id")
    return tables.with_(
        mensagens=tables.mensagens.unionByName(log),
        leads=touch(tables.leads, log.select("lead_id").distinct(), as_of),
    )


# Running counts.

def start_counts(
    messages: DataFrame, tables: SalesTables, folder: str, repeats: str = "7 days", **trigger
) -> StreamingQuery:
    """Count messages ``(seq, lead_id, is_bot, created_at)`` per provider and sender, in the state store.

    A message that comes again, told by its ``seq``, is counted once as long as it comes within
    ``repeats`` of event time; so long its ``seq`` is kept.  A message that is older than the newest of
    earlier micro-batches by more than that is not counted.  Messages of unknown leads are not counted.
    Rows are counted per task before they meet the state, so a busy provider is one row per task.
    A stream started again on its folder goes on from its state.
    """
    leads = tables.leads.select(F.col("id").alias("lead_id"), "provedor_id")
    counts = (
        messages.select("seq", "lead_id", "is_bot", F.col("created_at").cast("timestamp"))
        .withWatermark("created_at", repeats).dropDuplicatesWithinWatermark(["seq"])
        .join(leads, "lead_id")
        .groupBy("provedor_id", "is_bot").agg(F.count(F.lit(1)).alias("n_messages"))
    )
    return (
        counts.writeStream.format("noop").outputMode("update")
        .option("checkpointLocation", f"{folder}/progress/counts")
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def running_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The counts up to the last micro-batch, out of the state of ``start_counts``."""
    place = f"{folder}/progress/counts"
    operators = spark.read.format("state-metadata").load(place).where("operatorName = 'stateStoreSave'")
    number = operators.agg(F.max("operatorId")).first()[0]  # one operator per stateful step of the plan
    state = spark.read.format("statestore").option("operatorId", number).load(place)
    return state.select("key.provedor_id", "key.is_bot", F.col("value.count").alias("n_messages"))

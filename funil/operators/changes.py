"""Changes as DataFrame-to-DataFrame operators: a whole batch of calls at once.

A batch carries ``seq``, the unique order of its calls, and gives the state the
calls would leave if made one after the other.  Calls that lack a required value
or name an unknown parent change nothing; they are returned as ``rejected``.
"""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from funil import schema as S, values as V
from funil.functions.scalars import moment
from funil.operators.numbering import assign_ids, last_id
from funil.settings import write_once
from funil.tables import SalesTables

CONTACT_FIELDS = ("nome", "cpf_cnpj", "endereco_instalacao", "whatsapp", "tags")
CONTACT_KEY = ["remotejid", "provedor_id"]


class Changed(NamedTuple):
    tables: SalesTables
    rejected: DataFrame
    ids: DataFrame  # (seq, id): the row each accepted call wrote


def apply_defaults(rows: DataFrame, table: str, as_of: datetime | Column | None = None) -> DataFrame:
    """Fill omitted columns.  An explicit NULL stays and is left to the NOT NULL check."""
    defaults = S.column_defaults(table, moment(as_of))

    def column(field):
        given = field.name in rows.columns
        value = F.col(field.name) if given else defaults.get(field.name, F.lit(None))
        return value.cast(field.dataType).alias(field.name)

    fields = [f for f in S.SCHEMAS[table] if f.name != "id" or "id" in rows.columns]
    return rows.select([column(f) for f in fields])


def insert_rows(
    existing: DataFrame, rows: DataFrame, table: str, order: list[str], as_of: datetime | Column | None = None
) -> DataFrame:
    """Insert rows without ids: omitted columns take defaults, ids continue in ``order``."""
    numbered = assign_ids(rows, order, last_id(existing))
    return existing.unionByName(apply_defaults(numbered, table, as_of))


def update_rows(
    df: DataFrame, where: Column, values: dict[str, Column], as_of: datetime | Column | None = None
) -> DataFrame:
    """Set columns of the rows meeting a condition, also ``updated_at`` where the table has it.

    A row is touched even if its values stay the same.
    """
    if "updated_at" in df.columns:
        values = {**values, "updated_at": moment(as_of)}
    types = {f.name: f.dataType for f in df.schema}
    return df.withColumns({
        c: F.when(where, value.cast(types[c])).otherwise(F.col(c)) for c, value in values.items()
    })


def touch(leads: DataFrame, touched: DataFrame, as_of: datetime | Column | None) -> DataFrame:
    """Set ``updated_at`` of the leads in ``touched(lead_id)``, which has no duplicates."""
    marked = touched.select(F.col("lead_id").alias("id"), F.lit(True).alias("_touched"))
    stamp = F.when(F.col("_touched"), moment(as_of)).otherwise(F.col("updated_at"))
    return leads.join(marked, "id", "left").withColumn("updated_at", stamp).select(*leads.columns)


def split_calls(
    batch: DataFrame, required: list[str], key: str, parents: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(calls that can be made, calls that cannot, distinct parent keys of the former).

    A call cannot be made if a required value is NULL or its parent does not
    exist.  The parent table is the streamed side: it is not shuffled while the batch's
    keys are few.  The keys found are written, so their size is known to the
    joins that follow.
    """
    complete = F.lit(True)
    for column in required:
        complete = complete & F.col(column).isNotNull()
    calls = batch.filter(complete)
    ids = parents.select(F.col("id").alias(key))
    known = write_once(ids.join(calls.select(key).distinct(), key, "left_semi").distinct(), "known")
    rejected = calls.join(known, key, "left_anti").unionByName(batch.filter(~complete))
    return calls.join(known, key, "left_semi"), rejected, known


def split_messages(batch: DataFrame, leads: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    required = [c for c in S.required_columns("mensagens") if c in batch.columns]
    return split_calls(batch, required, "lead_id", leads)


def append_messages(
    tables: SalesTables, batch: DataFrame, as_of: datetime | Column | None = None, last: int | None = None
) -> Changed:
    """Record messages ``(seq, lead_id, mensagem[, is_bot, created_at])`` and touch their leads.

    Ids follow ``last``, or the highest id of the table.
    """
    return record_messages(tables, batch, as_of, last)[0]


def record_messages(
    tables: SalesTables, batch: DataFrame, as_of: datetime | Column | None = None, last: int | None = None
) -> tuple[Changed, DataFrame]:
    """What ``append_messages`` gives, and the new rows alone."""
    as_of = moment(as_of)
    accepted, rejected, known = split_messages(batch, tables.leads)
    numbered = assign_ids(accepted, ["seq"], last_id(tables.mensagens) if last is None else last)
    new = apply_defaults(numbered, "mensagens", as_of)
    after = tables.with_(mensagens=tables.mensagens.unionByName(new), leads=touch(tables.leads, known, as_of))
    return Changed(after, rejected, numbered.select("seq", "id")), new


def update_tags(leads: DataFrame, batch: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    """Overwrite tags from ``(seq, lead_id, tags)``; NULL clears them, unknown leads are ignored."""
    as_of = moment(as_of)
    last = batch.groupBy(F.col("lead_id").alias("id")).agg(
        F.max_by(F.struct(F.col("tags").alias("value")), "seq").alias("_new")
    )
    written = F.col("_new").isNotNull()
    return (
        leads.join(last, "id", "left")
        .withColumn("tags", F.when(written, F.col("_new.value")).otherwise(F.col("tags")))
        .withColumn("updated_at", F.when(written, as_of).otherwise(F.col("updated_at")))
        .select(*leads.columns)
    )


def fold_contacts(batch: DataFrame, seq: str = "seq") -> DataFrame:
    """One patch per contact and provider: the last value given for each field.

    ``seq`` of a patch is its first call's, so patches of later batches can be
    folded again with earlier ones.
    """
    order = F.col(seq)
    # This aggregation sorts; leading with a hash makes it compare longs, not texts.
    return (
        batch.withColumn("_hash", F.xxhash64(*CONTACT_KEY))
        .groupBy("_hash", *CONTACT_KEY)
        .agg(
            F.min(order).alias(seq),
            *[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in CONTACT_FIELDS],
        )
        .drop("_hash")
    )


def upsert_leads(
    tables: SalesTables, batch: DataFrame, as_of: datetime | Column | None = None, seq: str = "seq",
    last: int | None = None,
) -> Changed:
    """Create or update leads from contact calls ``(seq, remotejid, provedor_id, fields...)``.

    Fields left NULL keep their value; a new lead without tags gets the default
    tag.  Where leads share a contact and provider the lowest id is updated.
    The lead table is shuffled only if the batch is too large to broadcast.  Ids of
    new leads follow ``last``, or the highest id of the table.
    """
    leads, as_of = tables.leads, moment(as_of)
    known, rejected, _ = split_calls(batch, CONTACT_KEY, "provedor_id", tables.provedores)
    # Folded once: targets and patches read the result.
    folded = write_once(fold_contacts(known, seq), "folded")
    targets = (
        leads.select(F.col("id").alias("lead_id"), *CONTACT_KEY)
        .join(folded.select(*CONTACT_KEY), CONTACT_KEY)
        .groupBy(*CONTACT_KEY)
        .agg(F.min("lead_id").alias("lead_id"))
    )
    # Both branches below read the patches.
    patches = write_once(folded.join(targets, CONTACT_KEY, "left"), "patches")

    new_values = [F.col(c).alias(f"_{c}") for c in CONTACT_FIELDS]
    found = patches.filter("lead_id IS NOT NULL")
    edits = found.select(F.col("lead_id").alias("id"), F.lit(True).alias("_hit"), *new_values)
    merged = {c: F.coalesce(f"_{c}", c) for c in CONTACT_FIELDS}
    stamp = F.when(F.col("_hit"), as_of).otherwise(F.col("updated_at"))
    updated = (
        leads.join(edits, "id", "left").withColumns({**merged, "updated_at": stamp}).select(*leads.columns)
    )

    created = patches.filter("lead_id IS NULL").withColumn(
        "tags", F.coalesce("tags", F.array(F.lit(V.TAG_NEW)))
    )
    numbered = assign_ids(created, [seq, *CONTACT_KEY], last_id(leads) if last is None else last)
    written = numbered.select(*CONTACT_KEY, "id").unionByName(
        found.select(*CONTACT_KEY, F.col("lead_id").alias("id"))
    )
    return Changed(
        tables.with_(leads=updated.unionByName(apply_defaults(numbered, "leads", as_of))),
        rejected,
        known.join(written, CONTACT_KEY).select(seq, "id"),
    )


def delete_providers(tables: SalesTables, deleted: DataFrame) -> SalesTables:
    """Remove the providers in ``deleted(id)`` with their plans, leads and those leads' messages."""
    gone = deleted.select("id").distinct()
    of_gone = gone.withColumnRenamed("id", "provedor_id")
    # Written, so that the messages are not shuffled when few leads go.
    lost_leads = write_once(
        tables.leads.join(of_gone, "provedor_id", "left_semi").select(F.col("id").alias("lead_id")), "lost"
    )
    return SalesTables(
        provedores=tables.provedores.join(gone, "id", "left_anti"),
        planos=tables.planos.join(of_gone, "provedor_id", "left_anti").select(*tables.planos.columns),
        leads=tables.leads.join(of_gone, "provedor_id", "left_anti").select(*tables.leads.columns),
        mensagens=tables.mensagens.join(lost_leads, "lead_id", "left_anti").select(*tables.mensagens.columns),
    )

"""Lookups by key: one key per call, or a whole DataFrame of keys in one join.

The bulk forms carry their key column in front.  ``apikey`` and personal fields
are returned to the caller; never print or log them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from funil import values as V
from funil.functions.scalars import chat_role
from funil.operators.skew import first_per_key
from funil.tables import SalesTables


def leads_with_provider(tables: SalesTables) -> DataFrame:
    provider = tables.provedores.select(
        F.col("id").alias("provedor_id"), F.col("nome_provedor").alias("provedor"), "instancia"
    )
    return tables.leads.select(
        "remotejid",
        F.col("id").alias("lead_id"),
        F.col("nome").alias("lead_nome"),
        F.col("whatsapp").alias("lead_whatsapp"),
        F.col("cpf_cnpj").alias("lead_cpf_cnpj"),
        F.col("endereco_instalacao").alias("lead_endereco"),
        F.col("tags").alias("lead_tags"),
        "provedor_id",
    ).join(provider, "provedor_id").select(
        "remotejid", "lead_id", "lead_nome", "lead_whatsapp", "lead_cpf_cnpj",
        "lead_endereco", "lead_tags", "provedor", "provedor_id", "instancia",
    )


def leads_by_contact(tables: SalesTables, contacts: DataFrame) -> DataFrame:
    """Leads of every contact in ``contacts(remotejid)``, one row per provider they wrote to."""
    return contacts.select("remotejid").distinct().join(leads_with_provider(tables), "remotejid")


def lead_by_contact(tables: SalesTables, remotejid: str) -> DataFrame:
    return leads_with_provider(tables).filter(F.col("remotejid") == remotejid).drop("remotejid")


def active_configs(tables: SalesTables) -> DataFrame:
    return tables.provedores.filter("ativo").select(
        "instancia",
        F.col("id").alias("provedor_id"),
        "nome_provedor",
        F.col("config_bot").alias("config"),
        "apikey",
    )


def bot_configs(tables: SalesTables, instances: DataFrame) -> DataFrame:
    """Configuration of every active provider in ``instances(instancia)``."""
    return instances.select("instancia").distinct().join(active_configs(tables), "instancia")


def bot_config(tables: SalesTables, instancia: str) -> DataFrame:
    return active_configs(tables).filter(F.col("instancia") == instancia).drop("instancia")


def active_plans(tables: SalesTables) -> DataFrame:
    return tables.planos.filter("ativo").select(
        "provedor_id",
        F.col("id").alias("plano_id"),
        F.col("nome_plano").alias("nome"),
        "velocidade",
        "valor",
        "ativo",
    )


def plans_of_providers(tables: SalesTables, providers: DataFrame) -> DataFrame:
    """Active plans of every provider in ``providers(provedor_id)``, unordered."""
    return providers.select("provedor_id").distinct().join(active_plans(tables), "provedor_id")


def plans_of_provider(tables: SalesTables, provedor_id: int) -> DataFrame:
    """Active plans of one provider, cheapest first."""
    return (
        active_plans(tables)
        .filter(F.col("provedor_id") == provedor_id)
        .drop("provedor_id")
        .orderBy("valor", "plano_id")
    )


def as_chat(messages: DataFrame) -> DataFrame:
    return messages.select(
        "lead_id",
        F.col("id").alias("msg_id"),
        "mensagem",
        chat_role(F.col("is_bot")).alias("remetente"),
        F.col("created_at").alias("enviada_em"),
    )


def _chat_order(newest: bool):
    names = ["enviada_em", "msg_id"]
    return [F.desc(c) for c in names] if newest else [F.asc(c) for c in names]


def history(
    messages: DataFrame, lead_id: int, limit: int = V.HISTORY_LIMIT, newest: bool = False
) -> DataFrame:
    """The oldest ``limit`` messages of one lead (or the newest), in order of time."""
    chat = as_chat(messages.filter(F.col("lead_id") == lead_id)).drop("lead_id")
    chosen = chat.orderBy(*_chat_order(newest)).limit(limit)
    return chosen.orderBy(*_chat_order(False)) if newest else chosen


def histories(
    messages: DataFrame,
    limit: int = V.HISTORY_LIMIT,
    newest: bool = False,
    leads: DataFrame | None = None,
    **skew,
) -> DataFrame:
    """The same for all leads, or for those in ``leads(lead_id)``, unordered."""
    chosen = messages
    if leads is not None:
        chosen = messages.join(leads.select("lead_id").distinct(), "lead_id", "left_semi")
    return first_per_key(
        as_chat(chosen), "lead_id", _chat_order(newest), limit, census=messages.select("lead_id"), **skew
    )

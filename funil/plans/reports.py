"""Everyday reports over the four tables: filters, counts, rankings, JSON settings.

Where an order has ties the id decides, and NULLs sort as the largest value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from funil.functions import config
from funil.functions.scalars import tagged
from funil.tables import SalesTables


# Scans and projections.

def provider_tiers(t: SalesTables) -> DataFrame:
    return t.provedores.select("nome_provedor", "plano")


def some_leads(t: SalesTables, n: int = 5) -> DataFrame:
    return t.leads.orderBy("id").limit(n)


def leads_by_name(t: SalesTables) -> DataFrame:
    return t.leads.orderBy(F.asc_nulls_last("nome"), "id").select("nome", "whatsapp")


# Filters.

def providers_named(t: SalesTables, name: str) -> DataFrame:
    return t.provedores.filter(F.col("nome_provedor") == name)


def plans_below(t: SalesTables, price) -> DataFrame:
    return t.planos.filter(F.col("valor") < price).select("nome_plano", "velocidade", "valor")


def plans_between(t: SalesTables, low, high) -> DataFrame:
    return t.planos.filter(F.col("valor").between(low, high)).select("nome_plano", "valor")


def active_plans_below(t: SalesTables, price) -> DataFrame:
    return t.planos.filter(F.col("ativo") & (F.col("valor") < price)).select("nome_plano", "valor")


def leads_with_address_like(t: SalesTables, pattern: str) -> DataFrame:
    return t.leads.filter(F.col("endereco_instalacao").like(pattern)).select("nome", "endereco_instalacao")


def bot_messages(t: SalesTables) -> DataFrame:
    return t.mensagens.filter("is_bot").select("mensagem", "created_at")


def active_providers(t: SalesTables) -> DataFrame:
    return t.provedores.filter("ativo").select("nome_provedor", "ativo")


def leads_with_any_tag(t: SalesTables, *tags: str) -> DataFrame:
    wanted = F.lit(False)
    for tag in tags:
        wanted = wanted | tagged(F.col("tags"), tag)
    return t.leads.filter(wanted).select("nome", "tags")


def providers_not_on_tier(t: SalesTables, tier: str) -> DataFrame:
    return provider_tiers(t).filter(F.col("plano") != tier)


# Totals and groups.

def total(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def leads_of_provider(t: SalesTables, provedor_id: int) -> DataFrame:
    return total(t.leads.filter(F.col("provedor_id") == provedor_id), "total_leads")


def average_price(t: SalesTables) -> DataFrame:
    return t.planos.agg(F.avg("valor").alias("preco_medio"))


def highest_price(t: SalesTables) -> DataFrame:
    return t.planos.agg(F.max("valor").alias("plano_mais_caro"))


def lowest_price(t: SalesTables) -> DataFrame:
    return t.planos.agg(F.min("valor").alias("plano_mais_barato"))


def counts_by(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def average_price_by_provider(t: SalesTables) -> DataFrame:
    return t.planos.groupBy("provedor_id").agg(F.avg("valor").alias("preco_medio"))


def providers_with_more_leads_than(t: SalesTables, n: int) -> DataFrame:
    return counts_by(t.leads, "provedor_id", "total_leads").filter(F.col("total_leads") > n)


def tag_frequency(t: SalesTables) -> DataFrame:
    return (
        t.leads.select(F.explode("tags").alias("tag"))
        .groupBy("tag")
        .agg(F.count(F.lit(1)).alias("frequencia"))
        .orderBy(F.desc("frequencia"), "tag")
    )


# Rankings and time.

def plans_by_price(t: SalesTables) -> DataFrame:
    return t.planos.orderBy(F.desc_nulls_first("valor"), "id").select("nome_plano", "velocidade", "valor")


def newest_leads(t: SalesTables, k: int = 3) -> DataFrame:
    return t.leads.orderBy(F.desc("created_at"), "id").limit(k).select("nome", "whatsapp", "created_at")


def messages_of_lead(t: SalesTables, lead_id: int) -> DataFrame:
    return (
        t.mensagens.filter(F.col("lead_id") == lead_id)
        .orderBy("created_at", "id")
        .select("mensagem", "is_bot", "created_at")
    )


# JSON settings.

def ai_models(t: SalesTables) -> DataFrame:
    return t.provedores.select("nome_provedor", config.text(F.col("config_bot"), "modelo").alias("modelo_ia"))


def ai_settings(t: SalesTables) -> DataFrame:
    parsed = config.fields(F.col("config_bot"), "modelo", "max_tokens", "temperatura")
    return t.provedores.select("nome_provedor", parsed.alias("c")).select(
        "nome_provedor", "c.modelo", F.col("c.max_tokens").alias("tokens"), F.col("c.temperatura").alias("temp")
    )


def _provider_names(t: SalesTables, condition: Column) -> DataFrame:
    return t.provedores.filter(condition).select("nome_provedor")


def providers_on_model(t: SalesTables, model: str) -> DataFrame:
    return _provider_names(t, config.text(F.col("config_bot"), "modelo") == model)


def providers_with_setting(t: SalesTables, key: str) -> DataFrame:
    return _provider_names(t, config.has_key(F.col("config_bot"), key))


def providers_with_prompt_like(t: SalesTables, pattern: str) -> DataFrame:
    return _provider_names(t, config.text(F.col("config_bot"), "prompt_sdr").ilike(pattern))


def ai_profile(t: SalesTables) -> DataFrame:
    """Model, numbers and prompt length per provider, longest prompt first."""
    parsed = config.fields(F.col("config_bot"), "modelo", "max_tokens", "temperatura", "prompt_sdr")
    return (
        t.provedores.select("id", "nome_provedor", "plano", parsed.alias("c"))
        .select(
            "id",
            "nome_provedor",
            "plano",
            F.col("c.modelo").alias("modelo_ia"),
            config.integer(F.col("c.max_tokens")).alias("tokens"),
            config.number(F.col("c.temperatura")).alias("temperatura"),
            F.length("c.prompt_sdr").alias("tamanho_prompt"),
        )
        .orderBy(F.desc_nulls_first("tamanho_prompt"), "id")
        .drop("id")
    )

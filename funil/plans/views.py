"""The four named views.  They are unordered; sorting is the caller's last step."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from funil import values as V
from funil.functions import config
from funil.functions.scalars import sender, tagged
from funil.tables import SalesTables


def _provider_names(tables: SalesTables, *more) -> DataFrame:
    return tables.provedores.select(F.col("id").alias("provedor_id"), "nome_provedor", *more)


def leads_full(tables: SalesTables) -> DataFrame:
    """Leads with their provider, message count and latest message time."""
    per_lead = tables.mensagens.groupBy("lead_id").agg(
        F.count(F.lit(1)).alias("total_mensagens"), F.max("created_at").alias("ultima_mensagem")
    )
    return (
        tables.leads.withColumnsRenamed({
            "id": "lead_id", "nome": "lead_nome",
            "created_at": "lead_desde", "updated_at": "ultima_atualizacao",
        })
        .join(_provider_names(tables, "instancia"), "provedor_id")
        .join(per_lead, "lead_id", "left")
        .select(
            "lead_id", "lead_nome", "whatsapp", "remotejid", "cpf_cnpj", "endereco_instalacao",
            "tags", "lead_desde", "ultima_atualizacao", "provedor_id", "nome_provedor", "instancia",
            F.coalesce("total_mensagens", F.lit(0)).alias("total_mensagens"),
            "ultima_mensagem",
        )
    )


def plans_full(tables: SalesTables) -> DataFrame:
    """Plans with their provider's name and subscription tier."""
    return (
        tables.planos.withColumnRenamed("id", "plano_id")
        .join(_provider_names(tables, F.col("plano").alias("plano_assinatura")), "provedor_id")
        .select(
            "plano_id", "nome_plano", "velocidade", "valor", "ativo",
            "provedor_id", "nome_provedor", "plano_assinatura",
        )
    )


def conversations(tables: SalesTables, messages: DataFrame | None = None) -> DataFrame:
    """Messages with lead, provider and a sender label.

    ``messages`` narrows the view to some rows of the message table.
    """
    # Providers join the leads, not the far more numerous messages, which are
    # then shuffled once at most.
    lead = tables.leads.select(
        F.col("id").alias("lead_id"), F.col("nome").alias("lead_nome"), "whatsapp", "provedor_id"
    ).join(_provider_names(tables, "instancia"), "provedor_id")
    return (
        (tables.mensagens if messages is None else messages)
        .join(lead, "lead_id")
        .select(
            F.col("id").alias("msg_id"), "lead_id", "lead_nome", "whatsapp", "nome_provedor",
            "instancia", "mensagem", sender(F.col("is_bot")).alias("remetente"),
            F.col("created_at").alias("enviada_em"),
        )
    )


def newest_conversations(tables: SalesTables, k: int) -> DataFrame:
    """The ``k`` newest rows of ``conversations``.

    Messages meet their leads and providers without their texts; the texts of the
    ``k`` that are left are fetched last.
    """
    leads = tables.leads.select(F.col("id").alias("lead_id"), "provedor_id")
    known = leads.join(tables.provedores.select(F.col("id").alias("provedor_id")), "provedor_id", "left_semi")
    newest = (
        tables.mensagens.select("id", "created_at", "lead_id")
        .join(known.select("lead_id"), "lead_id", "left_semi")
        .orderBy(F.desc("created_at"), F.desc("id")).limit(k)
    )
    # k rows, as many as the caller asks for.
    texts = tables.mensagens.join(F.broadcast(newest.select("id")), "id", "left_semi")
    return conversations(tables, texts).orderBy(F.desc("enviada_em"), F.desc("msg_id"))


def providers_summary(tables: SalesTables) -> DataFrame:
    """Per provider: lead and hot-lead counts, active plans and their price range, AI settings."""
    of_leads = tables.leads.groupBy("provedor_id").agg(
        F.count(F.lit(1)).alias("total_leads"),
        F.count_if(tagged(F.col("tags"), V.TAG_HOT)).alias("leads_quentes"),
    )
    of_plans = tables.planos.filter("ativo").groupBy("provedor_id").agg(
        F.count(F.lit(1)).alias("total_planos"),
        F.min("valor").alias("plano_mais_barato"),
        F.max("valor").alias("plano_mais_caro"),
    )
    settings = config.fields(F.col("config_bot"), "modelo", "webhook_n8n")
    return (
        tables.provedores.select(
            F.col("id").alias("provedor_id"), "nome_provedor",
            F.col("plano").alias("plano_assinatura"), "ativo", "instancia",
            settings.alias("settings"),
        )
        .join(of_leads, "provedor_id", "left")
        .join(of_plans, "provedor_id", "left")
        .select(
            "provedor_id", "nome_provedor", "plano_assinatura", "ativo", "instancia",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total_leads", "leads_quentes", "total_planos")],
            "plano_mais_barato", "plano_mais_caro",
            F.col("settings.modelo").alias("modelo_ia"),
            F.col("settings.webhook_n8n").alias("webhook_n8n"),
        )
    )

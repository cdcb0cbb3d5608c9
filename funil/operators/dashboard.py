"""Dashboard figures: overall, for one provider, or for every provider.

Messages are counted per lead before they meet the leads, so a lead with very
many messages weighs one row in the join, and each table is read once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from funil import values as V
from funil.functions.scalars import tagged
from funil.tables import SalesTables

COUNTS = (
    "total_leads", "leads_quentes", "leads_mornos", "leads_frios",
    "total_mensagens", "mensagens_bot", "mensagens_humanas", "total_planos",
)
PRICES = ("plano_mais_barato", "plano_mais_caro")


def _leads_with_message_counts(leads: DataFrame, messages: DataFrame) -> DataFrame:
    per_lead = messages.groupBy("lead_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("is_bot").alias("n_bot"),
        F.count_if(~F.col("is_bot")).alias("n_human"),
    )
    return leads.select(F.col("id").alias("lead_id"), "provedor_id", "tags").join(per_lead, "lead_id", "left")


def _lead_figures():
    tags = F.col("tags")
    return [
        F.count(F.lit(1)).alias("total_leads"),
        F.count_if(tagged(tags, V.TAG_HOT)).alias("leads_quentes"),
        F.count_if(tagged(tags, V.TAG_WARM)).alias("leads_mornos"),
        F.count_if(tagged(tags, V.TAG_COLD)).alias("leads_frios"),
        F.sum("n").alias("total_mensagens"),
        F.sum("n_bot").alias("mensagens_bot"),
        F.sum("n_human").alias("mensagens_humanas"),
    ]


def _plan_figures():
    active_price = F.when(F.col("ativo"), F.col("valor"))
    return [
        F.count(F.lit(1)).alias("total_planos"),
        F.min(active_price).alias("plano_mais_barato"),
        F.max(active_price).alias("plano_mais_caro"),
    ]


def dashboard(tables: SalesTables, provedor_id: int | None = None) -> DataFrame:
    """One row; without a provider the figures cover everything."""
    leads, plans, messages = tables.leads, tables.planos, tables.mensagens
    if provedor_id is not None:
        mine = F.col("provedor_id") == provedor_id
        leads, plans = leads.filter(mine), plans.filter(mine)
        # Only this provider's messages are counted.
        messages = messages.join(leads.select(F.col("id").alias("lead_id")), "lead_id", "left_semi")
    of_leads = _leads_with_message_counts(leads, messages).agg(*_lead_figures())
    of_plans = plans.agg(*_plan_figures())
    both = of_leads.unionByName(of_plans, allowMissingColumns=True)
    return both.agg(
        *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in COUNTS],
        *[F.max(c).alias(c) for c in PRICES],
    )


def figures_by_provider(tables: SalesTables) -> DataFrame:
    """Lead and plan figures of every provider id that leads or plans name, known or not."""
    of_leads = _leads_with_message_counts(tables.leads, tables.mensagens).groupBy("provedor_id").agg(*_lead_figures())
    of_plans = tables.planos.groupBy("provedor_id").agg(*_plan_figures())
    return of_leads.unionByName(of_plans, allowMissingColumns=True)


def dashboard_by_provider(tables: SalesTables) -> DataFrame:
    """The same figures, one row per provider, with zeros where there is nothing."""
    of_leads = (
        _leads_with_message_counts(tables.leads, tables.mensagens)
        .groupBy("provedor_id")
        .agg(*_lead_figures())
    )
    of_plans = tables.planos.groupBy("provedor_id").agg(*_plan_figures())
    return (
        tables.provedores.select(F.col("id").alias("provedor_id"))
        .join(of_leads, "provedor_id", "left")
        .join(of_plans, "provedor_id", "left")
        .select(
            "provedor_id",
            *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in COUNTS],
            *PRICES,
        )
    )

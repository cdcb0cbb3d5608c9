"""The same names in Spark SQL: tables, views and read functions.

``register`` defines temporary views for the tables and the named views, and SQL
table functions for the lookups.  A function is a filter over the bulk form of
its lookup, so the key reaches the scan.  Functions that change data exist only
in Python (``funil.operators.changes``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from funil import values as V
from funil.operators import lookups
from funil.operators.dashboard import COUNTS, PRICES, figures_by_provider
from funil.operators.skew import SLICES
from funil.plans import views
from funil.tables import SalesTables

VIEWS = {
    "vw_leads_completo": views.leads_full,
    "vw_planos_completo": views.plans_full,
    "vw_conversas": views.conversations,
    "vw_resumo_provedores": views.providers_summary,
}

# Order in which a view shows its rows.  A LIMIT makes it a top-k, and Spark drops
# it under aggregates and joins; only reading a whole view sorts it.
ORDERS = {
    "vw_planos_completo": dict(cols=["nome_provedor", "valor", "plano_id"], ascending=True),
    "vw_conversas": dict(cols=["enviada_em", "msg_id"], ascending=False),
    "vw_resumo_provedores": dict(cols=["provedor_id"], ascending=True),
}

# Bulk forms the functions read from.
BULK = {
    "funil_leads": lookups.leads_with_provider,
    "funil_configs": lookups.active_configs,
    "funil_planos": lookups.active_plans,
    "funil_chat": lambda tables: lookups.as_chat(tables.mensagens).withColumn(
        "slice", F.pmod(F.xxhash64("msg_id"), F.lit(SLICES))
    ),
    "funil_painel": figures_by_provider,
}

FUNCTIONS = {
    "buscar_lead_por_whatsapp": (
        "p_remotejid STRING",
        "SELECT * EXCEPT (remotejid) FROM funil_leads WHERE remotejid = p_remotejid",
    ),
    "buscar_config_bot": (
        "p_instancia STRING",
        "SELECT * EXCEPT (instancia) FROM funil_configs WHERE instancia = p_instancia",
    ),
    "historico_conversa": (
        f"p_lead_id BIGINT, p_limite INT DEFAULT {V.HISTORY_LIMIT}",
        # The limit is applied in slices first: a busy lead's rows never meet in one task.
        """SELECT * EXCEPT (lead_id, place) FROM (
             SELECT * EXCEPT (slice, place),
               row_number() OVER (PARTITION BY lead_id ORDER BY enviada_em, msg_id) AS place
             FROM (
               SELECT *, row_number() OVER (PARTITION BY lead_id, slice ORDER BY enviada_em, msg_id) AS place
               FROM funil_chat WHERE lead_id = p_lead_id
             ) WHERE place <= p_limite
           ) WHERE place <= p_limite ORDER BY enviada_em, msg_id""",
    ),
    "listar_planos_provedor": (
        "p_provedor_id BIGINT",
        "SELECT * EXCEPT (provedor_id) FROM funil_planos WHERE provedor_id = p_provedor_id ORDER BY valor, plano_id",
    ),
    "dashboard_resumo": (
        "p_provedor_id BIGINT DEFAULT NULL",
        "SELECT "
        + ", ".join(f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}" for c in COUNTS)
        + f", min({PRICES[0]}) AS {PRICES[0]}, max({PRICES[1]}) AS {PRICES[1]}"
        + " FROM funil_painel WHERE p_provedor_id IS NULL OR provedor_id = p_provedor_id",
    ),
}


def register(tables: SalesTables, ordered: bool = True) -> None:
    """Define the views and functions in the session of ``tables``."""
    spark = tables.spark
    for name, df in tables.by_name().items():
        df.createOrReplaceTempView(name)
    for name, build in {**VIEWS, **BULK}.items():
        df = build(tables)
        if ordered and name in ORDERS:
            df = df.orderBy(ORDERS[name]["cols"], ascending=ORDERS[name]["ascending"])
        df.createOrReplaceTempView(name)
    for name, (parameters, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE RETURN {body}")

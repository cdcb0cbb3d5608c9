"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the input folder and ``BENCH_CPUS`` the local cores.  A
query's time is the median of its timed runs, from building the plan to the last
row, after one round over all queries to warm the JVM up.  ``naive`` holds the
same results with a subquery of its own for each figure, for comparison.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from funil.plans.catalog import QUERIES  # noqa: E402
from funil.settings import local_session  # noqa: E402
from funil.sources import raw  # noqa: E402

HEADLINE = (
    "providers_summary", "leads_full", "plans_full", "conversations_view", "newest_messages",
    "dashboard_all", "dashboard_one", "dashboard_by_provider", "lead_lookup", "lead_lookup_bulk",
    "history", "history_bulk", "commit_messages", "commit_upsert", "history_bulk_text", "tag_frequency", "msgs_by_lead", "json_profile",
    "order_by_name", "filter_any_or", "count_row", "update_tags", "append_messages", "upsert_leads",
    "cascade_delete", "check_pk", "check_fk", "snapshot_verify", "stream_counts",
)
RUNS = 5


def per_figure(parents, key, figures):
    """One aggregate and one left join per figure, as a correlated subquery each becomes."""
    for name, (children, figure) in figures.items():
        parents = parents.join(children.groupBy(key).agg(figure.alias(name)), key, "left")
    return parents


def naive_providers_summary(spark, folder):
    t = raw.sales_tables(spark, folder)
    active = t.planos.where("ativo")
    rows = F.count(F.lit(1))
    config = F.col("config_bot")
    providers = t.provedores.select(
        F.col("id").alias("provedor_id"), "nome_provedor", "plano", "ativo", "instancia",
        F.get_json_object(config, "$.modelo").alias("modelo_ia"),
        F.get_json_object(config, "$.webhook_n8n").alias("webhook_n8n"),
    )
    return per_figure(providers, "provedor_id", {
        "total_leads": (t.leads, rows),
        "leads_quentes": (t.leads.where(F.array_contains("tags", "lead_quente")), rows),
        "total_planos": (active, rows),
        "plano_mais_barato": (active, F.min("valor")),
        "plano_mais_caro": (active, F.max("valor")),
    })


def naive_leads_full(spark, folder):
    t = raw.sales_tables(spark, folder)
    names = t.provedores.select(F.col("id").alias("provedor_id"), "nome_provedor", "instancia")
    return per_figure(t.leads.withColumnRenamed("id", "lead_id").join(names, "provedor_id"), "lead_id", {
        "total_mensagens": (t.mensagens, F.count(F.lit(1))),
        "ultima_mensagem": (t.mensagens, F.max("created_at")),
    })


def naive_dashboard_all(spark, folder):
    t = raw.sales_tables(spark, folder)
    joined = t.mensagens.join(t.leads.select(F.col("id").alias("lead_id")), "lead_id")
    active = t.planos.where("ativo")

    def count(df):
        return df.agg(F.count(F.lit(1))).scalar()

    def tagged(tag):
        return count(t.leads.where(F.array_contains("tags", tag)))

    return spark.range(1).select(
        count(t.leads).alias("total_leads"), tagged("lead_quente").alias("leads_quentes"),
        tagged("lead_morno").alias("leads_mornos"), tagged("lead_frio").alias("leads_frios"),
        count(joined).alias("total_mensagens"), count(joined.where("is_bot")).alias("mensagens_bot"),
        count(joined.where("NOT is_bot")).alias("mensagens_humanas"), count(t.planos).alias("total_planos"),
        active.agg(F.min("valor")).scalar().alias("plano_mais_barato"),
        active.agg(F.max("valor")).scalar().alias("plano_mais_caro"),
    )


NAIVE = {
    "providers_summary": naive_providers_summary,
    "leads_full": naive_leads_full,
    "dashboard_all": naive_dashboard_all,
}


def once(spark, run, folder) -> float:
    started = time.perf_counter()
    run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def medians(spark, runs, folder) -> dict[str, float]:
    """Median times of several queries whose runs alternate, so that each meets a JVM as warm as the others do."""
    times = {name: [] for name in runs}
    for _ in range(RUNS):
        for name, run in runs.items():
            times[name].append(once(spark, run, folder))
    return {name: round(statistics.median(t), 4) for name, t in times.items()}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"), "16g")
    spark.sparkContext.setLogLevel("ERROR")
    chosen = {name: QUERIES[name] for name in sys.argv[1:] or HEADLINE}
    compared = {f"naive {name}": run for name, run in NAIVE.items() if name in chosen}
    for run in [*chosen.values(), *compared.values()]:
        once(spark, run, folder)
    both = medians(spark, {**chosen, **compared}, folder)
    times = {name: both[name] for name in chosen}
    naive = {name.split()[1]: both[name] for name in compared}
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "naive": naive,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": spark.sparkContext.defaultParallelism,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

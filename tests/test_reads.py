"""Views, lookups, dashboard and reports on the hand-written rows."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import T0, T2, row_set, rows
from funil.functions import config
from funil.operators import lookups
from funil.operators.dashboard import dashboard, dashboard_by_provider
from funil.plans import reports, sql, views


def test_providers_summary(tables):
    assert row_set(views.providers_summary(tables)) == {
        (1, "Alfa", "basico", True, "alfa_w", 3, 1, 2, Decimal("64.25"), Decimal("188.75"), "m1", None),
        (2, "Beta", "profissional", True, "beta_w", 1, 0, 0, None, None, None, None),
        (3, "Gama", "enterprise", False, "gama_w", 1, 0, 0, None, None, None, None),
        (4, "Delta", "basico", True, "delta_w", 0, 0, 0, None, None, "m1", None),
    }


def test_leads_full_counts_and_latest(tables):
    got = views.leads_full(tables).select("lead_id", "nome_provedor", "total_mensagens", "ultima_mensagem")
    assert row_set(got) == {
        (1, "Alfa", 4, T2), (2, "Alfa", 0, None), (3, "Alfa", 0, None), (4, "Beta", 1, T0), (5, "Gama", 1, T2),
    }


def test_plans_full_keeps_inactive(tables):
    got = views.plans_full(tables).select("plano_id", "nome_provedor", "plano_assinatura", "ativo")
    assert row_set(got) == {
        (1, "Alfa", "basico", True), (2, "Alfa", "basico", True),
        (3, "Alfa", "basico", False), (4, "Beta", "profissional", False),
    }


def test_conversations_and_newest(tables):
    got = row_set(views.conversations(tables).select("msg_id", "lead_nome", "instancia", "remetente"))
    assert got == {
        (1, "Ana", "alfa_w", "LEAD"), (2, "Ana", "alfa_w", "AGENTE_IA"), (3, "Ana", "alfa_w", "AGENTE_IA"),
        (4, "Ana", "alfa_w", "LEAD"), (5, "Caio", "beta_w", "LEAD"), (6, "Davi", "gama_w", "AGENTE_IA"),
    }
    newest = rows(views.newest_conversations(tables, 3).select("msg_id"))
    full = views.conversations(tables).orderBy(F.desc("enviada_em"), F.desc("msg_id")).limit(3)
    assert newest == rows(full.select("msg_id")) == [(6,), (4,), (3,)]


def test_lead_lookup_returns_every_provider(tables):
    assert rows(lookups.lead_by_contact(tables, "c1").select("lead_id", "provedor").orderBy("lead_id")) == [
        (1, "Alfa"), (4, "Beta"),
    ]
    assert rows(lookups.lead_by_contact(tables, "nobody")) == []


def test_bulk_lookups_are_the_union_of_single_ones(spark, tables):
    contacts = ["c1", "c5", "c5", "nobody"]
    bulk = row_set(lookups.leads_by_contact(
        tables, spark.createDataFrame([(c,) for c in contacts], "remotejid string")
    ).select("lead_id", "provedor_id").dropDuplicates())
    single = set()
    for c in contacts:
        single |= row_set(lookups.lead_by_contact(tables, c).select("lead_id", "provedor_id"))
    assert bulk == single == {(1, 1), (4, 2), (5, 3)}


def test_bot_config_needs_an_active_provider(spark, tables):
    assert rows(lookups.bot_config(tables, "alfa_w").select("provedor_id", "apikey")) == [(1, "k1")]
    assert rows(lookups.bot_config(tables, "gama_w")) == []
    many = lookups.bot_configs(tables, spark.createDataFrame([("alfa_w",), ("gama_w",)], "instancia string"))
    assert row_set(many.select("instancia")) == {("alfa_w",)}


def test_active_plans_cheapest_first(spark, tables):
    assert rows(lookups.plans_of_provider(tables, 1).select("nome", "valor")) == [
        ("Quartzo", Decimal("64.25")), ("Safira", Decimal("188.75")),
    ]
    assert rows(lookups.plans_of_provider(tables, 2)) == []


def test_history_is_oldest_first_with_ties_by_id(tables):
    m = tables.mensagens
    assert rows(lookups.history(m, 1).select("msg_id", "remetente")) == [
        (1, "user"), (2, "assistant"), (3, "assistant"), (4, "user"),
    ]
    assert rows(lookups.history(m, 1, 2).select("msg_id")) == [(1,), (2,)]
    assert rows(lookups.history(m, 1, 2, newest=True).select("msg_id")) == [(3,), (4,)]
    assert rows(lookups.history(m, 99)) == []


def test_histories_of_chosen_leads(spark, tables):
    chosen = spark.createDataFrame([(1,), (5,), (77,)], "lead_id bigint")
    got = lookups.histories(tables.mensagens, 2, leads=chosen).select("lead_id", "msg_id")
    assert row_set(got) == {(1, 1), (1, 2), (5, 6)}


def test_dashboard(tables):
    assert rows(dashboard(tables)) == [
        (5, 1, 1, 1, 6, 3, 3, 4, Decimal("64.25"), Decimal("188.75")),
    ]
    assert rows(dashboard(tables, 1)) == [(3, 1, 0, 0, 4, 2, 2, 3, Decimal("64.25"), Decimal("188.75"))]
    assert rows(dashboard(tables, 2)) == [(1, 0, 1, 0, 1, 0, 1, 1, None, None)]
    assert rows(dashboard(tables, 99)) == [(0,) * 8 + (None, None)]


def test_dashboard_of_empty_tables(tables):
    empty = tables.with_(**{name: df.limit(0) for name, df in tables.by_name().items()})
    assert rows(dashboard(empty)) == [(0,) * 8 + (None, None)]
    assert rows(dashboard_by_provider(empty)) == []


def test_dashboard_by_provider_is_the_union_of_single_ones(tables):
    for provider, *figures in rows(dashboard_by_provider(tables)):
        assert [tuple(figures)] == rows(dashboard(tables, provider))


def test_summary_agrees_with_dashboard(tables):
    total = rows(dashboard(tables).select("total_leads", "leads_quentes", "plano_mais_barato", "plano_mais_caro"))
    summed = views.providers_summary(tables).agg(
        F.sum("total_leads"), F.sum("leads_quentes"), F.min("plano_mais_barato"), F.max("plano_mais_caro")
    )
    assert rows(summed) == total


def test_null_ordering(tables):
    assert [r[0] for r in rows(reports.leads_by_name(tables))] == ["Ana", "Bia", "Caio", "Davi", None]
    assert [r[0] for r in rows(reports.ai_profile(tables))] == ["Beta", "Gama", "Delta", "Alfa"]


def test_tags_with_null_elements(tables):
    got = row_set(reports.leads_with_any_tag(tables, "lead_quente", "lead_morno").select("nome"))
    assert got == {("Ana",), ("Caio",)}
    assert ("residencial", 1) in rows(reports.tag_frequency(tables))
    assert (None, 1) in rows(reports.tag_frequency(tables))


def test_not_equal_drops_null(tables):
    unknown = tables.with_(provedores=tables.provedores.withColumn("plano", F.lit(None).cast("string")))
    assert rows(reports.providers_not_on_tier(unknown, "basico")) == []


def test_json_semantics(tables):
    assert row_set(reports.providers_with_setting(tables, "prompt_sdr")) == {("Alfa",), ("Beta",)}
    assert row_set(reports.providers_on_model(tables, "m1")) == {("Alfa",), ("Delta",)}
    alfa = rows(reports.ai_profile(tables).filter("nome_provedor = 'Alfa'"))
    assert alfa == [("Alfa", "basico", "m1", 500, Decimal("0.7000"), 3)]


def test_casts_strict_and_lenient(spark):
    bad = spark.createDataFrame([("12x",)], "v string")
    assert rows(bad.select(config.dirty_integer(F.col("v")), config.dirty_number(F.col("v")))) == [(None, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bad.select(config.integer(F.col("v"))).collect()


def test_nested_settings(spark):
    text = '{"horario_atendimento": {"inicio": "08:00", "fim": "22:00"}}'
    df = spark.createDataFrame([(text,)], "c string")
    nested = config.text(F.col("c"), "horario_atendimento")
    assert rows(df.select(config.text(nested, "inicio"), config.text(nested, "fim"))) == [("08:00", "22:00")]


def test_sql_names(spark, tables):
    sql.register(tables)
    assert spark.sql("SELECT * FROM vw_resumo_provedores").count() == 4
    assert spark.sql("SELECT * FROM vw_planos_completo").count() == 4
    assert spark.sql("SELECT * FROM vw_conversas").count() == 6
    assert spark.sql("SELECT * FROM vw_leads_completo").count() == 5
    assert rows(spark.sql("SELECT * FROM dashboard_resumo()")) == rows(dashboard(tables))
    assert rows(spark.sql("SELECT * FROM dashboard_resumo(2)")) == rows(dashboard(tables, 2))
    assert rows(spark.sql("SELECT * FROM dashboard_resumo(99)")) == rows(dashboard(tables, 99))
    assert rows(spark.sql("SELECT msg_id FROM historico_conversa(1, 2)")) == [(1,), (2,)]
    assert spark.sql("SELECT * FROM buscar_config_bot('gama_w')").count() == 0
    assert rows(spark.sql("SELECT msg_id FROM historico_conversa(1)")) == [(1,), (2,), (3,), (4,)]
    # A function may be called for each row of a table; it becomes a join on the key.
    per_provider = spark.sql("SELECT p.id, q.nome FROM provedores p, LATERAL listar_planos_provedor(p.id) q")
    assert row_set(per_provider) == {(1, "Quartzo"), (1, "Safira")}

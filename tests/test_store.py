"""A bucketed table store: checked before it changes, ids once, batches that write their own buckets only."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import AS_OF, T0, row_set, rows
from funil import schema as S
from funil.operators.dashboard import dashboard
from funil.operators.integrity import IntegrityError
from funil.plans import sql, views
from funil.sources import raw, snapshots
from funil.sources.store import StoreError, TableStore
from funil.streaming import ingest


@pytest.fixture
def store(spark, tables, tmp_path):
    made = TableStore(spark, str(tmp_path / "store"))
    made.replace(tables, T0)
    return made


def sizes(store):
    return {name: df.count() for name, df in store.current().by_name().items()}


def files(store, table):
    """The data files of a table by folder, with the time they were written."""
    out = {}
    for folder, _, names in os.walk(f"{store.root}/{table}"):
        own = {n: os.stat(f"{folder}/{n}").st_mtime_ns for n in names if n.endswith(".parquet")}
        out.update({os.path.basename(folder): own} if own else {})
    return out


def test_nothing_loaded(spark, tmp_path):
    with pytest.raises(StoreError, match="nothing has been loaded"):
        TableStore(spark, str(tmp_path)).current()


def test_a_failing_seed_changes_nothing(spark, tables, store):
    before, counters = sizes(store), store.counters()
    there = {name: files(store, name) for name in before}
    orphan = tables.with_(mensagens=tables.mensagens.withColumn("lead_id", F.lit(999).cast("bigint")))
    with pytest.raises(IntegrityError, match="foreign key lead_id"):
        store.append_seed(orphan, AS_OF)
    assert sizes(store) == before and store.counters() == counters
    assert {name: files(store, name) for name in before} == there and not os.path.exists(f"{store.root}/staged")
    store.append_seed(tables, AS_OF)
    assert sizes(store) == {name: 2 * n for name, n in before.items()}


def test_a_batch_writes_the_buckets_of_its_leads(spark, tables, tmp_path):
    """Of 2,000 leads in 50 buckets, a batch about three leaves the files of all others alone, whatever it changes."""
    many = spark.range(1, 2001).selectExpr(
        "id", "'n' AS nome", "CAST(NULL AS STRING) AS cpf_cnpj", "CAST(NULL AS STRING) AS endereco_instalacao",
        "concat('c', id) AS remotejid", "CAST(NULL AS STRING) AS whatsapp", "IF(id > 0, array('novo_lead'), array(CAST(NULL AS STRING))) AS tags",
        "TIMESTAMP_NTZ'2024-05-01 12:00:00' AS created_at", "TIMESTAMP_NTZ'2024-05-01 12:00:00' AS updated_at",
        "1L AS provedor_id",
    )
    store = TableStore(spark, str(tmp_path / "many"), buckets=50)
    store.replace(tables.with_(leads=many, mensagens=tables.mensagens.filter("lead_id = 1")), T0)
    bucket_of = {r.id: f"bucket={r.b}" for r in many.select("id", store._bucket("id").alias("b")).collect()}
    touched = {bucket_of[k] for k in (5, 700, 1999)}

    def changed(call):
        before = {name: files(store, name) for name in ("leads", "contatos", "mensagens", "planos", "provedores")}
        result = call()
        after = {name: files(store, name) for name in before}
        return result, {n: {f for f in after[n] if before[n].get(f) != after[n][f]} for n in before}

    messages = spark.createDataFrame(
        [(1, 5, "a"), (2, 700, "b"), (3, 1999, "c"), (4, 5, "d"), (5, 9999, "nobody")], "seq BIGINT, lead_id BIGINT, mensagem STRING"
    )
    recorded, which = changed(lambda: store.record_messages(messages, AS_OF))
    assert which["leads"] == touched and len(which["mensagens"]) == 1
    assert not which["contatos"] and not which["planos"] and not which["provedores"]
    assert {r.seq for r in recorded.rejected.collect()} == {5}
    assert {r.id for r in store.current().leads.where(F.col("updated_at") == AS_OF).collect()} == {5, 700, 1999}

    tags = spark.createDataFrame([(1, 5, ["x"]), (2, 700, ["y"]), (3, 1999, None)], "seq BIGINT, lead_id BIGINT, tags ARRAY<STRING>")
    _, which = changed(lambda: store.update_tags(tags, AS_OF))
    assert which["leads"] == touched and not which["mensagens"] and not which["contatos"]

    calls = spark.createDataFrame(
        [(1, "c5", 1, "E", None), (2, "c700", 1, None, None), (3, "c1999", 1, "F", None), (4, "new", 1, "G", None), (5, "c5", 2, "H", None)],
        "seq BIGINT, remotejid STRING, provedor_id BIGINT, nome STRING, tags ARRAY<STRING>",
    ).selectExpr("*", "CAST(NULL AS STRING) AS cpf_cnpj", "CAST(NULL AS STRING) AS endereco_instalacao", "CAST(NULL AS STRING) AS whatsapp")
    upserted, which = changed(lambda: store.upsert_leads(calls, AS_OF))
    ids = {r.seq: r.id for r in upserted.ids.collect()}
    assert ids == {1: 5, 2: 700, 3: 1999, 4: 2001, 5: 2002}
    new = {f"bucket={r.b}" for r in spark.range(2001, 2003).select(store._bucket("id").alias("b")).collect()}
    assert which["leads"] == touched | new and not which["mensagens"] and len(which["contatos"]) <= 2
    names = {r.id: r.nome for r in store.current().leads.where("id IN (5, 6, 700, 1999, 2001, 2002)").collect()}
    assert names == {5: "E", 6: "n", 700: "n", 1999: "F", 2001: "G", 2002: "H"} and sizes(store)["leads"] == 2002


def test_only_the_buckets_of_a_batch_are_read(spark, store):
    part = store._leads_in([3])
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan.replace("isnotnull(bucket#", "bucket#") or "PartitionFilters" in plan and "bucket" in plan


def test_saved_calls(store):
    messages = files(store, "mensagens")
    assert store.upsert_lead("c9", 1, AS_OF, nome="Eva") == 6
    assert store.upsert_lead("c1", 1, AS_OF, whatsapp="w9") == 1
    assert store.atualizar_tags_lead(2, ["lead_quente"], AS_OF) and not store.atualizar_tags_lead(99, [])
    # Leads were written, messages were not.
    assert files(store, "mensagens") == messages
    assert store.registrar_mensagem(6, "oi", as_of=AS_OF) == 7
    assert len(files(store, "mensagens")) == 2
    lead = {r.id: r for r in store.current().leads.collect()}
    assert (lead[6].nome, lead[6].tags, lead[1].whatsapp, lead[2].tags) == ("Eva", ["novo_lead"], "w9", ["lead_quente"])
    assert lead[6].updated_at == AS_OF and lead[3].updated_at != AS_OF
    for call in (lambda: store.registrar_mensagem(99, "x"), lambda: store.upsert_lead("c", 99)):
        with pytest.raises(IntegrityError):
            call()
        assert sizes(store)["mensagens"] == 7 and sizes(store)["leads"] == 6


def test_deleted_ids_are_not_given_again(tables, store):
    store.replace(tables.with_(mensagens=tables.mensagens.filter("id < 3")), AS_OF)
    assert store.registrar_mensagem(1, "a") == 7


def test_types_and_settings_are_checked(tables, store):
    wrong = tables.planos.withColumn("valor", F.col("valor").cast("double"))
    with pytest.raises(IntegrityError, match=r"planos.valor is double, not decimal\(10,2\)"):
        store.replace(tables.with_(planos=wrong))
    broken = tables.provedores.withColumn("config_bot", F.lit('{"modelo":'))
    with pytest.raises(IntegrityError, match="settings"):
        store.replace(tables.with_(provedores=broken))
    empty = tables.leads.withColumn("remotejid", F.lit(None).cast("string"))
    with pytest.raises(IntegrityError, match="required column leads.remotejid"):
        store.replace(tables.with_(leads=empty))
    assert sizes(store)["planos"] == 4


def test_a_moved_value_changes_the_digest(tables):
    swapped = tables.leads.select(
        *[F.col({"nome": "cpf_cnpj", "cpf_cnpj": "nome"}.get(c, c)).alias(c) for c in tables.leads.columns]
    )
    one = tables.with_(leads=tables.leads.filter("id = 3"))
    other = tables.with_(leads=swapped.filter("id = 3"))
    assert rows(one.leads.select("nome", "cpf_cnpj")) == [("Bia", None)]
    assert row_set(snapshots.contents(one)) != row_set(snapshots.contents(other))


def test_conversations_with_new_contacts(spark, tables, store, tmp_path):
    """Contact and first message in one batch, an unknown instance, a repeated batch, a later replay."""
    schema = "seq BIGINT, remotejid STRING, instancia STRING, mensagem STRING, is_bot BOOLEAN"
    arrived = spark.createDataFrame([
        (1, "c9", "alfa_w", "first", False), (2, "c9", "alfa_w", "second", True), (3, "c1", "alfa_w", "known", False),
        (4, "c9", "omega_w", "nowhere", False), (5, None, "alfa_w", "nobody", False), (6, "c9", "gama_w", "inactive", False),
    ], schema)
    unknown = store.record_conversation(arrived, AS_OF, ("s", 0))
    assert {r.seq for r in unknown.collect()} == {4, 5, 6}
    new = store.current().mensagens.filter("id > 6").orderBy("id")
    assert [(r.id, r.mensagem, r.lead_id) for r in new.collect()] == [(7, "first", 6), (8, "second", 6), (9, "known", 1)]
    before = {name: files(store, name) for name in ("leads", "mensagens", "contatos")}
    store.record_conversation(arrived, AS_OF, ("s", 0))
    assert {name: files(store, name) for name in before} == before
    # A micro-batch that was broken off before it was noted gives the same messages again, not more.
    store._count(**{"stream s": -1})
    store.record_conversation(arrived, AS_OF, ("s", 0))
    assert sizes(store)["mensagens"] == 9 and sizes(store)["leads"] == 6

    folder = str(tmp_path / "arrived")
    arrived.write.parquet(folder)
    stream = spark.readStream.schema(schema).parquet(folder)
    ingest.start_conversation(stream, store, str(tmp_path / "out"), AS_OF).awaitTermination()
    assert ingest.unidentified(spark, str(tmp_path / "out")).count() == 3
    now = store.current()
    provider = now.provedores.filter("id = 3").withColumn("ativo", F.lit(True))
    store.replace(now.with_(provedores=now.provedores.filter("id <> 3").unionByName(provider)), AS_OF)
    left = ingest.replay(store, str(tmp_path / "out"), AS_OF)
    assert {r.seq for r in left.collect()} == {4, 5}
    assert store.current().mensagens.filter("mensagem = 'inactive'").count() == 1


def test_newest_messages_with_orphans(spark, tables):
    orphans = tables.mensagens.filter("id = 1").crossJoin(spark.range(5).select(F.col("id").alias("k")))
    orphans = orphans.selectExpr(
        "100 + k AS id", "mensagem", "is_bot", "TIMESTAMP_NTZ'2030-01-01 00:00:00' AS created_at", "999L AS lead_id"
    )
    more = tables.with_(mensagens=tables.mensagens.unionByName(orphans))
    sql.register(more)
    expected = rows(spark.sql("SELECT * FROM vw_conversas LIMIT 4"))
    assert rows(views.newest_conversations(more, 4)) == expected and len(expected) == 4


def test_dashboards_agree_on_orphans(spark, tables):
    lost = tables.with_(provedores=tables.provedores.filter("id <> 1"))
    sql.register(lost)
    assert rows(dashboard(lost)) == rows(spark.sql("SELECT * FROM dashboard_resumo()"))
    assert rows(dashboard(lost, 1)) == rows(spark.sql("SELECT * FROM dashboard_resumo(1)"))
    assert rows(dashboard(lost))[0][0] == 5


def test_one_provider_counts_its_messages_only(tables):
    plan = dashboard(tables, 1)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan


def test_long_keys_are_not_cut(spark):
    big = spark.createDataFrame([(2 * 10**11 + 1,), (2 * 10**11 + 2,)], "c_custkey BIGINT").selectExpr(
        f"{raw.LEAD_COLUMNS['remotejid']} AS j", f"{raw.LEAD_COLUMNS['cpf_cnpj']} AS c",
        f"{raw.LEAD_COLUMNS['whatsapp']} AS w",
    )
    got = rows(big)
    assert len({r[0] for r in got}) == 2 and len({r[2] for r in got}) == 2 and str(2 * 10**11 + 1) in got[0][0]
    turns = spark.createDataFrame([(1, 1000), (2, 0), (1, 16_777_215)], "conv_id BIGINT, turn BIGINT")
    ids = [r[0] for r in turns.selectExpr(raw.TEXT_COLUMNS["id"]).collect()]
    assert len(set(ids)) == 3
    with pytest.raises(Exception, match="turn out of range"):
        spark.createDataFrame([(1, 1 << 24)], "conv_id BIGINT, turn BIGINT").selectExpr(raw.TEXT_COLUMNS["id"]).collect()


def test_json_in_sql_takes_the_last_of_repeated_keys(spark, tables):
    sql.register(tables)
    got = rows(spark.sql("SELECT id, from_json(config_bot, 'modelo STRING').modelo FROM provedores WHERE id = 4"))
    assert got == [(4, "m1")]


def test_declared_prices(tables):
    assert tables.planos.schema["valor"].dataType == S.PRICE and isinstance(rows(tables.planos.select("valor"))[0][0], Decimal)

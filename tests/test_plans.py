"""What the physical plans must look like, and behaviour under very uneven keys."""

import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from helpers import T0, row_set, rows
from funil import SalesTables
from funil.functions.scalars import moment
from funil.operators import integrity, lookups
from funil.operators.dashboard import dashboard
from funil.operators.skew import first_per_key, hot_keys
from funil.plans import reports, sql, views
from funil.settings import RECOMMENDED, shared_folder
from funil.sources import raw
from funil.sources.store import TableStore

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")  # whole paths in plans
    store = TableStore(spark, str(tmp_path_factory.mktemp("tables")))
    return store.replace(raw.sales_tables(spark, FOLDER), T0)


@pytest.fixture
def settings(spark):
    """Set session settings for one test."""
    old = {}

    def change(**values):
        for key, value in values.items():
            key = "spark.sql." + key.replace("__", ".")
            old.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df, table):
    return len(re.findall(rf"FileScan parquet[^\n]*/{table}\b", plan(df)))


def test_filters_and_columns_reach_the_scan(stored):
    single = plan(lookups.lead_by_contact(stored, "x"))
    assert "PushedFilters: [IsNotNull(remotejid), EqualTo(remotejid,x)" in single
    history = plan(lookups.history(stored.mensagens, 7))
    assert "EqualTo(lead_id,7)" in history
    assert "ReadSchema: struct<nome_plano:string,valor:decimal(10,2)>" in plan(reports.plans_between(stored, 1, 2))
    counted = plan(reports.counts_by(stored.mensagens, "lead_id", "n"))
    assert "ReadSchema: struct<lead_id:bigint>" in counted


def test_dashboard_reads_each_table_once(stored):
    assert [scans(dashboard(stored), t) for t in ("leads", "planos", "mensagens")] == [1, 1, 1]
    # One provider's leads are read once more, to leave other providers' messages out before counting.
    assert [scans(dashboard(stored, 1), t) for t in ("leads", "planos", "mensagens")] == [2, 1, 1]
    assert "mensagem" not in re.search(r"FileScan parquet \[([^\]]*)\][^\n]*/mensagens\b", plan(dashboard(stored)))[1]
    assert "CartesianProduct" not in plan(dashboard(stored)) and "NestedLoop" not in plan(dashboard(stored))


def test_views_read_each_table_once_and_do_not_sort(stored):
    for view in (views.leads_full, views.conversations, views.plans_full, views.providers_summary):
        df = view(stored)
        assert max(scans(df, t) for t in ("provedores", "planos", "leads", "mensagens")) == 1
        assert "rangepartitioning" not in plan(df)
        assert "CartesianProduct" not in plan(df) and "NestedLoop" not in plan(df)


def test_messages_are_shuffled_once_however_large_the_providers_are(stored, settings):
    settings(autoBroadcastJoinThreshold="-1")
    text = plan(views.conversations(stored))
    messages = [line for line in text.splitlines() if "hashpartitioning(provedor_id" in line]
    # Only leads and providers are exchanged by provider.
    assert len(messages) == 2
    assert text.index("hashpartitioning(lead_id") < text.index("hashpartitioning(provedor_id")


def test_top_k_does_not_sort_everything(stored):
    for df in (reports.newest_leads(stored), views.newest_conversations(stored, 20), lookups.history(stored.mensagens, 1)):
        assert "TakeOrderedAndProject" in plan(df)


def test_ordered_sql_views_sort_only_when_read_whole(spark, stored):
    sql.register(stored)
    newest = spark.sql("SELECT * FROM vw_conversas LIMIT 20")
    assert "TakeOrderedAndProject" in plan(newest)
    assert [r.msg_id for r in newest.collect()] == [
        r.msg_id for r in views.newest_conversations(stored, 20).collect()
    ]
    counted = spark.sql("SELECT remetente, count(*) FROM vw_conversas WHERE lead_id > 3 GROUP BY remetente")
    joined = spark.sql("SELECT v.msg_id, l.nome FROM vw_conversas v JOIN leads l ON l.id = v.lead_id")
    for df in (counted, joined):
        assert "rangepartitioning" not in plan(df)
    whole = spark.sql("SELECT * FROM vw_resumo_provedores").collect()
    assert [r.provedor_id for r in whole] == list(range(25))


def test_keys_of_sql_functions_reach_the_scan(spark, stored):
    sql.register(stored)
    found = plan(spark.sql("SELECT * FROM buscar_lead_por_whatsapp('x')"))
    assert "EqualTo(remotejid,x)" in found
    assert "EqualTo(lead_id,7)" in plan(spark.sql("SELECT * FROM historico_conversa(7)"))
    one = plan(spark.sql("SELECT * FROM dashboard_resumo(1)"))
    leads = re.search(r"FileScan parquet[^\n]*/leads\b[^\n]*", one)[0]
    assert "EqualTo(provedor_id,1)" in leads
    # Without a provider nothing is filtered but the join's own NULL checks.
    everything = plan(spark.sql("SELECT * FROM dashboard_resumo()"))
    assert "EqualTo" not in everything


def test_providers_are_broadcast_by_their_size(stored):
    assert "BroadcastHashJoin" in plan(views.plans_full(stored))


@pytest.fixture(scope="module")
def uneven(spark):
    """9,000 messages; lead 1 holds a third of them."""
    n = F.col("id")
    return spark.range(9000).select(
        n.alias("id"),
        F.concat(F.lit("m"), n.cast("string")).alias("mensagem"),
        (n % 2 == 0).alias("is_bot"),
        (moment(T0) + F.make_dt_interval(secs=(n * 7919 % 101).cast("decimal(18,6)"))).alias("created_at"),
        F.when(n % 3 == 0, 1).otherwise(n % 500 + 2).cast("bigint").alias("lead_id"),
    )


def test_hot_keys_are_few(uneven):
    assert rows(hot_keys(uneven, "lead_id", parts=10, floor=0)) == [(1,)]
    assert rows(hot_keys(uneven, "lead_id", parts=10, floor=5000)) == []
    # At most parts - 1 keys can each hold more than 1/parts of the rows.
    assert hot_keys(uneven, "lead_id", parts=600, floor=0).count() < 600


@pytest.mark.parametrize("newest", [False, True])
@pytest.mark.parametrize("limit", [1, 50, 2000])
def test_histories_with_a_hot_lead(uneven, limit, newest):
    whole = [r.asDict() for r in uneven.collect()]
    expected = set()
    leads = {}
    for m in whole:
        leads.setdefault(m["lead_id"], []).append((m["created_at"], m["id"]))
    for lead, times in leads.items():
        expected |= {(lead, i) for _, i in sorted(times, reverse=newest)[:limit]}
    for skew in ({}, dict(parts=10, floor=0, slices=4)):
        got = lookups.histories(uneven, limit, newest, **skew).select("lead_id", "msg_id")
        assert row_set(got) == expected


def test_a_hot_lead_is_sliced_before_its_rows_meet(uneven):
    text = plan(first_per_key(uneven, "lead_id", [F.asc("id")], 5, parts=10, floor=0))
    assert "hashpartitioning(lead_id" in text and "_slice" in text
    assert text.count("BroadcastHashJoin") == 2


def test_a_hot_lead_is_split_in_the_join(spark, uneven, settings):
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="10k",
        adaptive__skewJoin__skewedPartitionFactor="1.2",
        adaptive__advisoryPartitionSizeInBytes="10k",
        adaptive__coalescePartitions__enabled="false",
        shuffle__partitions="16",
    )
    leads = spark.range(600).select(
        F.col("id"), F.lit("n").alias("nome"), F.lit("w").alias("whatsapp"), (F.col("id") % 3).alias("provedor_id")
    )
    provedores = spark.range(3).select("id", F.lit("p").alias("nome_provedor"), F.lit("i").alias("instancia"))
    tables = SalesTables(provedores, None, leads, uneven.repartition(8))
    joined = views.conversations(tables)
    assert joined.count() == 9000
    frame = joined.select("msg_id", "mensagem", "nome_provedor")
    frame.collect()
    assert "skew=true" in plan(frame)


def test_integrity_reports_group_before_they_join(stored, settings):
    settings(autoBroadcastJoinThreshold="-1")
    text = plan(integrity.orphans(stored.mensagens, "lead_id", stored.leads, "mensagens"))
    assert text.index("LeftAnti") < text.index("partial_count")
    # The counts leave the aggregation partitioned for the join: one exchange per side.
    assert text.count("Exchange hashpartitioning") == 2


def test_settings_and_shared_folder(spark):
    assert RECOMMENDED["spark.sql.adaptive.skewJoin.enabled"] == "true"
    folder = shared_folder(spark)
    assert folder and not folder.endswith("/")


def test_a_cluster_must_name_its_shared_folder():
    def session(folder, master):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda f: None)
        conf = SimpleNamespace(get=lambda key, default=None: folder)
        return SimpleNamespace(sparkContext=context, conf=conf)

    assert shared_folder(session("hdfs:///shared/", "yarn")) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session(None, "yarn"))
    assert shared_folder(session(None, "local[8]"))

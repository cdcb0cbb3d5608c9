from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import AS_OF, T0, row_set, rows
from funil.operators import integrity
from funil.sources import raw
from funil.sources.store import TableStore


def test_sound_tables_give_no_rows(tables):
    integrity.require_sound(tables)
    for report in (integrity.primary_keys(tables), integrity.not_null(tables), integrity.foreign_keys(tables)):
        assert rows(report) == []
    assert rows(integrity.shared_contacts(tables.leads)) == []


def test_each_fault_is_reported(tables):
    leads = tables.leads.unionByName(tables.leads.filter("id = 1"))
    assert rows(integrity.duplicate_keys(leads, "leads")) == [("leads", 1, 2)]
    assert rows(integrity.shared_contacts(leads)) == [("c1", 1, 2, 1)]
    nulled = tables.mensagens.withColumn("mensagem", F.when(F.col("id") > 4, F.col("mensagem")))
    assert rows(integrity.null_counts(nulled, "mensagens")) == [("mensagens", "mensagem", 4)]
    orphaned = tables.mensagens.withColumn("lead_id", F.when(F.col("id") < 3, 77).otherwise(1).cast("bigint"))
    assert rows(integrity.orphans(orphaned, "lead_id", tables.leads, "mensagens")) == [
        ("mensagens", "lead_id", 77, 2)
    ]


def test_config_problems(spark):
    df = spark.createDataFrame(
        [(1, '{"modelo":"m"}'), (2, "{bad"), (3, '{"modelo":1,"modelo":2}'), (4, '{"x":1}'), (5, None)],
        "id bigint, config_bot string",
    )
    assert row_set(integrity.config_problems(df, ["modelo"])) == {
        (2, True, False, None), (3, False, True, ""), (4, False, False, "modelo"),
    }


def test_lost_casts(spark):
    df = spark.createDataFrame([("1.50",), ("x",), (None,), ("123456789",), ("7",)], "v string")
    assert rows(integrity.lost_casts(df, "v")) == [(4, 2)]


def test_a_failing_load_leaves_the_old_one(spark, tables, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.replace(tables, T0)
    with pytest.raises(integrity.IntegrityError, match="foreign key"):
        store.replace(tables.with_(leads=tables.leads.filter("id <> 1")), AS_OF)
    assert store.current().leads.count() == 5


def test_the_latest_load_is_current(spark, tables, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.replace(tables, AS_OF)
    store.replace(tables.with_(mensagens=tables.mensagens.filter("id < 3")), T0)
    assert store.current().mensagens.count() == 2


def test_append_keeps_parents_and_numbers_on(spark, tables, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.replace(tables, T0)
    store.append_seed(tables, AS_OF)
    now = store.current()
    assert {name: df.count() for name, df in now.by_name().items()} == {
        "provedores": 8, "planos": 8, "leads": 10, "mensagens": 12,
    }
    integrity.require_sound(now)
    copied = now.planos.filter("id > 4").orderBy("id").select("id", "nome_plano", "valor", "provedor_id")
    assert rows(copied)[:2] == [(5, "Quartzo", Decimal("64.25"), 1), (6, "Safira", Decimal("188.75"), 1)]


def test_appended_rows_are_checked(spark, tables, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.replace(tables, T0)
    orphan = spark.createDataFrame([("oi", 999)], "mensagem string, lead_id bigint")
    with pytest.raises(integrity.IntegrityError, match="foreign key lead_id"):
        store.append("mensagens", orphan, ["mensagem"], AS_OF)
    nameless = spark.createDataFrame([(None, 1)], "mensagem string, lead_id bigint")
    with pytest.raises(integrity.IntegrityError, match="required column"):
        store.append("mensagens", nameless, ["mensagem"], AS_OF)
    assert store.current().mensagens.count() == 6


def test_clustered_files_do_not_overlap(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables = raw.sales_tables(spark, "/root/testdata/sf0.001")
        loaded = store.replace(tables, T0, cluster=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = (
        loaded.mensagens.groupBy("_metadata.file_path")
        .agg(F.min("lead_id").alias("low"), F.max("lead_id").alias("high"))
        .orderBy("low")
        .collect()
    )
    assert len(files) > 2
    assert all(a.high <= b.low for a, b in zip(files, files[1:]))
    assert row_set(loaded.leads.select("id", "nome")) == row_set(tables.leads.select("id", "nome"))

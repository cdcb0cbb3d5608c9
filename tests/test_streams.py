"""Streams over several micro-batches end in the state of one batch over everything."""

import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import AS_OF, row_set, rows
from funil.operators import changes
from funil.sources import raw
from funil.sources.store import TableStore
from funil.streaming import ingest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return raw.sales_tables(spark, FOLDER)


@pytest.fixture(scope="module")
def pieces(spark, tmp_path_factory):
    """The events in three files of rising ``event_id``, read one file per micro-batch."""
    folder = str(tmp_path_factory.mktemp("events"))
    events = raw.scan(spark, FOLDER, "events")
    for low, high in ((0, 300), (300, 500), (500, 10**9)):
        part = events.filter((F.col("event_id") >= low) & (F.col("event_id") < high))
        part.coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)  # files are read in order of their modification time
    return folder


def stream(spark, folder):
    return spark.readStream.schema(raw.RAW["events"]).option("maxFilesPerTrigger", 1).parquet(folder)


def test_register(spark, tables, pieces, tmp_path):
    out = str(tmp_path)
    query = ingest.start_register(raw.message_batch(stream(spark, pieces)), tables, out, AS_OF)
    query.awaitTermination()
    after = ingest.messages_after(tables, out, AS_OF)
    batch = raw.message_batch(raw.scan(spark, FOLDER, "events"))
    expected, rejected, _ = changes.append_messages(tables, batch, AS_OF)
    assert row_set(after.mensagens) == row_set(expected.mensagens)
    assert row_set(after.leads) == row_set(expected.leads)
    unknown = spark.read.parquet(f"{out}/rejected_messages").select(rejected.columns)
    assert row_set(unknown) == row_set(rejected)
    assert spark.read.parquet(f"{out}/ranges").count() == 4


def test_register_again_changes_nothing(spark, tables, pieces, tmp_path):
    """A run that lost its progress repeats its micro-batches into the same folders."""
    out = str(tmp_path)
    ingest.start_register(raw.message_batch(stream(spark, pieces)), tables, out, AS_OF).awaitTermination()
    first = row_set(ingest.messages_after(tables, out, AS_OF).mensagens)
    replay = raw.message_batch(stream(spark, pieces))
    (tmp_path / "progress").rename(tmp_path / "lost")
    ingest.start_register(replay, tables, out, AS_OF).awaitTermination()
    assert row_set(ingest.messages_after(tables, out, AS_OF).mensagens) == first


def test_upsert(spark, tables, pieces, tmp_path):
    out = str(tmp_path)
    ingest.start_upserts(raw.contact_batch(stream(spark, pieces)), out).awaitTermination()
    after = ingest.leads_after(tables, out, AS_OF).leads
    batch = raw.contact_batch(raw.scan(spark, FOLDER, "events"))
    assert row_set(after) == row_set(changes.upsert_leads(tables, batch, AS_OF).tables.leads)


def test_logs_become_the_new_tables(spark, tables, pieces, tmp_path):
    store = TableStore(spark, str(tmp_path / "tables"))
    store.replace(tables, AS_OF)
    out = str(tmp_path / "stream")
    base = store.current()
    ingest.start_register(raw.message_batch(stream(spark, pieces)), base, out, AS_OF).awaitTermination()
    ingest.start_upserts(raw.contact_batch(stream(spark, pieces)), out).awaitTermination()
    before = base.mensagens.count(), base.leads.count()
    merged = store.replace(
        ingest.leads_after(ingest.messages_after(base, out, AS_OF), out, AS_OF), AS_OF + timedelta(hours=1)
    )
    assert merged.mensagens.count() > before[0]
    assert merged.leads.count() > before[1]
    assert store.current().leads.count() == merged.leads.count()


def counted(tables, batch):
    leads = tables.leads.select(F.col("id").alias("lead_id"), "provedor_id")
    return row_set(batch.join(leads, "lead_id").groupBy("provedor_id", "is_bot").count())


def test_counts(spark, tables, pieces, tmp_path):
    out = str(tmp_path)
    query = ingest.start_counts(raw.message_batch(stream(spark, pieces)), tables, out)
    query.awaitTermination()
    assert row_set(ingest.running_counts(spark, out)) == counted(tables, raw.message_batch(raw.scan(spark, FOLDER, "events")))
    states = [s["operatorName"] for s in query.lastProgress["stateOperators"]]
    assert "stateStoreSave" in states and "dedupeWithinWatermark" in states


def test_counts_go_on_after_a_restart(spark, tables, tmp_path):
    """Two runs on one folder, the second over files that hold messages of the first again, and one that is too late."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    events = raw.scan(spark, FOLDER, "events").cache()
    first, last = events.filter("event_id < 400"), events.filter("event_id >= 300")
    first.coalesce(1).write.mode("append").parquet(source)
    ingest.start_counts(raw.message_batch(stream(spark, source)), tables, out, "3650 days").awaitTermination()
    assert row_set(ingest.running_counts(spark, out)) == counted(tables, raw.message_batch(first))
    last.coalesce(1).write.mode("append").parquet(source)
    ingest.start_counts(raw.message_batch(stream(spark, source)), tables, out, "3650 days").awaitTermination()
    assert row_set(ingest.running_counts(spark, out)) == counted(tables, raw.message_batch(events))
    late = events.limit(1).withColumn("event_id", F.lit(10**6).cast("bigint")).withColumn("ts", F.lit("1990-01-01").cast("timestamp_ntz"))
    late.write.mode("append").parquet(source)
    ingest.start_counts(raw.message_batch(stream(spark, source)), tables, out, "3650 days").awaitTermination()
    assert row_set(ingest.running_counts(spark, out)) == counted(tables, raw.message_batch(events))


def test_identify_in_the_plan(spark, tables, pieces, tmp_path):
    out = str(tmp_path)
    query = ingest.start_identify(raw.arrivals(stream(spark, pieces)), tables, out)
    query.awaitTermination()
    plan = query._jsq.streamingQuery().lastExecution().executedPlan().toString()
    assert "Join" in plan and "StateStore" not in plan
    batches = len(query.recentProgress)
    before = row_set(ingest.identified(spark, out))
    ingest.start_identify(raw.arrivals(stream(spark, pieces)), tables, out).awaitTermination()  # nothing is new
    assert row_set(ingest.identified(spark, out)) == before and batches >= 3


def test_identify(spark, tables, pieces, tmp_path):
    out = str(tmp_path)
    ingest.start_identify(raw.arrivals(stream(spark, pieces)), tables, out).awaitTermination()
    expected = ingest.identify(raw.arrivals(raw.scan(spark, FOLDER, "events")), tables)
    got = ingest.identified(spark, out).select(expected.columns)
    assert row_set(got) == row_set(expected)
    assert rows(expected.filter("modelo IS NULL").select("provedor_id").distinct()) in ([], [(22,)], [(23,)])

from datetime import datetime, timedelta

import pytest

from helpers import AS_OF, T0, row_set, rows
from funil.sources import counts, snapshots
from funil.sources.snapshots import SnapshotError, SnapshotStore
from funil.sources.store import TableStore


@pytest.fixture
def saved(spark, tables, tmp_path):
    return SnapshotStore(spark, str(tmp_path / "snapshots"))


def test_round_trip(tables, saved):
    name = saved.write(tables, T0)
    assert name == "regular_2024-05-01_12-00-00"
    back = saved.read(name)
    for table, df in tables.by_name().items():
        assert row_set(back.by_name()[table]) == row_set(df)
    assert rows(saved.verify(name).select("same_content", "same_size").distinct()) == [(True, True)]


def test_latest_and_listing(tables, saved):
    first = saved.write(tables, T0)
    second = saved.write(tables, T0 + timedelta(days=1))
    assert saved.latest() == second
    listed = snapshots.newest_first(saved.snapshots()).select("snapshot").collect()
    assert [r[0] for r in listed] == [second, first]
    assert rows(snapshots.total_size(saved.snapshots()))[0][0] == 2


def test_nothing_to_choose_from(tables, saved):
    saved.write(tables, T0)
    with pytest.raises(SnapshotError):
        saved.latest("pre-restore")
    with pytest.raises(SnapshotError):
        saved.read("regular_2000-01-01_00-00-00")


def test_too_small_is_not_committed(tables, saved):
    saved.write(tables, T0)
    with pytest.raises(SnapshotError, match="smaller"):
        saved.write(tables, AS_OF, min_bytes=10**9)
    assert saved.snapshots().count() == 1


def test_changed_files_are_found(spark, tables, saved, tmp_path):
    name = saved.write(tables, T0)
    tables.planos.filter("id = 1").write.mode("append").parquet(f"{saved.root}/{name}/planos")
    got = {r.table_name: (r.same_content, r.same_size) for r in saved.verify(name).collect()}
    assert got["planos"] == (False, False)
    assert got["leads"] == (True, True)
    store = TableStore(spark, str(tmp_path / "tables"))
    store.replace(tables, T0)
    with pytest.raises(SnapshotError, match="does not match"):
        saved.restore(store, name, AS_OF)


def test_a_repeated_row_changes_the_digest(tables):
    def digest(df):
        twice = tables.with_(leads=df)
        return rows(snapshots.contents(twice).filter("table_name = 'leads'"))
    doubled = tables.leads.unionByName(tables.leads.filter("id = 1")).unionByName(tables.leads.filter("id = 1"))
    assert digest(doubled)[0][2] != digest(tables.leads)[0][2]
    assert digest(tables.leads.repartition(3)) == digest(tables.leads)


def test_restore_saves_the_current_state_first(spark, tables, saved, tmp_path):
    store = TableStore(spark, str(tmp_path / "tables"))
    store.replace(tables, T0)
    name = saved.write(store.current(), T0)
    store.append("planos", tables.planos.drop("id"), ["nome_plano"], AS_OF)
    diff = row_set(saved.restore(store, name, AS_OF))
    assert diff == {("provedores", 4, 4, 0), ("planos", 8, 4, -4), ("leads", 5, 5, 0), ("mensagens", 6, 6, 0)}
    assert store.current().planos.count() == 4
    safety = saved.latest("pre-restore")
    assert saved.read(safety).planos.count() == 8
    # The safety copy is not offered as a regular snapshot.
    assert saved.latest() == name
    saved.restore(store, name, AS_OF + timedelta(hours=1), safety=False)
    assert saved.snapshots().filter("kind = 'pre-restore'").count() == 1


@pytest.mark.parametrize("age,is_expired", [
    (timedelta(days=7), False),
    (timedelta(days=7, hours=23, minutes=59, seconds=59), False),
    (timedelta(days=8), True),
    (timedelta(days=30), True),
    (timedelta(0), False),
])
def test_retention_counts_whole_days(spark, age, is_expired):
    now = datetime(2024, 6, 1, 3, 0)
    history = spark.createDataFrame([("s", now - age)], "snapshot string, taken_at timestamp_ntz")
    assert (snapshots.expired(history, now).count() == 1) is is_expired


def test_counts(tables):
    assert rows(counts.count_columns(tables, "total_")) == [(4, 4, 5, 6)]
    assert rows(counts.count_text(tables)) == [("4 provedores, 4 planos, 5 leads, 6 mensagens",)]
    assert rows(counts.count_manifest(tables)) == [('{"provedores":4,"planos":4,"leads":5,"mensagens":6}',)]
    empty = tables.with_(leads=tables.leads.limit(0))
    assert rows(counts.count_columns(empty)) == [(4, 4, 0, 6)]

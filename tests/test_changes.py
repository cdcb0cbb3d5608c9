"""Changes: a batch leaves the state its calls would leave one after the other."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import AS_OF, T0, row_set, rows
from funil import schema as S
from funil.operators import changes
from funil.operators.numbering import assign_ids

CONTACT = (
    "seq bigint, remotejid string, provedor_id bigint, nome string, cpf_cnpj string, "
    "endereco_instalacao string, whatsapp string, tags array<string>"
)
LEAD = [f.name for f in S.LEADS]


def one_by_one(leads, calls, providers):
    """The calls applied in order to a list of lead dicts."""
    leads = [dict(lead) for lead in leads]
    for call in sorted(calls, key=lambda c: c["seq"]):
        if call["provedor_id"] not in providers:
            continue
        same = [x for x in leads if (x["remotejid"], x["provedor_id"]) == (call["remotejid"], call["provedor_id"])]
        given = {c: call[c] for c in changes.CONTACT_FIELDS if call[c] is not None}
        if same:
            min(same, key=lambda x: x["id"]).update(given, updated_at=AS_OF)
        else:
            new = dict.fromkeys(LEAD)
            new.update({"tags": ["novo_lead"], "created_at": AS_OF, "updated_at": AS_OF, **given})
            new.update(
                id=max([x["id"] for x in leads], default=0) + 1,
                remotejid=call["remotejid"], provedor_id=call["provedor_id"],
            )
            leads.append(new)
    return leads


def as_set(leads):
    return {tuple(tuple(v) if isinstance(v, list) else v for v in (x[c] for c in LEAD)) for x in leads}


def random_calls(rng, n):
    def maybe(value):
        return value if rng.random() < 0.4 else None
    return [
        dict(
            seq=i, remotejid=rng.choice(["c1", "c2", "c3", "c9", "c10"]), provedor_id=rng.choice([1, 2, 3, 99]),
            nome=maybe(f"n{i}"), cpf_cnpj=maybe(f"d{i}"), endereco_instalacao=maybe(f"e{i}"),
            whatsapp=maybe(f"w{i}"), tags=maybe(rng.choice([[], ["x"], ["lead_quente", f"t{i}"]])),
        )
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", range(4))
def test_upsert_equals_calls_one_by_one(spark, tables, seed):
    rng = random.Random(seed)
    # A second lead for one contact and provider: only the lowest id may change.
    twin = tables.leads.filter("id = 2").withColumn("id", F.lit(50).cast("bigint"))
    start = tables.with_(leads=tables.leads.unionByName(twin))
    calls = random_calls(rng, 40)
    batch = spark.createDataFrame([tuple(c.values()) for c in calls], CONTACT).repartition(5)
    result = changes.upsert_leads(start, batch, AS_OF)
    expected = one_by_one([r.asDict() for r in start.leads.collect()], calls, {1, 2, 3, 4})
    assert row_set(result.tables.leads) == as_set(expected)
    assert {r.seq for r in result.rejected.collect()} == {c["seq"] for c in calls if c["provedor_id"] == 99}
    ids = {(x["remotejid"], x["provedor_id"]): x["id"] for x in sorted(expected, key=lambda x: -x["id"])}
    assert row_set(result.ids) == {
        (c["seq"], ids[c["remotejid"], c["provedor_id"]]) for c in calls if c["provedor_id"] != 99
    }


def test_folding_patches_again_changes_nothing(spark, tables):
    calls = random_calls(random.Random(7), 60)
    batch = spark.createDataFrame([tuple(c.values()) for c in calls], CONTACT)
    parts = [changes.fold_contacts(batch.filter(part)) for part in ("seq < 20", "seq BETWEEN 20 AND 39", "seq >= 40")]
    patches = parts[0].unionByName(parts[1]).unionByName(parts[2])
    whole = changes.upsert_leads(tables, batch, AS_OF).tables.leads
    # A patch's seq is its first call's, so later patches keep their place.
    tagged = [p.withColumn("seq", F.struct(F.lit(i).alias("part"), "seq")) for i, p in enumerate(parts)]
    folded = changes.upsert_leads(
        tables, tagged[0].unionByName(tagged[1]).unionByName(tagged[2]), AS_OF
    ).tables.leads
    assert patches.count() > 0
    assert row_set(folded) == row_set(whole)


def test_calls_without_a_key_are_rejected(spark, tables):
    batch = spark.createDataFrame([
        (1, None, 1, "x", None, None, None, None), (2, "c7", None, "y", None, None, None, None),
        (3, "c7", 1, "z", None, None, None, None),
    ], CONTACT)
    result = changes.upsert_leads(tables, batch, AS_OF)
    assert row_set(result.rejected.select("seq")) == {(1,), (2,)}
    assert result.tables.leads.count() == 6
    partial = spark.createDataFrame(
        [(1, None, "oi", True), (2, 2, None, True), (3, 2, "oi", None), (4, 1, "oi", True)],
        "seq bigint, lead_id bigint, mensagem string, is_bot boolean",
    )
    sent = changes.append_messages(tables, partial, AS_OF)
    assert row_set(sent.rejected.select("seq")) == {(1,), (2,), (3,)}
    # A rejected call does not touch its lead either.
    assert {r.id for r in sent.tables.leads.collect() if r.updated_at == AS_OF} == {1}


def test_null_tags_of_an_existing_lead_stay_null(spark, tables):
    batch = spark.createDataFrame([(1, "c2", 1, "Novo", None, None, None, None)], CONTACT)
    lead = changes.upsert_leads(tables, batch, AS_OF).tables.leads.filter("id = 2").first()
    assert (lead.nome, lead.tags, lead.updated_at) == ("Novo", None, AS_OF)


def test_append_messages(spark, tables):
    batch = spark.createDataFrame(
        [(2, 2, "segunda"), (1, 1, "primeira"), (3, 999, "perdida")], "seq bigint, lead_id bigint, mensagem string"
    )
    after, rejected, ids = changes.append_messages(tables, batch, AS_OF)
    assert row_set(ids) == {(1, 7), (2, 8)}
    new = after.mensagens.filter("id > 6").orderBy("id")
    assert rows(new) == [(7, "primeira", False, AS_OF, 1), (8, "segunda", False, AS_OF, 2)]
    assert after.mensagens.count() == 8
    assert rows(rejected.select("mensagem")) == [("perdida",)]
    touched = {r.id for r in after.leads.collect() if r.updated_at == AS_OF}
    assert touched == {1, 2}
    assert after.leads.count() == 5


def test_one_call_has_one_time(spark, tables):
    batch = spark.createDataFrame([(1, 1, "a"), (2, 4, "b")], "seq bigint, lead_id bigint, mensagem string")
    after = changes.append_messages(tables, batch).tables
    sent = {r.created_at for r in after.mensagens.filter("id > 6").collect()}
    touched = {r.updated_at for r in after.leads.filter("id IN (1, 4)").collect()}
    assert len(sent) == 1 and sent == touched


def test_update_tags(spark, tables):
    batch = spark.createDataFrame(
        [(1, 1, ["a"]), (2, 1, None), (3, 2, ["x"]), (4, 2, ["b", "c"]), (5, 999, ["z"])],
        "seq bigint, lead_id bigint, tags array<string>",
    )
    got = {r.id: (r.tags, r.updated_at) for r in changes.update_tags(tables.leads, batch, AS_OF).collect()}
    assert got[1] == (None, AS_OF)
    assert got[2] == (["b", "c"], AS_OF)
    assert got[3][0] == [] and got[3][1] != AS_OF
    assert len(got) == 5


def test_update_rows_touches_them(tables):
    lowered = changes.update_rows(tables.planos, F.col("provedor_id") == 1, {"ativo": F.lit(True)}, AS_OF)
    got = {r.id: (r.ativo, r.updated_at) for r in lowered.collect()}
    # Also the rows that were active before.
    assert got == {1: (True, AS_OF), 2: (True, AS_OF), 3: (True, AS_OF), 4: (False, T0)}
    assert lowered.columns == tables.planos.columns
    shouted = changes.update_rows(tables.mensagens, F.col("id") == 1, {"mensagem": F.upper("mensagem")}, AS_OF)
    assert shouted.columns == tables.mensagens.columns
    assert shouted.filter("id = 1").first().mensagem == "OI"


def test_delete_providers_cascades(spark, tables):
    after = changes.delete_providers(tables, spark.createDataFrame([(1,)], "id bigint"))
    ids = {name: {r.id for r in df.collect()} for name, df in after.by_name().items()}
    assert ids == {"provedores": {2, 3, 4}, "planos": {4}, "leads": {4, 5}, "mensagens": {5, 6}}
    assert [df.schema for df in after.by_name().values()] == [df.schema for df in tables.by_name().values()]


def test_defaults_fill_omitted_columns_only(spark, tables):
    given = spark.createDataFrame(
        [(None, "Nova", "nova_w", "k")],
        "plano string, nome_provedor string, instancia string, apikey string",
    )
    row = changes.apply_defaults(given, "provedores", AS_OF).first().asDict()
    assert row == dict(
        nome_provedor="Nova", instancia="nova_w", apikey="k", config_bot=None, plano=None, ativo=True,
        created_at=AS_OF, updated_at=AS_OF,
    )
    assert changes.apply_defaults(given.drop("plano"), "provedores").first().plano == "basico"


def test_insert_into_an_empty_table(spark, tables):
    rows_in = spark.createDataFrame([(1, "x", 1), (2, "y", 1)], "n int, mensagem string, lead_id bigint")
    out = changes.insert_rows(tables.mensagens.limit(0), rows_in, "mensagens", ["n"], T0)
    assert rows(out.orderBy("id")) == [(1, "x", False, T0, 1), (2, "y", False, T0, 1)]


@pytest.mark.parametrize("coalesce", ["true", "false"])
@pytest.mark.parametrize("n", [0, 1, 20000])
def test_ids_are_dense_and_ordered(spark, n, coalesce):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        data = spark.range(n).withColumn("key", F.xxhash64("id")).repartition(7)
        numbered = assign_ids(data.drop("id"), ["key"], 100).orderBy("id").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r.id for r in numbered] == list(range(101, 101 + n))
    assert [r.key for r in numbered] == sorted(r.key for r in numbered)

"""The four tables at rest, as plain Parquet folders that a batch changes in part.

Leads lie in hash buckets of their id, folders named ``bucket=k``.  A batch of changes reads
the buckets of its leads and no others, and writes them anew by dynamic partition
overwrite: what it costs follows the batch, not the table.  ``contatos`` finds the leads of a contact: it
holds their keys in buckets of the contact.  Messages are only added, a folder ``lote=...`` per
batch, which the same batch made again overwrites.

What is new is staged and checked before any table is touched, and ids are set aside before they are
used, so a batch that fails on the way leaves a gap in the ids at most and can be made again.
A store has one writer at a time.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from funil import schema as S
from funil.operators import changes
from funil.operators.integrity import IntegrityError, orphans, require_intact, require_sound, require_types
from funil.operators.numbering import assign_ids
from funil.tables import SalesTables

BUCKETS = 64  # of a new store; about one per 128 MB of leads
CONTACTS = "remotejid STRING, provedor_id BIGINT, id BIGINT, bucket INT"
COUNTERS = "name STRING, value BIGINT"

# Sort keys of a clustered table: what lookups filter by, then enough columns to
# spread one very frequent value over several files.
CLUSTERING = {
    "provedores": ["instancia"],
    "planos": ["provedor_id", "valor", "id"],
    "leads": ["remotejid", "id"],
    "mensagens": ["lead_id", "created_at", "id"],
}


class StoreError(RuntimeError):
    """A store that cannot be read or changed as asked."""


def read_tables(spark: SparkSession, folder: str) -> SalesTables:
    """Scan the four tables of one folder with their declared schemas."""
    return SalesTables(**{
        name: spark.read.schema(schema).parquet(f"{folder}/{name}") for name, schema in S.SCHEMAS.items()
    })


def clustered(df: DataFrame, table: str) -> DataFrame:
    """Rows placed so that a lookup skips the files and row groups of other keys."""
    keys = CLUSTERING[table]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


class TableStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        """``buckets`` counts for a store that is loaded for the first time; later its own number does."""
        self.spark = spark
        self.root = root.rstrip("/")
        self._new_buckets, self._buckets = buckets, None

    # Reading.

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _files(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def counters(self) -> dict[str, int]:
        """The last id of every table, the number of buckets, and the last micro-batch of each stream."""
        if not self._files().exists(self._path("contadores/_SUCCESS")):
            raise StoreError(f"nothing has been loaded under {self.root}")
        rows = self.spark.read.schema(COUNTERS).parquet(f"{self.root}/contadores").collect()  # few rows
        return {r.name: r.value for r in rows}

    def _count(self, **changed: int) -> None:
        before = self.counters() if self._files().exists(self._path("contadores/_SUCCESS")) else {}
        rows = self.spark.createDataFrame(sorted({**before, **changed}.items()), COUNTERS)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/contadores")

    def _read(self, name: str) -> DataFrame:
        folders = {"leads": [StructField("bucket", IntegerType())], "mensagens": [StructField("lote", StringType())]}
        schema = StructType([*S.SCHEMAS[name].fields, *folders.get(name, [])])
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def current(self) -> SalesTables:
        """The tables as they are now.  A change removes files it replaces, so read them anew after it."""
        self.counters()
        return SalesTables(**{name: self._read(name).select(*schema.names) for name, schema in S.SCHEMAS.items()})

    def _bucket(self, key: str) -> Column:
        if self._buckets is None:
            self._buckets = self.counters()["buckets"]
        return F.pmod(F.xxhash64(key), F.lit(self._buckets)).cast("int")

    def _numbers(self, rows: DataFrame, key: str) -> list[int]:
        """The buckets that some keys are in: no more than there are."""
        return [r[0] for r in rows.select(self._bucket(key)).distinct().collect() if r[0] is not None]

    def _leads_in(self, buckets: list[int]) -> DataFrame:
        return self._read("leads").where(F.col("bucket").isin(buckets)).select(*S.LEADS.names)

    # Writing.

    def _stage(self, rows: dict[str, DataFrame], check=None) -> tuple[dict[str, DataFrame], dict[str, int]]:
        """Write rows aside and check them there: types, required columns, settings, and what ``check`` does.

        Gives them as read again, and the highest id of each table.
        """
        folder, staged, last, nulls = f"{self.root}/staged/{uuid.uuid4().hex}", {}, {}, {}
        for name, df in rows.items():
            require_types(df, name)
        for name, df in rows.items():
            seen, required = Observation(), S.required_columns(name)
            counted = [F.count_if(F.col(c).isNull()).alias(c) for c in required]
            df.observe(seen, F.max("id").alias("_last"), *counted).write.parquet(f"{folder}/{name}")
            found = seen.get
            nulls.update({f"{name}.{c}": found[c] for c in required if found[c]})
            last[name] = found["_last"] or 0
            staged[name] = self.spark.read.schema(S.SCHEMAS[name]).parquet(f"{folder}/{name}")
        try:
            if nulls:
                raise IntegrityError(f"violated: required column {', '.join(sorted(nulls))}")
            if "provedores" in staged:
                require_intact(staged["provedores"])
            if check:
                check(staged)
        except BaseException:
            self._unstage()
            raise
        return staged, last

    def _unstage(self) -> None:
        self._files().delete(self._path("staged"), True)

    def _put(self, df: DataFrame, name: str, mode: str, overwrite: str = "dynamic", by: list[str] | None = None) -> None:
        """Write a table, or the buckets and batches that ``df`` has rows of."""
        writer = df.write.mode(mode).option("partitionOverwriteMode", overwrite)
        (writer.partitionBy(*by) if by else writer).parquet(f"{self.root}/{name}")

    def _put_leads(self, leads: DataFrame, mode: str, overwrite: str = "dynamic") -> None:
        placed = leads.withColumn("bucket", self._bucket("id")).repartition("bucket")
        self._put(placed.sortWithinPartitions("bucket", *CLUSTERING["leads"]), "leads", mode, overwrite, ["bucket"])

    def _put_contacts(self, leads: DataFrame, mode: str, overwrite: str = "dynamic") -> None:
        keys = leads.select("remotejid", "provedor_id", "id", self._bucket("remotejid").alias("bucket"))
        placed = keys.repartition("bucket").sortWithinPartitions("bucket", "remotejid", "id")
        self._put(placed, "contatos", mode, overwrite, ["bucket"])

    def _put_messages(self, messages: DataFrame, lote: str, overwrite: str = "dynamic", cluster: bool = True) -> None:
        rows = clustered(messages, "mensagens") if cluster else messages
        self._put(rows.withColumn("lote", F.lit(lote)), "mensagens", "overwrite", overwrite, ["lote"])

    # Loads.

    def replace(self, tables: SalesTables, loaded_at: datetime | None = None, cluster: bool = True) -> SalesTables:
        """Load all four tables anew; nothing changes if a constraint is violated.

        ``cluster`` sorts the tables by their lookup keys, which costs a shuffle
        once and takes the place of indexes.  Ids given out before are not given again.
        """
        staged, last = self._stage(tables.by_name(), lambda new: require_sound(SalesTables(**new)))
        loaded = self._files().exists(self._path("contadores/_SUCCESS"))
        before = self.counters() if loaded else {"buckets": self._new_buckets}
        self._count(**{**before, **{n: max(last[n], before.get(n, 0)) for n in S.SCHEMAS}})
        for name in ("provedores", "planos"):
            self._put(clustered(staged[name], name) if cluster else staged[name], name, "overwrite", "static")
        self._put_leads(staged["leads"], "overwrite", "static")
        self._put_contacts(staged["leads"], "overwrite", "static")
        self._put_messages(staged["mensagens"], "carga", "static", cluster)
        self._unstage()
        return self.current()

    def append(self, table: str, rows: DataFrame, order: list[str], as_of=None) -> SalesTables:
        """Add rows without ids to a current table; omitted columns take their defaults.

        Ids continue in ``order``; only the new rows are checked and written.
        """
        return self._add({table: changes.apply_defaults(
            assign_ids(rows, order, self.counters()[table]), table, as_of
        )})

    def append_seed(self, seed: SalesTables, as_of=None) -> SalesTables:
        """Add the seed's rows again under new ids, all or none; their parent ids stay as given."""
        last = self.counters()
        return self._add({
            name: changes.apply_defaults(
                assign_ids(df.withColumnRenamed("id", "_seed_id"), ["_seed_id"], last[name]), name, as_of
            )
            for name, df in seed.by_name().items()
        })

    def _add(self, new: dict[str, DataFrame]) -> SalesTables:
        current = self.current().by_name()

        def parents(staged: dict[str, DataFrame]) -> None:
            for child, key, parent in S.FOREIGN_KEYS:
                if child not in staged:
                    continue
                there = current[parent].select("id")
                there = there.unionByName(staged[parent].select("id")) if parent in staged else there
                if not orphans(staged[child], key, there, child).isEmpty():
                    raise IntegrityError(f"violated: foreign key {key}")

        staged, last = self._stage(new, parents)
        self._count(**{n: max(k, self.counters()[n]) for n, k in last.items()})
        for name, rows in staged.items():
            if name == "leads":
                self._put_leads(rows, "append")
                self._put_contacts(rows, "append")
            elif name == "mensagens":
                self._put_messages(rows, uuid.uuid4().hex)
            else:
                self._put(clustered(rows, name), name, "append")
        self._unstage()
        return self.current()

    # Saved changes: whole batches.

    def record_messages(self, batch: DataFrame, as_of: datetime | None = None) -> changes.Changed:
        """Record messages and touch their leads: the buckets of these leads and a folder of messages are written."""
        tables, last = self._part(self._numbers(batch, "lead_id")), self.counters()["mensagens"]
        changed, new = changes.record_messages(tables, batch, as_of, last)
        staged, ids = self._stage({"mensagens": new, "leads": changed.tables.leads})
        self._count(mensagens=max(last, ids["mensagens"]))
        self._put_messages(staged["mensagens"], uuid.uuid4().hex)
        self._save_leads(staged["leads"], self._numbers(staged["mensagens"], "lead_id"))
        return changed._replace(tables=self.current())

    def upsert_leads(self, batch: DataFrame, as_of: datetime | None = None) -> changes.Changed:
        """Create or update leads: the buckets of leads that are there are written anew, new leads are added to theirs."""
        last = self.counters()["leads"]
        found = self._buckets_of_contacts(batch)
        changed = changes.upsert_leads(self._part(found), batch, as_of, last=last)
        staged, ids = self._stage({"leads": changed.tables.leads})
        self._count(leads=max(last, ids["leads"]))
        self._save_leads(staged["leads"].where(F.col("id") <= last), found, staged["leads"].where(F.col("id") > last))
        return changed._replace(tables=self.current())

    def update_tags(self, batch: DataFrame, as_of: datetime | None = None) -> SalesTables:
        """Overwrite tags: the buckets of the leads are written."""
        buckets = self._numbers(batch, "lead_id")
        staged, _ = self._stage({"leads": changes.update_tags(self._leads_in(buckets), batch, as_of)})
        self._save_leads(staged["leads"], buckets)
        return self.current()

    def _part(self, buckets: list[int]) -> SalesTables:
        """The tables with the leads of some buckets only."""
        return self.current().with_(leads=self._leads_in(buckets))

    def _buckets_of_contacts(self, calls: DataFrame) -> list[int]:
        """The buckets of all leads that share contact and provider with a call, by the contacts' own buckets."""
        keys = self.spark.read.schema(CONTACTS).parquet(f"{self.root}/contatos")
        keys = keys.where(F.col("bucket").isin(self._numbers(calls, "remotejid")))
        wanted = calls.select(*changes.CONTACT_KEY).distinct()
        return self._numbers(keys.join(wanted, changes.CONTACT_KEY, "left_semi"), "id")

    def _save_leads(self, leads: DataFrame, buckets: list[int], new: DataFrame | None = None) -> None:
        """Write whole buckets of leads anew, then add new leads to theirs."""
        if buckets:
            self._put_leads(leads.where(self._bucket("id").isin(buckets)), "overwrite")
        if new is not None:
            self._put_leads(new, "append")
            self._put_contacts(new, "append")
        self._unstage()

    def record_conversation(
        self, arrived: DataFrame, as_of: datetime | None = None, stream: tuple[str, int] | None = None
    ) -> DataFrame:
        """Upsert the contacts of arrived messages and record the messages under their leads.

        ``arrived`` has ``seq``, ``remotejid``, ``instancia``, ``mensagem``, and may have
        ``is_bot``, ``created_at`` and the contact fields.  Returns what cannot be
        identified: rows without contact, text or an active provider's instance.
        ``stream`` names a stream and micro-batch.  One that is in already changes nothing; one that was
        broken off finds its contacts again and overwrites its messages.
        """
        counters = self.counters()
        active = self._read("provedores").filter("ativo").select(F.col("id").alias("provedor_id"), "instancia")
        complete = F.col("remotejid").isNotNull() & F.col("mensagem").isNotNull()
        known = arrived.filter(complete).join(active, "instancia")
        unknown = arrived.join(known.select("seq"), "seq", "left_anti")
        if stream and counters.get(f"stream {stream[0]}", -1) >= stream[1]:
            return unknown
        given = [c for c in changes.CONTACT_FIELDS if c in arrived.columns]
        types = {f.name: f.dataType for f in S.LEADS}
        calls = known.select(
            "seq", "remotejid", "provedor_id",
            *[F.col(c) if c in given else F.lit(None).cast(types[c]).alias(c) for c in changes.CONTACT_FIELDS],
        )
        upserted = self.upsert_leads(calls, as_of)
        texts = [c for c in ("is_bot", "created_at") if c in arrived.columns]
        messages = known.select("seq", "mensagem", *texts).join(upserted.ids.withColumnRenamed("id", "lead_id"), "seq")
        new = changes.apply_defaults(assign_ids(messages, ["seq"], counters["mensagens"]), "mensagens", as_of)
        staged, last = self._stage({"mensagens": new})
        self._count(mensagens=max(counters["mensagens"], last["mensagens"]))
        self._put_messages(staged["mensagens"], f"{stream[0]}-{stream[1]}" if stream else uuid.uuid4().hex)
        if stream:
            self._count(**{f"stream {stream[0]}": stream[1]})
        self._unstage()
        return unknown

    # Saved changes: single calls.

    def registrar_mensagem(self, lead_id: int, mensagem: str, is_bot: bool = False, as_of: datetime | None = None) -> int:
        """Record one message and return its id."""
        call = self.spark.createDataFrame(
            [(1, lead_id, mensagem, is_bot)], "seq BIGINT, lead_id BIGINT, mensagem STRING, is_bot BOOLEAN"
        )
        return _written_id(self.record_messages(call, as_of), f"no lead {lead_id}, or no text")

    def upsert_lead(self, remotejid: str, provedor_id: int, as_of: datetime | None = None, **fields) -> int:
        """Create or update one lead and return its id."""
        row = (1, remotejid, provedor_id, *[fields.pop(c, None) for c in changes.CONTACT_FIELDS])
        if fields:
            raise TypeError(f"unknown fields: {', '.join(fields)}")
        call = self.spark.createDataFrame(
            [row], "seq BIGINT, remotejid STRING, provedor_id BIGINT, nome STRING, cpf_cnpj STRING, "
            "endereco_instalacao STRING, whatsapp STRING, tags ARRAY<STRING>",
        )
        return _written_id(self.upsert_leads(call, as_of), f"no provider {provedor_id}, or no contact")

    def atualizar_tags_lead(self, lead_id: int, tags: list[str] | None, as_of: datetime | None = None) -> bool:
        """Overwrite one lead's tags; False, and nothing is written, if there is no such lead."""
        call = self.spark.createDataFrame([(1, lead_id, tags)], "seq BIGINT, lead_id BIGINT, tags ARRAY<STRING>")
        if self._leads_in(self._numbers(call, "lead_id")).filter(F.col("id") == lead_id).isEmpty():
            return False
        self.update_tags(call, as_of)
        return True


def _written_id(changed: changes.Changed, otherwise: str) -> int:
    row = changed.ids.first()
    if row is None:
        raise IntegrityError(f"violated: {otherwise}")
    return row.id

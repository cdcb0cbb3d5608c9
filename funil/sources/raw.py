"""Typed scans of the generated input tables, and their view as the four sales tables.

``nation`` stands in for providers, ``supplier`` for plans, ``customer`` for
leads and ``orders`` for messages; their foreign keys have the same shape.  All
rows are kept.  Two keys are redirected (nation 24's suppliers to 23, orders of
each fiftieth customer to the next one) so that a provider without plans and
leads without messages occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from funil import schema as S, values as V
from funil.tables import SalesTables

RAW = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
        "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    ),
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def scan(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(RAW[table]).parquet(f"{folder}/{table}.parquet")


def _padded(number: str, width: int, fill: str = "0") -> str:
    """A number as text of at least ``width`` characters, as SQL; ``lpad`` alone would cut longer ones."""
    text = f"CAST({number} AS STRING)"
    return f"lpad({text}, greatest({width}, length({text})), '{fill}')"


def _contact(number: str) -> str:
    """The messaging address of a contact number, as SQL."""
    return f"concat('55', {_padded(number, 11)}, '@s.whatsapp.net')"


def _minutes(number: str) -> str:
    """An interval of that many minutes, as SQL; its parts stay within an INT."""
    return f"make_dt_interval(CAST({number} div 1440 AS INT), 0, CAST({number} % 1440 AS INT), 0)"


# Column expressions per table, in the order of the declared schemas.
LOADED_AT = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"

PROVIDER_COLUMNS = {
    "id": "n_nationkey",
    "nome_provedor": "n_name",
    "instancia": "concat(lower(n_name), '_whatsapp')",
    "apikey": "concat('key_', n_nationkey)",
    "config_bot": """
        CASE n_nationkey
          WHEN 23 THEN NULL
          WHEN 22 THEN '{"modelo":null,"prompt_sdr":null}'
          ELSE concat('{"modelo":"m', n_regionkey, '","max_tokens":', 400 + 10 * n_nationkey,
            ',"temperatura":0.', n_nationkey % 9 + 1,
            IF(n_nationkey % 4 = 0, '',
               concat(',"prompt_sdr":"Método COT: qualificar ', lower(n_name), '"')),
            ',"webhook_n8n":"https://example.org/hook/', n_nationkey, '"}')
        END""",
    "plano": f"""
        CASE n_nationkey % 3 WHEN 0 THEN '{V.DEFAULT_TIER}' WHEN 1 THEN 'profissional'
        ELSE 'enterprise' END""",
    "ativo": "n_nationkey % 7 <> 0",
    "created_at": LOADED_AT,
    "updated_at": LOADED_AT,
}

PLAN_COLUMNS = {
    "id": "s_suppkey",
    "nome_plano": "s_name",
    "velocidade": "concat(100 * (s_suppkey % 6 + 1), ' Mbps')",
    "valor": "s_acctbal",
    "provedor_id": "least(s_nationkey, 23)",
    "ativo": "s_suppkey % 10 <> 0",
    "created_at": LOADED_AT,
    "updated_at": LOADED_AT,
}

_ARRIVED = f"{LOADED_AT} + {_minutes('(c_custkey div 2)')}"

LEAD_COLUMNS = {
    "id": "c_custkey",
    "nome": "IF(c_custkey % 11 <> 0, c_name, NULL)",
    "cpf_cnpj": f"IF(c_custkey % 3 <> 0, {_padded('c_custkey', 11)}, NULL)",
    "endereco_instalacao": "concat(c_mktsegment, ' street')",
    "remotejid": _contact("c_custkey"),
    "whatsapp": f"IF(c_custkey % 5 <> 0, concat('(55) ', {_padded('c_custkey', 9)}), NULL)",
    "tags": f"""
        CASE WHEN c_custkey % 13 = 0 THEN NULL
             WHEN c_custkey % 17 = 0 THEN array()
             ELSE array(CASE WHEN c_acctbal > 6000 THEN '{V.TAG_HOT}' WHEN c_acctbal > 2000 THEN '{V.TAG_WARM}'
                        ELSE '{V.TAG_COLD}' END, lower(c_mktsegment)) END""",
    "created_at": _ARRIVED,
    "updated_at": _ARRIVED,
    "provedor_id": "c_nationkey",
}

MESSAGE_COLUMNS = {
    "id": "o_orderkey",
    "mensagem": "o_orderpriority",
    "is_bot": "o_orderstatus = 'F'",
    "created_at": "o_orderdate",
    "lead_id": "IF(o_custkey % 50 = 0, o_custkey + 1, o_custkey)",
}

# Ids of conversation turns leave this much room for a conversation's turns.
TURNS = 1 << 24

# Conversation turns, whole texts; what the user did not write counts as the bot's.
TEXT_COLUMNS = {
    "id": f"conv_id * {TURNS} + IF(turn >= 0 AND turn < {TURNS}, turn, raise_error('turn out of range'))",
    "mensagem": "text",
    "is_bot": "role <> 'user'",
    "created_at": f"{LOADED_AT} + {_minutes('turn')}",
    "lead_id": "conv_id",
}


def _as(df: DataFrame, table: str, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr([
        f"CAST({columns[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in S.SCHEMAS[table]
    ])


def providers(spark: SparkSession, folder: str) -> DataFrame:
    return _as(scan(spark, folder, "nation"), "provedores", PROVIDER_COLUMNS)


def plans(spark: SparkSession, folder: str) -> DataFrame:
    return _as(scan(spark, folder, "supplier"), "planos", PLAN_COLUMNS)


def leads(spark: SparkSession, folder: str) -> DataFrame:
    return _as(scan(spark, folder, "customer"), "leads", LEAD_COLUMNS)


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return _as(scan(spark, folder, "orders"), "mensagens", MESSAGE_COLUMNS)


def text_messages(spark: SparkSession, folder: str) -> DataFrame:
    return _as(scan(spark, folder, "conversations"), "mensagens", TEXT_COLUMNS)


def sales_tables(spark: SparkSession, folder: str) -> SalesTables:
    return SalesTables(
        provedores=providers(spark, folder),
        planos=plans(spark, folder),
        leads=leads(spark, folder),
        mensagens=messages(spark, folder),
    )


# Change batches read from ``events``: ``seq`` is the order of the calls.

def message_batch(events: DataFrame) -> DataFrame:
    """One message per event; some go to leads that do not exist."""
    return events.selectExpr(
        "event_id AS seq",
        "user_id * 11 AS lead_id",
        "concat(event_type, ' ', props) AS mensagem",
        "event_type = 'error' AS is_bot",
        "ts AS created_at",
    )


def contact_batch(events: DataFrame) -> DataFrame:
    """One contact update per event, with most fields unset; provider 25 does not exist."""
    return events.selectExpr(
        "event_id AS seq",
        f"{_contact('user_id')} AS remotejid",
        "event_id % 26 AS provedor_id",
        "IF(event_type = 'signup', concat('Nome ', event_id), NULL) AS nome",
        f"IF(event_type = 'purchase', {_padded('event_id', 11, '7')}, NULL) AS cpf_cnpj",
        "IF(event_type = 'view', concat('Rua ', event_id), NULL) AS endereco_instalacao",
        "IF(event_type = 'click', concat('(11) ', event_id), NULL) AS whatsapp",
        f"IF(event_type = 'purchase', array('{V.TAG_HOT}', event_type), NULL) AS tags",
    )


def tag_batch(events: DataFrame) -> DataFrame:
    """One tag overwrite per event; errors clear the tags."""
    return events.selectExpr(
        "event_id AS seq",
        "user_id * 11 AS lead_id",
        f"IF(event_type <> 'error', array('{V.TAG_COLD}', event_type), NULL) AS tags",
    )


def arrivals(events: DataFrame) -> DataFrame:
    """Incoming messages by contact and instance, before they are identified."""
    return events.selectExpr(
        "event_id",
        f"{_contact('user_id')} AS remotejid",
        "concat('nation_', event_id % 25, '_whatsapp') AS instancia",
    )


def conversation(events: DataFrame) -> DataFrame:
    """Incoming messages by contact and instance, with their texts; one instance in 26 is unknown."""
    return events.selectExpr(
        "event_id AS seq",
        f"{_contact('user_id')} AS remotejid",
        "concat('nation_', event_id % 26, '_whatsapp') AS instancia",
        "concat(event_type, ' ', props) AS mensagem",
        "event_type = 'error' AS is_bot",
        "ts AS created_at",
        "IF(event_type = 'signup', concat('Nome ', event_id), NULL) AS nome",
    )


def snapshot_history(events: DataFrame) -> DataFrame:
    """One snapshot per hour of events, sized by that hour's events."""
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    sizes = events.groupBy(hour.alias("taken_at")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("props")).alias("n_bytes")
    )
    return sizes.withColumn("snapshot", F.concat(F.lit("regular_"), F.date_format("taken_at", "yyyy-MM-dd_HH")))


# Faults of every kind, for the integrity reports to find; all rows are kept.
FAULTS = {
    "provedores": {
        "config_bot": """
            CASE id % 5 WHEN 0 THEN '{"modelo":' WHEN 1 THEN '{"modelo":"a","modelo":"b"}'
            ELSE config_bot END""",
    },
    "planos": {"id": "IF(id % 9 <> 0, id, NULL)"},
    "leads": {
        "id": "IF(id % 97 = 0, id + 1, id)",
        "remotejid": "CASE WHEN id % 101 = 0 THEN NULL WHEN id % 107 = 0 THEN 'shared' ELSE remotejid END",
        "provedor_id": "CASE WHEN id % 103 = 0 THEN 999L WHEN id % 107 = 0 THEN 1L ELSE provedor_id END",
    },
    "mensagens": {
        "mensagem": "IF(id % 500 <> 3, mensagem, NULL)",
        "lead_id": "IF(id % 1000 = 7, -1L, lead_id)",
    },
}


def broken_tables(spark: SparkSession, folder: str) -> SalesTables:
    return SalesTables(**{
        name: df.selectExpr([f"{FAULTS[name].get(c, c)} AS {c}" for c in df.columns])
        for name, df in sales_tables(spark, folder).by_name().items()
    })


def price_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Prices as text, some not numbers and some too large for the price type."""
    return scan(spark, folder, "lineitem").selectExpr("""
        CASE l_linenumber WHEN 7 THEN 'n/a' WHEN 6 THEN concat(l_orderkey, '00000.5')
        ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS valor""")

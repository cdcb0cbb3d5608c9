"""Declared schemas, column defaults and keys of the four tables.

Ids are 64-bit so that the message table may pass two billion rows.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DecimalType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from funil import values as V

PRICE = DecimalType(10, 2)


def _required(name, data_type):
    return StructField(name, data_type, False)


PROVEDORES = StructType([
    _required("id", LongType()),
    _required("nome_provedor", StringType()),
    _required("instancia", StringType()),
    _required("apikey", StringType()),
    StructField("config_bot", StringType()),
    _required("plano", StringType()),
    _required("ativo", BooleanType()),
    _required("created_at", TimestampNTZType()),
    _required("updated_at", TimestampNTZType()),
])

PLANOS = StructType([
    _required("id", LongType()),
    _required("nome_plano", StringType()),
    _required("velocidade", StringType()),
    _required("valor", PRICE),
    _required("provedor_id", LongType()),
    _required("ativo", BooleanType()),
    _required("created_at", TimestampNTZType()),
    _required("updated_at", TimestampNTZType()),
])

LEADS = StructType([
    _required("id", LongType()),
    StructField("nome", StringType()),
    StructField("cpf_cnpj", StringType()),
    StructField("endereco_instalacao", StringType()),
    _required("remotejid", StringType()),
    StructField("whatsapp", StringType()),
    StructField("tags", ArrayType(StringType())),
    _required("created_at", TimestampNTZType()),
    _required("updated_at", TimestampNTZType()),
    _required("provedor_id", LongType()),
])

MENSAGENS = StructType([
    _required("id", LongType()),
    _required("mensagem", StringType()),
    _required("is_bot", BooleanType()),
    _required("created_at", TimestampNTZType()),
    _required("lead_id", LongType()),
])

SCHEMAS = {
    "provedores": PROVEDORES,
    "planos": PLANOS,
    "leads": LEADS,
    "mensagens": MENSAGENS,
}

# (child table, foreign key, parent table); parents come before their children.
FOREIGN_KEYS = (
    ("planos", "provedor_id", "provedores"),
    ("leads", "provedor_id", "provedores"),
    ("mensagens", "lead_id", "leads"),
)


def column_defaults(table: str, as_of: Column) -> dict[str, Column]:
    """Value each omitted column of ``table`` takes; ``as_of`` is the load time."""
    stamps = {"created_at": as_of, "updated_at": as_of}
    return {
        "provedores": {"plano": F.lit(V.DEFAULT_TIER), "ativo": F.lit(True), **stamps},
        "planos": {"ativo": F.lit(True), **stamps},
        "leads": stamps,
        "mensagens": {"is_bot": F.lit(False), "created_at": as_of},
    }[table]


def required_columns(table: str) -> list[str]:
    return [field.name for field in SCHEMAS[table] if not field.nullable]

"""The four tables as one immutable value."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class SalesTables:
    provedores: DataFrame
    planos: DataFrame
    leads: DataFrame
    mensagens: DataFrame

    @property
    def spark(self) -> SparkSession:
        return self.leads.sparkSession

    def by_name(self) -> dict[str, DataFrame]:
        """Tables by name, parents before children."""
        return {
            "provedores": self.provedores,
            "planos": self.planos,
            "leads": self.leads,
            "mensagens": self.mensagens,
        }

    def with_(self, **tables: DataFrame) -> SalesTables:
        return replace(self, **tables)

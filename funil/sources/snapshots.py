"""Snapshots of the four tables: write, list, choose, verify, restore.

A snapshot is one folder of Parquet files.  Its manifest rows are written last,
after the files were read back and found to hold what was sent, and only
snapshots in the manifest exist for readers.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from funil import values as V
from funil.functions.scalars import moment
from funil.sources.counts import count_difference, count_rows
from funil.settings import write_once
from funil.sources.store import read_tables
from funil.tables import SalesTables

MANIFEST = (
    "snapshot STRING, kind STRING, taken_at TIMESTAMP_NTZ, table_name STRING, "
    "n_rows BIGINT, content DECIMAL(38,0), n_bytes BIGINT"
)


class SnapshotError(RuntimeError):
    """A snapshot that is missing, too small, or not what was written."""


def _content(df: DataFrame) -> list[Column]:
    """Row count and an order-free digest; a sum, since XOR would cancel equal rows.

    The hash passes over NULLs, so which columns are NULL is hashed as well.
    """
    empty = [F.col(c).isNull() for c in df.columns]
    digest = F.sum(F.xxhash64(*df.columns, *empty).cast("decimal(28,0)"))
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(digest, F.lit(0)).cast("decimal(38,0)").alias("content"),
    ]


def contents(tables: SalesTables) -> DataFrame:
    """Row count and digest of each table."""
    rows = [
        df.agg(F.lit(name).alias("table_name"), *_content(df)) for name, df in tables.by_name().items()
    ]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


def file_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes per table of a snapshot folder, from file listings only."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(folder)
        .groupBy(F.element_at(F.split("path", "/"), -2).alias("table_name"))
        .agg(F.sum("length").alias("n_bytes"))
    )


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def manifest(self) -> DataFrame:
        """One row per snapshot and table."""
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest")

    def snapshots(self) -> DataFrame:
        """One row per snapshot."""
        return (
            self.manifest()
            .groupBy("snapshot", "kind", "taken_at")
            .agg(F.sum("n_rows").alias("n_rows"), F.sum("n_bytes").alias("n_bytes"))
        )

    def write(
        self,
        tables: SalesTables,
        taken_at: datetime,
        kind: str = "regular",
        min_bytes: int = 0,
    ) -> str:
        """Write a snapshot and return its name; rows and digests are counted while writing.

        ``min_bytes`` refuses a smaller one; ``values.MIN_SNAPSHOT_BYTES`` is the usual threshold.
        """
        snapshot = f"{kind}_{taken_at:%Y-%m-%d_%H-%M-%S}"
        folder = f"{self.root}/{snapshot}"
        sent = {}
        for name, df in tables.by_name().items():
            seen = Observation()
            df.observe(seen, *_content(df)).write.parquet(f"{folder}/{name}")
            sent[name] = seen.get

        found = self._found(snapshot).collect()  # four rows
        for row in found:
            if (row.n_rows, row.content) != (sent[row.table_name]["n_rows"], sent[row.table_name]["content"]):
                raise SnapshotError(f"{snapshot}/{row.table_name} differs from what was written")
        if sum(row.n_bytes for row in found) < min_bytes:
            raise SnapshotError(f"{snapshot} is smaller than {min_bytes} bytes")

        rows = [(snapshot, kind, taken_at, r.table_name, r.n_rows, r.content, r.n_bytes) for r in found]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(
            f"{self.root}/manifest"
        )
        return snapshot

    def _found(self, snapshot: str) -> DataFrame:
        folder = f"{self.root}/{snapshot}"
        return contents(read_tables(self.spark, folder)).join(
            file_bytes(self.spark, folder), "table_name", "left"
        )

    def verify(self, snapshot: str) -> DataFrame:
        """Read a snapshot again and compare it with its manifest."""
        stated = self.manifest().filter(F.col("snapshot") == snapshot).select(
            "table_name", F.col("n_rows").alias("rows_stated"),
            F.col("content").alias("content_stated"), F.col("n_bytes").alias("bytes_stated"),
        )
        return stated.join(self._found(snapshot), "table_name", "full").select(
            "table_name",
            "rows_stated",
            F.col("n_rows").alias("rows_found"),
            F.col("content_stated").eqNullSafe(F.col("content")).alias("same_content"),
            F.col("bytes_stated").eqNullSafe(F.col("n_bytes")).alias("same_size"),
        )

    def latest(self, kind: str = "regular") -> str:
        row = latest(self.snapshots().filter(F.col("kind") == kind)).first()
        if row is None:
            raise SnapshotError(f"no {kind} snapshot under {self.root}")
        return row.snapshot

    def read(self, snapshot: str) -> SalesTables:
        if self.manifest().filter(F.col("snapshot") == snapshot).isEmpty():
            raise SnapshotError(f"no snapshot {snapshot} under {self.root}")
        return read_tables(self.spark, f"{self.root}/{snapshot}")

    def restore(
        self, store, snapshot: str, at: datetime, safety: bool = True
    ) -> DataFrame:
        """Replace a table store's contents by a snapshot; returns counts before and after.

        The current contents are saved first as a ``pre-restore`` snapshot unless
        ``safety`` is off.  A snapshot that fails its check is not restored.
        """
        failed = self.verify(snapshot).filter(~(F.col("same_content") & F.col("same_size")))
        if not failed.isEmpty():
            raise SnapshotError(f"{snapshot} does not match its manifest")
        current = store.current()
        if safety:
            self.write(current, at, kind="pre-restore")
        before = write_once(count_rows(current), "counts")
        restored = store.replace(self.read(snapshot), at)
        return count_difference(before, count_rows(restored))


def newest_first(snapshots: DataFrame) -> DataFrame:
    return snapshots.orderBy(F.desc("taken_at"), F.desc("snapshot"))


def latest(snapshots: DataFrame) -> DataFrame:
    return newest_first(snapshots).limit(1)


def total_size(snapshots: DataFrame) -> DataFrame:
    return snapshots.agg(
        F.count(F.lit(1)).alias("n_snapshots"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n_bytes")
    )


def expired(snapshots: DataFrame, as_of: datetime, days: int = V.RETENTION_DAYS) -> DataFrame:
    """Snapshots whose age in whole days is above ``days``; deleting them is left to the caller."""
    # Whole days only: N days and 23 hours still count as N.
    age = F.floor(F.timestamp_diff("SECOND", F.col("taken_at"), moment(as_of)) / 86400)
    return snapshots.filter(age > days)

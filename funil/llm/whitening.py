"""Whitened embeddings: projections on the covariance's leading eigenvectors, found by Jacobi-Davidson."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from funil.llm.eigen import EPS, largest_eigenpairs
from funil.settings import write_once

ROWS = 2048  # vectors in a block
SCALE, SHIFT = 1024, 100_000  # an entry c counts as floor(SCALE * c) + SHIFT
LARGEST = float(1 << 40)  # entries beyond it count as not finite


def _pack(docs: DataFrame, id_col: str, vector_col: str, size: int) -> DataFrame:
    """Blocks of usable vectors: ``_ids``, and their whole-number entries as packed 64-bit integers."""

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                entries = part.column("_vector").flatten().to_numpy(zero_copy_only=False).astype(float)
                entries = np.floor(entries.reshape(part.num_rows, size) * SCALE) + SHIFT  # null entries are nan
                usable = np.flatnonzero((np.abs(entries) <= LARGEST).all(1))
                if len(usable):
                    ids = part.column("_id").take(pa.array(usable))
                    yield pa.RecordBatch.from_arrays(
                        [pa.ListArray.from_arrays(pa.array([0, len(usable)], pa.int32()), ids),
                         pa.array([entries[usable].astype("<i8").tobytes()], pa.binary())], ["_ids", "_entries"]
                    )

    rows = docs.select(F.col(id_col).alias("_id"), F.col(vector_col).cast("array<double>").alias("_vector"))
    schema = StructType().add("_ids", ArrayType(rows.schema["_id"].dataType)).add("_entries", "binary")
    return rows.where(F.size("_vector") == size).mapInArrow(run, schema)


def _sums(blocks: DataFrame, per_block, kind: str) -> np.ndarray:
    """The sum over all blocks of an array that ``per_block`` makes of a block's entries, flattened.

    A task adds up its own blocks; what the tasks have is added by position.
    """

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in given:
            for row in batch.column(0).to_pylist():
                part = per_block(row)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(total.size)), pa.array(total.ravel())], ["_at", "_value"]
            )

    parts = blocks.mapInArrow(run, f"_at long, _value {kind}")
    rows = parts.groupBy("_at").agg(F.sum("_value").alias("_value")).toArrow().sort_by("_at")
    return rows.column("_value").to_numpy()


def _exact_squares(entries: np.ndarray, low: np.ndarray, rest: np.ndarray, n: int) -> list[Decimal]:
    """Per row the sum of (n * entry - sum)^2, where a sum is n * low + rest; exact however large."""
    moved = entries - low
    most = int(np.abs(moved).max()) + 1
    if (n * most) ** 2 * entries.shape[1] < 1 << 63:
        apart = n * moved - rest
        return [Decimal(int(v)) for v in (apart * apart).sum(1)]
    apart = moved.astype(object) * n - rest.astype(object)
    return [Decimal(v) for v in (apart * apart).sum(1)]


def whiten(
    vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Per usable row and component: id, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    An entry c counts as the whole number x = floor(1024 c) + 100000.  ``whitened`` is the
    row, centred, along the component's unit eigenvector of the covariance (divisor n)
    over the square root of its eigenvalue; components are numbered by falling
    eigenvalue.  ``deviation`` is the exact sum of (n x - S)^2, S the sums of all rows.
    ``explained`` is the eigenvalue's share of the trace, ``identity_error`` the largest
    entry by which the covariance of ``whitened`` misses the identity.

    * A row goes if its vector is null, holds a null or a value that is not finite (or
      beyond 2^40 / 1024), or has not the length that most vectors have (of equally
      frequent lengths the longest counts).
    * Directions in which the rows do not differ (an eigenvalue of rounding size) are no
      components, so there may be fewer than ``components``; equal rows give none.
    * Null ids stay null, repeated rows all count and are returned.  Other columns are
      ignored.  No usable rows give no rows.

    The matrix is never formed.  Each product of the covariance with a block of directions
    is one pass over the packed rows; a task sends back as many numbers as the block has.
    """
    spark = vectors.sparkSession
    lengths = vectors.where(F.col(vector_col).isNotNull()).groupBy(F.size(vector_col).alias("_size")).count()
    usual = lengths.where("_size > 0").orderBy(F.desc("count"), F.desc("_size")).first()
    size = usual["_size"] if usual else 1
    blocks = write_once(_pack(vectors, id_col, vector_col, size), "vectors")
    entries_of = blocks.select("_entries")

    def entries(packed: bytes) -> np.ndarray:
        return np.frombuffer(packed, "<i8").reshape(-1, size)

    totals = _sums(entries_of, lambda b: np.append(entries(b).sum(0), len(entries(b))), "long")
    n = int(totals[-1]) if len(totals) else 0
    sums = [int(s) for s in totals[:-1]] or [0] * size
    low = np.array([s // n if n else 0 for s in sums], np.int64)
    rest = np.array([s - n * int(q) for s, q in zip(sums, low)], np.int64)

    def centred(packed: bytes) -> np.ndarray:
        return (entries(packed) - low) - rest / n  # whole parts first, so that little is rounded

    def product(block: np.ndarray) -> np.ndarray:
        def part(packed: bytes) -> np.ndarray:
            rows = centred(packed)
            return rows.T @ (rows @ block)

        return _sums(entries_of, part, "double").reshape(block.shape) / n

    if n:
        values, directions, _ = largest_eigenpairs(product, size, components)
        real = values > size * EPS * max(values[0], 0) * 8
        values, directions = values[real], directions[:, real]
    else:
        values, directions = np.zeros(0), np.zeros((size, 0))
    scaled = directions / np.sqrt(values)

    def project(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            for k, packed in enumerate(batch.column("_entries").to_pylist()):
                own = batch.column("_ids").slice(k, 1).flatten()
                along = centred(packed) @ scaled
                squares = _exact_squares(entries(packed), low, rest, n)
                offsets = np.arange(len(along) + 1, dtype=np.int32) * along.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [own, pa.array(squares, pa.decimal128(38, 0)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(along.ravel()))],
                    ["_id", "deviation", "_whitened"],
                )

    kind = blocks.schema["_ids"].dataType.elementType
    schema = StructType().add("_id", kind).add("deviation", "decimal(38,0)").add("_whitened", ArrayType(DoubleType()))
    rows = write_once(blocks.mapInArrow(project, schema), "whitened")
    spread = rows.agg(F.sum("deviation")).first()[0]
    trace = float(spread / Decimal(n) ** 3) if spread else 0.0
    k = len(values)
    shares = [float(v / trace) for v in values]
    error = _identity_error(rows, k, n)
    return rows.select("_id", "deviation", F.posexplode("_whitened").alias("_k", "whitened")).select(
        F.col("_id").alias(id_col), (F.col("_k") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"),
        "deviation", "whitened", F.get(F.array(*[F.lit(s) for s in shares] or [F.lit(0.0)]), F.col("_k")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def _identity_error(rows: DataFrame, k: int, n: int) -> float:
    """The largest entry of the whitened rows' covariance minus the identity; centred before multiplying."""
    if not k:
        return 0.0

    def each(expression) -> list[float]:
        return list(rows.agg(*expression).first())

    means = each([(F.sum(F.col("_whitened")[i]) / n) for i in range(k)])
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = each([
        F.sum((F.col("_whitened")[i] - means[i]) * (F.col("_whitened")[j] - means[j])) / n for i, j in pairs
    ])
    return max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs))

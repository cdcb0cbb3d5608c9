"""Sharding on a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

from bisect import bisect_left
from math import ceil

from pyspark.sql import DataFrame, SparkSession, functions as F

from funil.operators.numbering import assign_ids

_SEGMENT_BITS = 12  # the ring is cut into 4,096 segments to look positions up


def ring(spark: SparkSession, shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node, clockwise.  A position depends on its shard and number only."""
    nodes = spark.range(shards * virtual_nodes).select(
        F.expr(f"CAST(id % {shards} AS INT)").alias("shard"), F.expr(f"id div {shards}").alias("node")
    )
    position = F.xxhash64(F.lit("node"), "shard", "node").bitwiseAND(F.lit((1 << 63) - 1))
    return sorted((r[0], r[1]) for r in nodes.select(position, "shard").collect())


def bounded_walk(counts: dict[int, int], owners: list[int], room: list[int]) -> list[tuple[int, int, int]]:
    """Keys taken as (arc, shard, number), given how many keys each arc of the ring holds.

    An arc ends at the virtual node of the same index (the arc past the last one at
    node 0).  In every round each arc offers its waiting keys to the node it points at;
    the node's shard takes what still fits, the rest moves on clockwise.
    """
    room, follow, taken = list(room), list(range(len(owners))), []

    def open_node(node: int) -> int:
        path = []
        while not room[owners[node]]:
            path.append(node)
            node = follow[node] if follow[node] != node else (node + 1) % len(owners)
        for passed in path:
            follow[passed] = node
        return node

    waiting = [(arc, arc % len(owners), n) for arc, n in sorted(counts.items()) if n]
    while waiting:
        moved = []
        for arc, node, n in waiting:
            shard = owners[node]
            got = min(n, room[shard])
            if got:
                room[shard] -= got
                taken.append((arc, shard, got))
            if n > got:
                moved.append((arc, node, n - got))
        waiting = [(arc, open_node(node), n) for arc, node, n in moved]
    return taken


def capacities(rows: int, shards: int, load_factor: float) -> list[int]:
    """Rows a shard may hold; at load factor 1 sizes differ by one at most and sum up to ``rows``."""
    if load_factor == 1:
        return [rows // shards + (s < rows % shards) for s in range(shards)]
    return [ceil(load_factor * rows / shards)] * shards


def shard_rows(
    docs: DataFrame,
    shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    virtual_nodes: int = 128,
    load_factor: float = 1.0,
) -> DataFrame:
    """One row per input row: id, ``size``, ``text_crc32``, ``home_shard``, ``shard``, ``slot``.

    A row's place on the ring is the hash of its id.  It belongs to the next virtual
    node clockwise; if that node's shard is full it continues clockwise to the next
    shard with room.  No shard gets more than ``load_factor`` times its even share
    (rounded up); at 1.0 shard sizes differ by one row at most.  Only what exceeds a
    shard's room leaves its home shard.  ``slot`` numbers a shard's rows from 0.

    * ``size`` is the text's length in UTF-8 bytes plus 1, and 1 for a null text; the
      checksum of a null text is that of an empty one.
    * A null id has a place like any other id.  Rows repeated under one id share a
      place and are told apart by their order in the input.
    * Other columns are ignored.  No rows give no rows.

    Rows are range-partitioned by ring position, so the rank within an arc needs no
    task that sees a whole shard.  Only one count per arc (``shards * virtual_nodes + 1``
    at most) reaches the driver, and the intervals planned from them are broadcast.
    """
    if shards < 1 or virtual_nodes < 1 or load_factor < 1:
        raise ValueError("shards and virtual_nodes must be at least 1, load_factor at least 1.0")
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    position = F.xxhash64(F.lit("key"), F.col("_id")).bitwiseAND(F.lit((1 << 63) - 1))
    keys = (
        docs.select(
            F.col(id_col).alias("_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
        )
        .withColumn("_position", position)
        .withColumn("_row", F.monotonically_increasing_id())
    )
    ranked = assign_ids(keys, ["_position", "_row"], name="_rank")

    nodes = ring(spark, shards, virtual_nodes)
    positions, owners = [p for p, _ in nodes], [s for _, s in nodes]
    shift = 63 - _SEGMENT_BITS
    starts = [bisect_left(positions, segment << shift) for segment in range((1 << _SEGMENT_BITS) + 1)]
    segments = spark.createDataFrame(
        [(k, starts[k], positions[starts[k] : starts[k + 1]]) for k in range(1 << _SEGMENT_BITS)],
        "_segment int, _before int, _inside array<bigint>",
    )
    arced = ranked.withColumn("_segment", F.shiftright("_position", shift).cast("int")).join(
        F.broadcast(segments), "_segment"
    ).withColumn("_arc", F.expr("_before + size(filter(_inside, p -> p < _position))"))

    counts = {r[0]: r[1] for r in arced.groupBy("_arc").count().collect()}
    taken = bounded_walk(counts, owners, capacities(sum(counts.values()), shards, load_factor))
    first, rank = {}, 1
    for arc in sorted(counts):
        first[arc] = rank
        rank += counts[arc]
    slots, intervals = [0] * shards, []
    for arc, shard, n in taken:
        intervals.append((arc, owners[arc % len(owners)], shard, first[arc], first[arc] + n, slots[shard]))
        first[arc] += n
        slots[shard] += n
    plan = spark.createDataFrame(
        intervals, "_arc int, home_shard int, shard int, _from bigint, _to bigint, _slot bigint"
    )
    return (
        arced.join(F.broadcast(plan), "_arc")
        .where("_rank >= _from AND _rank < _to")
        .select(
            F.col("_id").alias(id_col), "size", "text_crc32", "home_shard", "shard",
            (F.col("_slot") + F.col("_rank") - F.col("_from")).alias("slot"),
        )
    )

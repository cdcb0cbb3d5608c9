"""A Merkle manifest of a dataset: siblings by windows over fixed offsets, level by level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from funil.llm.running import running_totals
from funil.settings import write_once

FAN = 16  # consecutive nodes that have one parent
BLOCK = FAN * FAN  # consecutive nodes of a key that one window holds: whole runs
_PATH = "array<struct<left:string,right:string>>"


def digest(*values: Column) -> Column:
    """Lowercase hex SHA-256 of strings, one after the other."""
    return F.sha2(F.concat(*values), 256)


def leaf(*values: Column) -> Column:
    """The hash of a row: of each value its length in UTF-8 bytes, a colon and itself; ``-`` where null."""
    texts = [v.cast("string") for v in values]
    return digest(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ])


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda own, step: digest(step["left"], own, step["right"]))


def siblings_of(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def with_siblings(nodes: DataFrame) -> DataFrame:
    """``nodes`` with the digests of the nodes to the left and to the right in their run, joined, and ``_slot``.

    Nodes have ``_key``, ``_pos`` (gapless from 0), ``_count`` (nodes of the key) and ``_digest``.  Every
    node looks at each fixed offset; what is outside its run is masked by its slot and by
    the run's length, which only a key's last run has smaller.  A window holds whole runs of
    ``BLOCK`` nodes, so a large key is spread.
    """
    block = Window.partitionBy("_key", F.expr(f"_pos div {BLOCK}")).orderBy("_pos")
    slot = F.pmod(F.col("_pos"), F.lit(FAN))
    length = F.least(F.lit(FAN), F.col("_count") - F.col("_pos") + slot)
    left = [F.when(slot >= k, F.lag("_digest", k).over(block)) for k in range(FAN - 1, 0, -1)]
    right = [F.when(slot + k < length, F.lead("_digest", k).over(block)) for k in range(1, FAN)]
    return nodes.select(
        "*", slot.alias("_slot"), F.concat_ws("", *left).alias("_left"), F.concat_ws("", *right).alias("_right")
    )


def _levels(nodes: DataFrame) -> list[DataFrame]:
    """The nodes of every level, from the given ones up to where each key has one node."""
    most = nodes.agg(F.max("_count")).first()[0] or 0
    levels = [nodes]
    while most > 1:
        first = with_siblings(levels[-1]).where("_slot = 0 AND _count > 1")
        parents = first.select(
            "_key", F.expr(f"_pos div {FAN}").alias("_pos"), F.ceil(F.col("_count") / FAN).cast("long").alias("_count"),
            digest(F.col("_digest"), F.col("_right")).alias("_digest"),
        )
        levels.append(write_once(parents, "merkle_level"))
        most = -(-most // FAN)
    return levels


def _paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The lowest level's nodes with ``_path``, their siblings up to the root, and the other columns of ``tops``.

    ``tops`` has the path of every key's last node.  A run's nodes share the path of their parent, which is
    joined to them from the top level down.
    """
    carried = [c for c in tops.columns if c not in ("_key", "_path")]
    above = None
    for level in reversed(range(len(levels))):
        nodes = levels[level]
        ends = nodes.where("_count = 1").select("_key", F.col("_pos").alias("_up")).join(tops, "_key")
        above = ends if above is None else above.unionByName(ends)
        near = with_siblings(nodes).withColumn("_up", F.expr(f"_pos div {FAN}")).join(above, ["_key", "_up"])
        step = F.array(F.struct(F.col("_left").alias("left"), F.col("_right").alias("right")))
        path = F.when(F.col("_count") > 1, F.concat(step, F.col("_path"))).otherwise(F.col("_path"))
        near = near.withColumn("_path", path).drop("_slot", "_left", "_right", "_up")
        if level:
            above = near.select("_key", F.col("_pos").alias("_up"), "_path", *carried)
            above = write_once(above, "merkle_paths")
    return near


def _tops(levels: list[DataFrame]) -> DataFrame:
    """(``_key``, ``_digest``) of every key's last node."""
    ends = [level.where("_count = 1").select("_key", "_digest") for level in levels]
    out = ends[0]
    for more in ends[1:]:
        out = out.unionByName(more)
    return out


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Nodes with ``_pos`` and ``_count``, by ``order`` within ``_key``."""
    numbered = running_totals(rows.withColumn("_one", F.lit(1).cast("long")), "_key", order, "_one", "_pos")
    counts = numbered.groupBy("_key").agg(F.count(F.lit(1)).alias("_count"))
    return numbered.drop("_one", "_part", "_place").join(counts, "_key")


def manifest(
    docs: DataFrame,
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    group_col: str = "source",
    carried: dict[str, Column] | None = None,
) -> DataFrame:
    """Per row: id, group, ``leaf``, ``position``, ``subroot``, ``root`` and ``path``.

    A row's leaf is the hash of ``columns`` (see ``leaf``).  Within a group, leaves ascend by id, and
    every 16 consecutive nodes have the hash of their digests as parent, until one
    is left: the subroot.  Subroots, by group in order of UTF-8 bytes with null first, lead to
    the root in the same way.  ``path`` holds, from leaf to root, the joined digests left and right of the
    node; a node that stays alone on its level has no step there.  ``carried`` adds columns computed
    where the rows are read.

    * Null ids come first; rows under one id are ordered by their leaves, so repeated rows
      are leaves of their own and equal tables have equal roots however they are stored.
    * Null texts and values are ``-``, empty ones ``0:``.  Columns not named are ignored.  No rows give no rows.

    Texts are hashed where they are read; only digests are shuffled.  A group is spread by
    ranges of ids and then by blocks of runs.  What is written above the leaves is a
    sixteenth of them with their paths, whose length follows the logarithm of the rows.
    """
    carried = carried or {}
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(group_col).alias("_group"),
        F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("_key"),
        leaf(*[F.col(c) for c in columns]).alias("_digest"), *[c.alias(f"_carried_{n}") for n, c in carried.items()],
    )
    rows = write_once(rows, "merkle_rows")  # the range sort looks at its input twice; texts are read once
    leaves = write_once(_numbered(rows, ["_id", "_digest"]), "merkle_leaves")
    levels = _levels(leaves)
    groups = _tops(levels).select(F.lit("").alias("_key"), F.col("_key").alias("_name"), "_digest")
    over = _levels(write_once(_numbered(groups, ["_name"]), "merkle_groups"))
    root = _tops(over).select("_key", F.col("_digest").alias("_root"), F.array().cast(_PATH).alias("_path"))
    subroots = _paths(over, root).select(
        F.col("_name").alias("_key"), F.col("_digest").alias("_subroot"), "_root", "_path"
    )
    proved = _paths(levels, write_once(subroots, "merkle_subroots"))
    return proved.select(
        F.col("_id").alias(id_col), F.col("_group").alias(group_col), F.col("_digest").alias("leaf"),
        F.col("_pos").alias("position"), F.col("_subroot").alias("subroot"), F.col("_root").alias("root"),
        F.col("_path").alias("path"), *[F.col(f"_carried_{n}").alias(n) for n in carried],
    )

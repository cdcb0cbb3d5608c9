"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from funil.settings import discard, write_once

SMALL = 500_000  # links (16 bytes each) that are settled in one partition, without shuffles


def connected_components(edges: DataFrame) -> DataFrame:
    """(``node``, ``component``) of every node on an edge ``_a`` - ``_b``; the component is its smallest node.

    In turn, every node's larger neighbours are linked to its smallest neighbour, then
    its smaller ones, until nothing changes: each component is then a star.  Minima
    are taken per task before they are shuffled, and a node with very many
    neighbours is joined, not collected.  Each half of a round is written and the round before removed,
    so its cost and lineage stay those of the edges.  Null ends and loops are left out.
    Rounds end by themselves: each moves links to smaller nodes or drops repeated ones, of which
    there are finitely many, and it takes about log2 squared of the nodes.

    Up to ``SMALL`` links fit one partition and need no shuffles; more are shuffled.  The
    steps are the same.
    """
    links = edges.where("_a <> _b").select(F.greatest("_a", "_b").alias("_u"), F.least("_a", "_b").alias("_v"))
    links = write_once(links.distinct(), "links")
    few = links.limit(SMALL + 1).count() <= SMALL
    before = None
    while True:
        these = links.coalesce(1) if few else links
        both = these.unionByName(these.select(F.col("_v").alias("_u"), F.col("_u").alias("_v")))
        lowest = both.groupBy("_u").agg(F.min("_v").alias("_m")).withColumn("_m", F.least("_u", "_m"))
        large = both.where("_v > _u").join(lowest, "_u").select(F.col("_v").alias("_u"), F.col("_m").alias("_v"))
        large = write_once(large.where("_u <> _v").distinct(), "links")  # read three times below
        halves = large.coalesce(1) if few else large
        lowest = halves.groupBy("_u").agg(F.min("_v").alias("_m"))
        small = halves.join(lowest, "_u")
        small = small.select(F.col("_v").alias("_u"), F.col("_m").alias("_v")).unionByName(
            small.select("_u", F.col("_m").alias("_v"))
        )
        last, links = links, write_once(small.where("_u <> _v").distinct(), "links")
        discard(last, large)
        now = links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("_u", "_v").cast("decimal(20,0)"))
        ).first()
        if now == before:
            stars = links.select(F.col("_u").alias("node"), F.col("_v").alias("component"))
            centres = links.select(F.col("_v").alias("node"), F.col("_v").alias("component"))
            return write_once(stars.unionByName(centres).distinct(), "components")
        before = now

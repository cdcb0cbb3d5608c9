"""A mixture of sources by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from funil.llm.running import running_totals
from funil.settings import write_once

WORD = r"[^\x20\x09-\x0D]+"


def _source_key(source: Column) -> Column:
    """A string that sorts sources by code point, null last."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(">"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """(``_key``, ``_source_size``, ``target``) of every source, from rows of ``_key`` and ``_size``.

    Sources in order of their keys weigh ``weights``, repeating, and share ``share`` of all
    sizes.  A target above ``most`` times its source's size stops there, and the others
    share what is left by weight, until no target is above.  Each round is one sum over
    the sources; it ends when a round stops no further source.
    """
    sources = sizes.groupBy("_key").agg(F.sum("_size").alias("_source_size")).withColumn("_one", F.lit(1).cast("long"))
    ranked = running_totals(sources.withColumn("_all", F.lit("")), "_all", ["_key"], "_one", "_rank")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.pmod("_rank", F.lit(len(weights))).cast("int"))
    ranked = write_once(ranked.select("_key", "_source_size", weight.alias("_weight")), "sources")
    limit = F.col("_source_size") * F.lit(float(most))
    budget = share * (ranked.agg(F.sum("_source_size")).first()[0] or 0)
    level, stopped = 0.0, -1
    while True:
        above = limit < level * F.col("_weight") if stopped >= 0 else F.lit(False)
        held = ranked.agg(
            F.count(F.when(above, 1)).alias("sources"),
            F.coalesce(F.sum(F.when(above, F.col("_source_size"))), F.lit(0)).alias("size"),
            F.coalesce(F.sum(F.when(~above, F.col("_weight"))), F.lit(0)).alias("weight"),
        ).first()
        if held["sources"] == stopped or not held["weight"]:
            break
        stopped, level = held["sources"], (budget - most * held["size"]) / held["weight"]
    target = F.when(limit < level * F.col("_weight"), limit).otherwise(level * F.col("_weight"))
    return ranked.select("_key", "_source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """The mixture: per document and pass over its source, what is taken of it and where.

    Columns: ``row`` (one number per input row), id, ``source_col``, ``size`` (words),
    ``source_size``, ``target``, ``epoch`` (1 for the first pass), ``finish``, ``position`` (words of
    the mixture before it) and ``taken`` (words taken, from the start of the text).

    The documents of a source queue in an order shuffled by ``seed``, again and again until the
    queue holds the source's target (see ``source_targets``); the document that reaches it is
    cut there, at a whole word, rounded up.  Its virtual finish time is the source's words so far over
    the target.  All queues together are range-sorted by it, and what is beyond the total
    budget, a rest of rounding, is cut off.

    * A null or empty text has no words: nothing is taken, its row is there.
    * Null sources are one source, last in order.  Null ids are shuffled like an empty one.
    * Repeated rows are documents of their own.  Rows with equal id and size may change places, which
      no column but ``row`` shows; all else depends on ids, sizes, sources and ``seed`` alone.
    * Every document has a row for its first pass at least.  Other columns are ignored.
      No rows give no rows.
    """
    if len(weights) == 0 or min(weights) <= 0 or share < 0 or most < 1:
        raise ValueError("weights must be positive, share not negative and most at least 1")
    if share > most:
        raise ValueError("share must not be above most: no mixture can have it")
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), _source_key(F.col(source_col)).alias("_key"),
        size.alias("_size"), order.alias("_shuffled"),
    )
    rows = write_once(rows, "sizes")  # the range sort looks at its input twice; texts are read once
    queues = running_totals(rows, "_key", ["_shuffled", "_size"], "_size")
    placed = queues.select(
        (F.shiftleft("_part", 33) + F.col("_place")).alias("row"), "_id", "_source", "_key", "_size", "_before"
    )
    placed = write_once(placed, "queues")
    targets = write_once(source_targets(placed, weights, share, most), "targets")
    last = F.greatest(F.lit(1), F.ceil(F.col("target") / F.col("_source_size"))).cast("int")
    passes = F.when(F.col("_source_size") > 0, last).otherwise(1)
    items = placed.join(targets, "_key").withColumn("epoch", F.explode(F.sequence(F.lit(1), passes)))
    before = (F.col("epoch") - 1) * F.col("_source_size") + F.col("_before")
    room = F.ceil("target") - before
    items = items.withColumn("_length", F.greatest(F.lit(0), F.least("_size", room)).cast("long"))
    end = before + F.when(F.col("_length") > 0, F.col("_length")).otherwise(F.col("_size"))
    items = items.where("epoch = 1 OR _length > 0").withColumn(
        "finish", F.when(F.col("target") > 0, end / F.col("target")).otherwise(0.0)
    )
    everything = running_totals(
        items.withColumn("_all", F.lit("")), "_all", ["finish", "_key", "epoch", "_before", "row"], "_length", "position"
    )
    budget = placed.agg(F.coalesce(F.floor(F.lit(float(share)) * F.sum("_size")), F.lit(0)).alias("b")).first()["b"]
    taken = F.greatest(F.lit(0), F.least("_length", F.lit(budget) - F.col("position")))
    return everything.select(
        "row", F.col("_id").alias(id_col), F.col("_source").alias(source_col), F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"), "target", "epoch", "finish", "position",
        taken.cast("long").alias("taken"),
    )

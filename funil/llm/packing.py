"""Mixture-controlled packing: deficit round-robin over one queue of documents per source."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from funil.llm import batches as B
from funil.llm.running import running_totals
from funil.llm.word_ids import word_ids
from funil.settings import write_once

WEIGHT_BITS = 16  # shares are kept in parts of 65,536
JOINT = "\0joint"  # stands for the joint queue of small sources


def weights(tokens: Mapping[str, int], shares: Mapping[str, float] | None) -> dict[str, int]:
    """Each queue's share of a window in parts of 2**16, one part at least, by largest remainders.

    Without ``shares`` a queue's share is its share of all tokens.  Given shares are
    brought to a sum of 1; queues they do not name get one part.
    """
    wanted = {q: float(shares.get(q, 0)) for q in tokens} if shares else {q: float(n) for q, n in tokens.items()}
    total, whole = sum(wanted.values()), 1 << WEIGHT_BITS
    if shares and (min(shares.values()) < 0 or total <= 0):
        raise ValueError("shares must not be negative, and one queue at least must have one")
    exact = {q: whole * share / total if total else 0.0 for q, share in wanted.items()}
    parts = {q: max(1, int(share)) for q, share in exact.items()}
    for q in sorted(exact, key=lambda q: (int(exact[q]) - exact[q], q))[: max(0, whole - sum(parts.values()))]:
        parts[q] += 1
    return parts


class Schedule:
    """Where each queue's tokens stand in the packed stream.

    In every round a queue's deficit grows by its share of a window, and it sends
    whole packets of ``packet`` tokens while its deficit covers them; what is left is
    carried into the next round.  Since deficits only depend on the round, the place
    of any packet follows from the queues' sizes alone.
    """

    def __init__(self, sizes: list[int], parts: list[int], window: int, packet: int):
        self.sizes, self.parts = np.array(sizes, np.int64), np.array(parts, np.int64)
        self.window, self.packet = window, packet

    def sent(self, rounds: np.ndarray) -> np.ndarray:
        """Tokens each queue has sent before a round, as rounds x queues."""
        high, low = rounds >> WEIGHT_BITS, rounds & ((1 << WEIGHT_BITS) - 1)
        quantum = self.window * self.parts
        credit = high[:, None] * quantum + ((low[:, None] * quantum) >> WEIGHT_BITS)
        return np.minimum(credit // self.packet * self.packet, self.sizes)

    def round_of(self, packets: np.ndarray, queue: int) -> np.ndarray:
        """The round in which a queue's packets are sent: the first whose credit covers them."""
        need = ((packets + 1) * self.packet) << WEIGHT_BITS
        quantum = self.window * int(self.parts[queue])
        return (need + quantum - 1) // quantum - 1

    def places(self, first: np.ndarray, length: np.ndarray, queue: int) -> tuple[np.ndarray, ...]:
        """Pieces of documents that take ``length`` tokens of a queue from ``first`` on.

        Gives the document's index, the piece's start in it, its length and its place.
        """
        document = np.repeat(np.arange(len(first)), (first + length - 1) // self.packet - first // self.packet + 1)
        steps = np.arange(len(document)) - np.searchsorted(document, document)
        packet = first[document] // self.packet + steps
        start = np.maximum(first[document], packet * self.packet)
        end = np.minimum(first[document] + length[document], (packet + 1) * self.packet)
        rounds, at = np.unique(self.round_of(packet, queue), return_inverse=True)
        others = np.zeros(len(rounds), np.int64)
        for k in range(0, len(rounds), 4096):
            part = rounds[k : k + 4096]
            others[k : k + 4096] = self.sent(part + 1)[:, :queue].sum(1) + self.sent(part)[:, queue + 1 :].sum(1)
        return self._cut(document, start - first[document], end - start, start + others[at])

    def _cut(self, document, start, length, place) -> tuple[np.ndarray, ...]:
        """Cut at window ends, then join what follows on within a document and window."""
        inside = np.minimum(length, self.window - place % self.window)
        rest = length - inside
        crossing = rest > 0
        document, start, length, place = (
            np.concatenate(both) for both in (
                (document, document[crossing]), (start, (start + inside)[crossing]),
                (inside, rest[crossing]), (place, (place + inside)[crossing]),
            )
        )
        order = np.lexsort((start, document))
        document, start, length, place = (x[order] for x in (document, start, length, place))
        new = np.ones(len(document), bool)
        new[1:] = (
            (document[1:] != document[:-1])
            | (place[1:] != place[:-1] + length[:-1])
            | (place[1:] % self.window == 0)
        )
        heads = np.flatnonzero(new)
        return document[heads], start[heads], np.add.reduceat(length, heads) if len(heads) else length, place[heads]


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    queue_col: str = "source",
    shares: Mapping[str, float] | None = None,
    packet: int = 64,
    max_queues: int = 1024,
) -> DataFrame:
    """Pieces of documents: id, ``queue``, ``start``, ``length``, ``doc_tokens``, ``sequence_id``, ``offset``, ``ids``.

    A document is its text's ids, then ``end_id``.  Every sequence holds ``window``
    tokens, the last one what is left.  Queues send ``packet`` tokens at a time, so
    every sequence has each queue's share to within a packet while all queues last,
    and the shares of those that still do afterwards.  ``shares`` names the wanted
    shares; without them they follow the data and all queues end together.  ``ids``
    holds the piece's ids as little-endian unsigned 32-bit integers.

    * A null or empty text is one token, ``end_id``.
    * A null queue is the queue "".  Of more than ``max_queues`` queues, those that ``shares`` names and
      then those with the most tokens keep a queue of their own, one less than ``max_queues`` of them.  The rest
      stand one after the other, by name, in one joint queue, which has their shares together.
    * Null or repeated ids are documents of their own; a document's place follows its
      place in the input.  Other columns are ignored.  No rows give no pieces.

    Texts are read once: tokens are written where they are made, with each document's
    place among its task's tokens of the queue.  The driver sees one total per queue;
    the totals per task and queue are a table, joined by size, and so are those of sources without a queue
    of their own.
    """

    def tokenise(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, part, before = word_ids(tokenizer, False), TaskContext.get().partitionId(), {}
        for batch in B.slices(given, "_text"):
            ids, bounds = ids_of.packed(batch.column("_text"), end_id)
            counts, starts = np.diff(bounds).tolist(), []
            for queue, n in zip(batch.column("queue").to_pylist(), counts):
                starts.append(before.get(queue, 0))
                before[queue] = starts[-1] + n
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([part] * len(counts), pa.int64()),
                 pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), B.binary(ids, bounds)],
                ["_id", "queue", "_part", "_start", "_tokens", "_ids"],
            )
        ids_of.rest()

    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.coalesce(F.col(queue_col).cast("string"), F.lit("")).alias("queue"),
        F.col(text_col).alias("_text"),
    )
    id_type = rows.schema[0].dataType
    schema = StructType().add("_id", id_type).add("queue", "string").add("_part", "long")
    schema = schema.add("_start", "long").add("_tokens", "long").add("_ids", "binary")
    stored = write_once(rows.mapInArrow(tokenise, schema), "tokens")

    per_task = stored.groupBy("queue", "_part").agg(F.sum("_tokens").alias("_sum"))
    earlier = Window.partitionBy("queue").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = write_once(
        per_task.withColumn("_base", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))), "bases"
    )
    totals = bases.groupBy("queue").agg(F.sum("_sum").alias("n"))
    own_first = F.col("queue").isin(list(shares)) if shares else F.lit(False)
    largest = totals.orderBy(own_first.desc(), F.desc("n"), "queue").limit(max_queues + 1).collect()
    kept = {r["queue"]: r["n"] for r in (largest if len(largest) <= max_queues else largest[: max_queues - 1])}
    queues, wanted = sorted(kept), shares
    sizes = {q: kept[q] for q in queues}
    numbered = spark.createDataFrame(list(zip(queues, range(len(queues)))), "queue string, _queue long")
    bases = bases.join(F.broadcast(numbered), "queue", "left")  # at most ``max_queues`` rows
    if len(largest) > max_queues:
        rest = totals.join(F.broadcast(numbered), "queue", "left_anti").withColumn("_all", F.lit(""))
        ahead = write_once(running_totals(rest, "_all", ["queue"], "n", "_ahead").select("queue", "n", "_ahead"), "joint")
        sizes[JOINT] = ahead.agg(F.sum("n")).first()[0]
        if shares:
            wanted = {q: s for q, s in shares.items() if q in kept}
            wanted[JOINT] = sum(shares.values()) - sum(wanted.values())
        bases = bases.join(ahead.select("queue", "_ahead"), "queue", "left").withColumns({
            "_base": F.col("_base") + F.coalesce("_ahead", F.lit(0)), "_queue": F.coalesce("_queue", F.lit(len(queues))),
        })
    parts = weights(sizes, wanted)
    plan = Schedule(list(sizes.values()), [parts[q] for q in sizes], window, packet)

    def place(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in B.slices(given, "_ids"):
            ids = batch.column("_ids").to_pylist()
            first, tokens = batch.column("_first").to_numpy(), batch.column("_tokens").to_numpy()
            owner = batch.column("_queue").to_numpy()
            found = []
            for queue in np.unique(owner):
                own = np.flatnonzero(owner == queue)
                document, *rest = plan.places(first[own], tokens[own], int(queue))
                found.append((own[document], *rest))
            document, start, length, at = (np.concatenate(x) for x in zip(*found))
            wide = {}
            for d in np.unique(document):
                width = len(ids[d]) // int(tokens[d])
                wide[d] = np.frombuffer(ids[d], f"<u{width}").astype("<u4").tobytes()
            for k in range(0, len(document), 1 << 15):
                d, s, n, a = (x[k : k + (1 << 15)] for x in (document, start, length, at))
                cut = [wide[i][4 * b : 4 * e] for i, b, e in zip(d.tolist(), s.tolist(), (s + n).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").take(pa.array(d)), batch.column("queue").take(pa.array(d)), pa.array(s),
                     pa.array(n), pa.array(tokens[d]), pa.array(a // window), pa.array(a % window),
                     pa.array(cut, pa.binary())],
                    [id_col, "queue", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
                )

    out = StructType().add(id_col, id_type).add("queue", "string")
    for name in ("start", "length", "doc_tokens", "sequence_id", "offset"):
        out = out.add(name, "long")
    return (
        stored.join(bases.select("queue", "_part", "_base", "_queue"), ["queue", "_part"])
        .select("_id", "queue", "_queue", (F.col("_base") + F.col("_start")).alias("_first"), "_tokens", "_ids")
        .mapInArrow(place, out.add("ids", "binary"))
    )

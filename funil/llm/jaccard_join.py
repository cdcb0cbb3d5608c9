"""Similarity join on word shingles by Jaccard similarity, with count vectors in R-trees.

Two sets link when they share ``percent`` of their union.  Then they share one of the
first quarter of each set's shingles (at 75 percent) in any order common to all sets.
These shingles cut the corpus into blocks, and blocks with the same centre are one
neighbourhood: sets that may link meet in one.  Sets are points whose coordinates count the
shingles per group of hashes; the sum of two points' coordinate minima bounds their
overlap.  Points are held in R-trees, and a pair of nodes whose largest coordinates
cannot reach the overlap is left out whole.  A task passes on only as many surviving pairs as join
what it has into components; these are compared shingle by shingle.  In large
neighbourhoods each set is compared with the centre first, and only what is not one component
after that goes into trees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from funil.llm import batches as B
from funil.llm.components import connected_components
from funil.llm.shingles import Minima, counts, fingerprint, groups, mix, points, shingle_sets
from funil.settings import discard, write_once

SLICE = 2 << 20  # bytes of text whose shingles are held at a time
GATHERED = 2_000_000  # shingles a task gathers before it counts them
FLUSH = 1_000_000  # block entries a task gathers before it passes them on
FREQUENT = 8  # sets from which a shingle counts as frequent
MOST_FREQUENT = 1_000_000  # frequent shingles that are told to all tasks
LEAF = 32  # points in a leaf
TOLD = 500_000  # ids that are broadcast at most; more are joined
TILE = 1024  # members of a neighbourhood that are compared at a time
TILE_SHINGLES = 2_000_000  # and shingles they have together
HOT = 1e-4  # share of block entries from which a shingle is hot: there are at most 1 / HOT of them


def first_shingles(own: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The shingles by which a set is found: those not frequent come first, then by hash."""
    n = len(own)
    wanted = n - -(-percent * n // 100) + 1
    if len(frequent) and n:
        at = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
        late = frequent[at] == own
        if late.any():
            own = np.concatenate([own[~late], own[late]])
    return own[:wanted]


def _variances(places: np.ndarray) -> np.ndarray:
    """Of every coordinate, some at a time: they are computed in doubles."""
    return np.concatenate([places[:, k : k + 128].var(0) for k in range(0, places.shape[1], 128)])


class RTree:
    """Points of a block in leaves of neighbours, with the bounds of every leaf."""

    def __init__(self, places: np.ndarray, sizes: np.ndarray, labels: np.ndarray):
        widest = places[:, np.argsort(-_variances(places))[:2]] if len(places) > LEAF else places[:, :2]
        slab = max(LEAF, int(np.sqrt(len(places) * LEAF)))
        by_size = np.argsort(sizes, kind="stable")
        slabs = np.empty(len(places), np.int64)
        slabs[by_size] = np.arange(len(places)) // slab
        self.order = np.lexsort((widest[:, 1], widest[:, 0], slabs))
        self.points, self.sizes, self.labels = places[self.order], sizes[self.order], labels[self.order]
        heads = np.arange(0, len(places), LEAF)
        self.top = np.maximum.reduceat(self.points, heads)
        self.least, self.most = np.minimum.reduceat(self.sizes, heads), np.maximum.reduceat(self.sizes, heads)
        self.one = np.minimum.reduceat(self.labels, heads), np.maximum.reduceat(self.labels, heads)

    def join(self, other: RTree, percent: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index pairs with different labels whose bound reaches the overlap; each once if ``same``."""
        for leaf in range(len(self.top)):
            later = slice(leaf if same else 0, None)
            bound = np.minimum(self.top[leaf], other.top[later]).sum(1)
            fits = (100 + percent) * bound >= percent * (self.least[leaf] + other.least[later])
            fits &= 100 * other.most[later] >= percent * self.least[leaf]
            fits &= 100 * self.most[leaf] >= percent * other.least[later]
            apart = (self.one[0][leaf] != self.one[1][leaf]) | (other.one[0][later] != other.one[1][later])
            fits &= apart | (self.one[0][leaf] != other.one[0][later])
            near = np.flatnonzero(fits) + (leaf if same else 0)
            if not len(near):
                continue
            mine = np.arange(leaf * LEAF, min((leaf + 1) * LEAF, len(self.points)))
            theirs = (near[:, None] * LEAF + np.arange(LEAF)).ravel()
            theirs = theirs[theirs < len(other.points)]
            step = max(LEAF, (1 << 17) // self.points.shape[1])  # keeps what is compared at a time small
            for k in range(0, len(theirs), step):
                part = theirs[k : k + step]
                overlap = np.minimum(self.points[mine][:, None], other.points[part][None]).sum(2)
                both = self.sizes[mine][:, None] + other.sizes[part][None]
                ok = (100 + percent) * overlap >= percent * both
                ok &= 100 * self.sizes[mine][:, None] >= percent * other.sizes[part][None]
                ok &= 100 * other.sizes[part][None] >= percent * self.sizes[mine][:, None]
                ok &= self.labels[mine][:, None] != other.labels[part][None]
                if same:
                    ok &= mine[:, None] < part[None]
                left, right = np.nonzero(ok)
                if len(left):
                    yield self.order[mine[left]], other.order[part[right]]


def _profiles(rows: DataFrame, words: int) -> DataFrame:
    """Per row: id, set size and fingerprint; besides, shingles found in three sets or more of one task's share."""

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["_kind", "_id", "_n", "_k1", "_k2"]
        held, size, seen = [], 0, set()
        id_type = None

        def often() -> pa.RecordBatch:
            values = np.concatenate(held)
            held.clear()
            values.sort()
            repeated = np.unique(values[2:][values[2:] == values[:-2]])
            times = np.searchsorted(values, repeated, "right") - np.searchsorted(values, repeated)
            values, n = repeated, len(repeated)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ones(n, np.int32)), pa.nulls(n, id_type), pa.array(times.astype(np.int64)),
                 pa.array(values.astype(np.int64)), pa.array(np.zeros(n, np.int64))], names
            )

        for batch in B.slices(given, "_text", SLICE):
            id_type = batch.schema.field("_id").type
            sets = shingle_sets(B.texts(batch, "_text"), words)
            prints = [fingerprint(s) for s in sets]
            for own, key in zip(sets, prints):
                if key not in seen:
                    seen.add(key)
                    held.append(own)
                    size += len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(sets), np.int32)), batch.column("_id"),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array([k for k, _ in prints], pa.int64()),
                 pa.array([k for _, k in prints], pa.int64())], names
            )
            if size > GATHERED:
                yield often()
                held, size, seen = [], 0, set()
        if held:
            yield often()

    schema = StructType().add("_kind", "integer").add("_id", rows.schema["_id"].dataType)
    schema = schema.add("_n", "long").add("_k1", "long").add("_k2", "long")
    return rows.mapInArrow(B.resting(run), schema)


def _frequent(profiles: DataFrame) -> np.ndarray:
    """Sorted hashes of shingles that many sets have.  They only decide an order, so a bound on them loses nothing."""
    often = profiles.where("_kind = 1").groupBy("_k1").agg(F.sum("_n").alias("_n"))
    often = often.where(F.col("_n") >= FREQUENT).orderBy(F.desc("_n"), "_k1").limit(MOST_FREQUENT)
    found = often.select("_k1").toArrow().column(0).to_numpy().astype(np.int64)
    return np.sort(found.view(np.uint64))


def _blocks(rows: DataFrame, frequent: np.ndarray, words: int, percent: int, parts: int) -> DataFrame:
    """(``_shingle``, ``_key``) of every set that shares one of its first shingles with another set.

    Entries travel packed by hash.  Where a task has several sets with a shingle, one of
    them goes to the shingle's partition to meet those of other tasks.  The rest, known
    to be shared, are spread over all partitions: a shingle that very many sets have
    gives a partition no more than one entry per task.
    """
    told = rows.sparkSession.sparkContext.broadcast(frequent)
    names = ["_shingle", "_key"]

    def emit(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen, size = [], set(), 0

        def flush() -> pa.RecordBatch:
            shingle = np.concatenate([s for s, _ in held])
            key = np.repeat(np.array([k for _, k in held], np.int64), [len(s) for s, _ in held])
            held.clear()
            order = np.lexsort((key, shingle))
            shingle = shingle[order]
            key = key[order]
            head = np.concatenate([[True], shingle[1:] != shingle[:-1]])
            state = (~head | np.concatenate([~head[1:], [False]])).astype(np.int8)  # of heads, whether they are shared
            state[~head] = 2
            home = (mix(shingle) % np.uint64(parts)).astype(np.int32)
            home[~head] = mix(shingle[~head] ^ mix(key[~head].view(np.uint64))) % np.uint64(parts)
            order = np.lexsort((state, home))
            shingle = shingle[order]
            key = key[order]
            state, home = state[order], home[order]
            heads = np.flatnonzero(
                np.concatenate([[True], (home[1:] != home[:-1]) | (state[1:] != state[:-1])])
            )
            cuts = np.append(heads, len(home))
            return pa.RecordBatch.from_arrays(
                [pa.array(home[heads].astype(np.int64)), pa.array(state[heads].astype(np.int64)),
                 B.binary(shingle, cuts), B.binary(key, cuts)],
                ["_part", "_state", "_shingles", "_keys"],
            )

        for batch in B.slices(given, "_text", SLICE):
            for own in shingle_sets(B.texts(batch, "_text"), words):
                key = fingerprint(own)
                if len(own) and key not in seen:
                    seen.add(key)
                    held.append((first_shingles(own, told.value, percent).copy(), key[0]))
                    size += len(held[-1][0])
            if size > FLUSH:
                yield flush()
                held, seen, size = [], set(), 0
        if held:
            yield flush()

    def meet(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {0: [], 1: []}
        for batch in given:
            for state, s, k in zip(*(batch.column(c).to_pylist() for c in ("_state", "_shingles", "_keys"))):
                s, k = np.frombuffer(s, np.int64), np.frombuffer(k, np.int64)
                if state == 2:
                    yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(k)], names)
                else:
                    met[state].append((s, k))
        if not (met[0] or met[1]):
            return
        shingle = np.concatenate([s for state in (0, 1) for s, _ in met[state]])
        key = np.concatenate([k for state in (0, 1) for _, k in met[state]])
        known = np.zeros(len(shingle), bool)
        known[sum(len(s) for s, _ in met[0]) :] = True
        met.clear()
        order = np.lexsort((known, key, shingle))
        shingle, key, known = shingle[order], key[order], known[order]
        # The same set may come from several tasks; the last of its entries says whether it is known to be shared.
        last = np.concatenate([(shingle[1:] != shingle[:-1]) | (key[1:] != key[:-1]), [True]])
        shingle, key, known = shingle[last], key[last], known[last]
        head = np.concatenate([[True], shingle[1:] != shingle[:-1]])
        shared = known | ~head | np.concatenate([~head[1:], [False]])
        yield pa.RecordBatch.from_arrays([pa.array(shingle[shared]), pa.array(key[shared])], names)

    packed = rows.select("_text").mapInArrow(B.resting(emit), "_part long, _state long, _shingles binary, _keys binary")
    return packed.repartition(F.col("_part")).mapInArrow(B.resting(meet), "_shingle long, _key long")


def _neighbourhoods(blocks: DataFrame) -> DataFrame:
    """(``_key``, ``_centre``): every set with the centres of its blocks, once each.

    A block's centre is its member with the most memberships.  Of the copies of a text that is
    the text itself rather than one of its edited versions, so a group of copies has few
    centres, whatever the number of its blocks.  Sets that share a block share its centre.
    """
    weights = blocks.groupBy("_key").agg(F.count(F.lit(1)).alias("_weight"))
    chosen = blocks.join(weights, "_key").groupBy("_shingle").agg(
        F.max(F.struct("_weight", "_key"))["_key"].alias("_centre"), F.count(F.lit(1)).alias("_size")
    )
    chosen = write_once(chosen, "centres")
    total = chosen.agg(F.sum("_size")).first()[0] or 0
    hot = chosen.where(F.col("_size") > HOT * total)  # bounded by the definition of hot, hence broadcast
    few = blocks.join(F.broadcast(hot.select("_shingle")), "_shingle", "left_anti")
    cold = few.join(chosen.where(F.col("_size") <= HOT * total), "_shingle")
    near = cold.select("_key", "_centre").unionByName(
        blocks.join(F.broadcast(hot), "_shingle").select("_key", "_centre")
    )
    near = write_once(near.distinct(), "neighbourhoods")
    discard(chosen)
    return near


def _points(rows: DataFrame, sets: DataFrame, near: DataFrame, words: int) -> DataFrame:
    """(``_key``, ``_n``, ``_point``) of the sets that have a neighbourhood."""

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in B.slices(given, "_text", SLICE):
            found = shingle_sets(B.texts(batch, "_text"), words)
            yield pa.RecordBatch.from_arrays(
                [pa.array([fingerprint(s)[0] for s in found], pa.int64()), pa.array([len(s) for s in found], pa.int64()),
                 pa.array([counts(s) for s in found], pa.binary())], ["_key", "_n", "_point"]
            )

    texts = _texts_of(rows, sets, near.select("_key").distinct())
    return write_once(texts.mapInArrow(B.resting(run), "_key long, _n long, _point binary"), "points")


def _texts_of(rows: DataFrame, sets: DataFrame, keys: DataFrame) -> DataFrame:
    """(``_id``, ``_text``) of the representatives of the sets named by ``_key``."""
    wanted = sets.join(keys, sets["_k1"] == keys["_key"], "left_semi").select(F.col("_rep").alias("_id")).distinct()
    wanted = write_once(wanted, "wanted")
    few = wanted.limit(TOLD + 1).count() <= TOLD
    return rows.join(F.broadcast(wanted) if few else wanted, "_id", "left_semi").select("_id", "_text")


def _bounded(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """The pairs (``_a``, ``_b``) of keys whose sizes and summed coordinate minima allow a link."""

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                a, b = part.column("_a").to_numpy(), part.column("_b").to_numpy()
                places, sides = {}, []
                for keys, packed in ((a, part.column("_pa").to_pylist()), (b, part.column("_pb").to_pylist())):
                    for key, point in zip(keys.tolist(), packed):
                        if key not in places:
                            places[key] = len(sides)
                            sides.append(point)
                minima = Minima([groups(p) for p in sides])
                centre = np.array([places[k] for k in b.tolist()])
                other = np.array([places[k] for k in a.tolist()])
                overlap = np.zeros(len(a), np.int64)
                for k in np.unique(centre):
                    own = np.flatnonzero(centre == k)
                    overlap[own] = minima.with_others(k, other[own])
                total = (part.column("_na").to_numpy() + part.column("_nb").to_numpy())
                kept = part.take(pa.array(np.flatnonzero((100 + percent) * overlap >= percent * total)))
                yield pa.RecordBatch.from_arrays([kept.column("_a"), kept.column("_b")], ["_a", "_b"])

    sides = [points.select(F.col("_key").alias(k), F.col("_n").alias(n), F.col("_point").alias(p))
             for k, n, p in (("_a", "_na", "_pa"), ("_b", "_nb", "_pb"))]
    joined = pairs.join(sides[0], "_a").join(sides[1], "_b")
    joined = joined.where((100 * F.col("_na") >= percent * F.col("_nb")) & (100 * F.col("_nb") >= percent * F.col("_na")))
    return joined.select("_a", "_b", "_na", "_nb", "_pa", "_pb").mapInArrow(B.resting(run), "_a long, _b long").distinct()


def _linked(rows: DataFrame, sets: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """Of the pairs (``_a``, ``_b``) of keys those that link, with the representatives ``_ra`` and ``_rb``.

    Only the texts of the sets in the pairs are taken apart again.
    """

    def take_apart(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in B.slices(given, "_text", SLICE):
            found = shingle_sets(B.texts(batch, "_text"), words)
            yield pa.RecordBatch.from_arrays(
                [pa.array([fingerprint(s)[0] for s in found], pa.int64()), batch.column("_id"),
                 B.lists([s.tobytes() for s in found], pa.int64())], ["_key", "_rep", "_set"]
            )

    keys = pairs.select(F.col("_a").alias("_key")).union(pairs.select("_b")).distinct()
    kind = rows.schema["_id"].dataType
    schema = StructType().add("_key", "long").add("_rep", kind).add("_set", ArrayType(LongType()))
    found = write_once(_texts_of(rows, sets, keys).mapInArrow(B.resting(take_apart), schema), "found")
    sides = [found.select(F.col("_key").alias(k), F.col("_rep").alias(r), F.col("_set").alias(s))
             for k, r, s in (("_a", "_ra", "_sa"), ("_b", "_rb", "_sb"))]
    joined = pairs.join(sides[0], "_a").join(sides[1], "_b")
    common, sizes = F.size(F.array_intersect("_sa", "_sb")), F.size("_sa") + F.size("_sb")
    linked = joined.where(100 * common >= percent * (sizes - common))
    linked = write_once(linked.select("_a", "_b", "_ra", "_rb").distinct(), "edges")
    discard(found)
    return linked


def _meetings(members: DataFrame, percent: int) -> DataFrame:
    """Members (``_key``, ``_centre``, ``_label``, ``_n``) with every meeting of two tiles that they take part in.

    A neighbourhood that is small is one tile.  Others are split by size: sets that link differ by
    less than a third, so each meets its own band and the next ones.  A band's members with the
    neighbourhood's most frequent label and the others have tiles of their own, by a hash of the
    key.  Every two tiles of bands side by side meet in one task, but two of the most
    frequent label need not.
    """
    step = float(np.log(100 / percent))
    per_label = members.groupBy("_centre", "_label").agg(
        F.count(F.lit(1)).alias("_members"), F.sum("_n").alias("_shingles")
    )
    main = per_label.groupBy("_centre").agg(
        F.max(F.struct("_members", "_label"))["_label"].alias("_main"),
        ((F.sum("_members") > TILE) | (F.sum("_shingles") > TILE_SHINGLES)).alias("_large"),
    )
    banded = members.join(main, "_centre").withColumns({
        "_band": F.when(F.col("_large"), F.floor(F.log(F.col("_n").cast("double")) / step)).otherwise(0).cast("int"),
        "_role": F.when(F.col("_large"), (F.col("_label") == F.col("_main")).cast("int")).otherwise(0),
    })
    sizes = banded.groupBy("_centre", "_band", "_role").agg(
        F.count(F.lit(1)).alias("_size"), F.sum("_n").alias("_shingles")
    )
    tiles = F.greatest(F.ceil(F.col("_size") / TILE), F.ceil(F.col("_shingles") / TILE_SHINGLES)).cast("int")
    plan = sizes.groupBy("_centre").agg(  # at most two entries per band, and few bands
        F.sort_array(F.collect_list(F.struct("_band", "_role", tiles.alias("tiles")))).alias("_plan")
    )
    placed = banded.join(plan, "_centre")
    own = F.expr("filter(_plan, x -> x._band = _band AND x._role = _role)[0].tiles")
    placed = placed.withColumn("_tile", F.pmod(F.xxhash64("_key"), own).cast("int"))
    placed = placed.withColumn("_self", F.struct("_band", "_role", "_tile"))
    others = F.expr(
        "flatten(transform(filter(_plan, x -> abs(x._band - _band) <= 1 AND (x._role = 0 OR _role = 0)),"
        " x -> transform(sequence(0, x.tiles - 1), t -> struct(x._band AS _band, x._role AS _role, t AS _tile))))"
    )
    met = placed.withColumn("_other", F.explode(others))
    return met.select(
        "_centre", F.least("_self", "_other").alias("_one"), F.greatest("_self", "_other").alias("_two"),
        (F.col("_self") > F.col("_other")).alias("_second"), "_key", "_label",
    )


def _tree_pairs(members: DataFrame, points_of: DataFrame, percent: int, forest: bool) -> DataFrame:
    """Pairs (``_a``, ``_b``) of keys with different labels (``_la``, ``_lb``, hashed) that may link.

    A meeting's points are in R-trees.  Pairs that the trees let through are bounded again over all groups.
    With ``forest``, a pair whose labels earlier pairs of the meeting join already is left out,
    so a meeting gives fewer pairs than it has labels.
    """
    meeting = ["_centre", "_one", "_two"]
    met = _meetings(members, percent).join(points_of, "_key").withColumn("_label", F.xxhash64("_label"))

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held = None, []

        def pairs() -> Iterator[pa.RecordBatch]:
            sides = [[r for r in held if not r[2]], [r for r in held if r[2]]]
            same = here[1] == here[2]
            if not sides[0] or not (sides[1] or same) or len({r[1] for r in held}) < 2:
                return
            rows = sides[0] + sides[1]
            keys, labels = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
            sizes, vectors = np.array([r[3] for r in rows]), [groups(r[4]) for r in rows]
            places, minima, n = points(vectors), Minima(vectors), len(sides[0])
            trees = [RTree(places[:n], sizes[:n], labels[:n])]
            trees += [] if same else [RTree(places[n:], sizes[n:], labels[n:])]
            root = {label: label for label in labels.tolist()}

            def find(label: int) -> int:
                while root[label] != label:
                    root[label] = label = root[root[label]]
                return label

            found = []
            for left, right in trees[0].join(trees[-1], percent, same):
                right = right + (0 if same else n)
                for one in np.unique(left):
                    others = right[left == one]
                    if forest:
                        mine = find(int(labels[one]))
                        others = others[[find(label) != mine for label in labels[others].tolist()]]
                    if not len(others):
                        continue
                    overlap = minima.with_others(int(one), others)
                    others = others[(100 + percent) * overlap >= percent * (sizes[one] + sizes[others])]
                    for other in others.tolist():
                        a, b = find(int(labels[one])), find(int(labels[other]))
                        if a != b or not forest:
                            root[b] = a if forest else root[b]
                            found.append((int(one), other))
            if found:
                one, other = np.array(found).T
                swap = keys[one] > keys[other]
                one, other = np.where(swap, other, one), np.where(swap, one, other)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[one]), pa.array(keys[other]), pa.array(labels[one]), pa.array(labels[other])],
                    ["_a", "_b", "_la", "_lb"],
                )

        for batch in given:
            place = [batch.column(c).to_pylist() for c in meeting]
            place = zip(place[0], *[[tuple(t.values()) for t in tiles] for tiles in place[1:]])
            data = [batch.column(c).to_pylist() for c in ("_key", "_label", "_second", "_n", "_point")]
            for at, row in zip(place, zip(*data)):
                if at != here:
                    if held:
                        yield from pairs()
                    here, held = at, []
                held.append(row)
        if held:
            yield from pairs()

    found = (
        met.select(*meeting, "_second", "_key", "_label", "_n", "_point")
        .repartition(*meeting).sortWithinPartitions(*meeting)
        .mapInArrow(B.resting(run), "_a long, _b long, _la long, _lb long")
    )
    if not forest:
        return found.distinct()
    low, high = F.least("_la", "_lb").alias("_la"), F.greatest("_la", "_lb").alias("_lb")
    one = found.groupBy(low, high).agg(F.min(F.struct("_a", "_b")).alias("_pair"))
    return one.select("_pair._a", "_pair._b", "_la", "_lb")


def similar_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 75
) -> DataFrame:
    """One row per input row: id, ``n_shingles`` and ``component_id``.

    A row's set holds the distinct runs of ``words`` words of its whole text, A-Z in
    lower case; a shorter text is one run.  Rows link when their sets share ``percent``
    of their union, and ``component_id`` is the smallest id that links reach.

    * A null text, or one without words, has an empty set and links with nothing.
    * Equal sets are one set: copies are counted, never paired.  Rows repeated under one
      id are the same document and take part with all their texts.
    * A row without id links with nothing and has a null component.
    * Other columns are ignored.  No rows give no rows.

    Shingles are told apart by 64-bit hashes, sets by 128 bits.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    profiles = write_once(_profiles(rows, words), "profiles")
    own = profiles.where("_kind = 0")
    sets = own.where("_n > 0 AND _id IS NOT NULL").groupBy("_k1", "_k2")
    sets = write_once(sets.agg(F.min("_id").alias("_rep"), F.first("_n").alias("_n")), "sets")
    frequent = _frequent(profiles)
    named = rows.where("_id IS NOT NULL")
    parts = max(256, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = write_once(_blocks(named, frequent, words, percent, parts), "blocks")
    near = _neighbourhoods(blocks)
    discard(blocks)
    points_of = _points(named, sets, near, words)

    def labelled(labels: DataFrame) -> DataFrame:
        """The neighbourhoods' members with their labels, where there are several."""
        known = sets.join(labels, F.col("_rep") == F.col("node"), "left")
        known = known.select(F.col("_k1").alias("_key"), F.coalesce("component", "_rep").alias("_label"), "_n")
        members = write_once(near.join(known, "_key"), "members")
        several = members.groupBy("_centre").agg(F.min("_label").alias("_low"), F.max("_label").alias("_high"))
        return members.join(several.where("_low <> _high").select("_centre"), "_centre", "left_semi")

    def linked(pairs: DataFrame) -> DataFrame:
        return _linked(named, sets, pairs, words, percent)

    # In large neighbourhoods, every set against the centre first, which joins most copies of a text.
    large = near.groupBy("_centre").agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") > TILE)
    large = write_once(large.select("_centre"), "large")
    edges = _repeated(own, sets)
    if not large.isEmpty():
        stars = near.join(large, "_centre", "left_semi").where("_key <> _centre")
        stars = stars.select(F.col("_key").alias("_a"), F.col("_centre").alias("_b"))
        edges = edges.unionByName(_ends(linked(write_once(_bounded(stars, points_of, percent), "near"))))
    edges = write_once(edges, "edges")
    labels = connected_components(edges)
    # Neighbourhoods that are not one component: as many pairs as would join what may link.
    members = write_once(labelled(labels), "open")
    pairs = write_once(_tree_pairs(members, points_of, percent, True), "near")
    found = linked(pairs)
    if not found.isEmpty():
        edges = write_once(edges.unionByName(_ends(found)), "edges")
        labels = connected_components(edges)
    # Where such a pair does not link after all, others that stood behind it may: all pairs of those labels.
    refuted = pairs.join(found, ["_a", "_b"], "left_anti")
    if not refuted.isEmpty():
        keys = refuted.select(F.col("_a").alias("_key")).union(refuted.select("_b")).distinct()
        members = write_once(labelled(labels), "open")
        again = members.join(keys, "_key", "left_semi").select("_label").distinct()
        members = members.join(write_once(again, "again"), "_label", "left_semi")
        pairs = write_once(_tree_pairs(members, points_of, percent, False).drop("_la", "_lb"), "near")
        labels = connected_components(edges.unionByName(_ends(linked(pairs))))
    discard(points_of)
    return (
        own.join(sets.select("_k1", "_k2", "_rep"), ["_k1", "_k2"], "left")
        .join(labels, F.col("_rep") == F.col("node"), "left")
        .select(
            F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"),
            F.when(F.col("_n") == 0, F.col("_id"))
            .when(F.col("_id").isNotNull(), F.coalesce("component", "_rep")).alias("component_id"),
        )
    )


def _ends(linked: DataFrame) -> DataFrame:
    """Links between representatives."""
    return linked.select(F.col("_ra").alias("_a"), F.col("_rb").alias("_b"))


def _repeated(own: DataFrame, sets: DataFrame) -> DataFrame:
    """Edges between the representatives of different texts under one id."""
    texts = own.where("_n > 0 AND _id IS NOT NULL").select("_id", "_k1", "_k2").distinct()
    several = texts.groupBy("_id").agg(F.count(F.lit(1)).alias("_texts")).where("_texts > 1").select("_id")
    reps = texts.join(several, "_id", "left_semi").join(sets.select("_k1", "_k2", "_rep"), ["_k1", "_k2"])
    return reps.select(F.col("_id").alias("_a"), F.col("_rep").alias("_b")).where("_a <> _b")

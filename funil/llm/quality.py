"""Quality rules: text statistics, and robust outliers among them per language and source."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, functions as F

from funil.settings import discard, write_once

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
_INDEX_BITS = 28  # of a window's place beside the upper bits of its hash

# The vector of a document, with the least standard deviation assumed for each entry.
# Added counts keep short texts, which say little, near the middle.
VECTOR: dict[str, tuple[str, float]] = {
    "_x0": ("ln((word_chars + 50) / (n_words + 10))", 0.05),  # mean word length
    "_x1": ("ln(1 + 100 * n_symbols / (word_chars + 50))", 0.25),  # symbols among characters
    "_x2": ("n_dup_lines / (n_lines + 3)", 0.07),  # repeated lines
    "_x3": ("n_repeat_words / (n_words + 20)", 0.08),  # words in repeated windows
}
COVERAGE = 0.75  # share of rows an estimate rests on
# The mean of (distance squared / 4) over the nearest 75 % of normal vectors with four
# entries is 1 / 1.486: covariances of that subset are too small by this factor.
CONSISTENCY = 1.486
CUTOFF = 18.467  # chi-square quantile 0.999 with four degrees of freedom
FINENESS = 1024  # bins of distances per power of two
STILL = 1e-4  # a determinant that falls by less than this share has stopped falling
SALTS = 16


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with the columns n_words, word_chars, n_lines, n_symbols, n_dup_lines, n_repeat_words.

    Repeated windows are found by sorting hashes within the row, so a text of n words
    takes n log n steps.  The upper bits of a hash select candidates, whole 64-bit
    hashes decide.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    place = (1 << _INDEX_BITS) - 1

    def occurrences(characters: str) -> Column:
        # These characters have one byte each.
        counts = [F.octet_length("_text") - F.octet_length(F.replace("_text", F.lit(c), F.lit(""))) for c in characters]
        return reduce(add, counts).cast("long")

    steps = [
        {"_text": text},
        {
            "_words": F.array_remove(F.split("_text", r"[\x20\x09-\x0D]+"), ""),
            "_lines": F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
            "word_chars": F.length("_text").cast("long") - occurrences(SPACES),
            "n_symbols": occurrences(SYMBOLS),
        },
        {
            "n_words": F.size("_words").cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_hashes": F.expr("transform(_words, x -> xxhash64(x))"),
        },
        {
            "_windows": F.expr(
                "transform(slice(_hashes, 1, greatest(size(_hashes) - 2, 0)),"
                " (x, i) -> xxhash64(x, get(_hashes, i + 1), get(_hashes, i + 2)))"
            )
        },
        {"_sorted": F.expr(f"sort_array(transform(_windows, (x, i) -> (x & {~place}L) | i))")},
        {
            "_near": F.expr(
                f"filter(_sorted, (x, i) -> shiftright(x ^ coalesce(get(_sorted, i - 1), ~x), {_INDEX_BITS}) = 0"
                f" OR shiftright(x ^ coalesce(get(_sorted, i + 1), ~x), {_INDEX_BITS}) = 0)"
            )
        },
        {
            "_near": F.expr(
                f"sort_array(transform(_near, x -> struct(get(_windows, CAST(x & {place}L AS INT)) AS h,"
                f" CAST(x & {place}L AS INT) AS p)))"
            )
        },
        {
            "_at": F.expr(
                "sort_array(transform(filter(_near, (x, i) -> coalesce(x.h = get(_near, i - 1).h, false)"
                " OR coalesce(x.h = get(_near, i + 1).h, false)), x -> x.p))"
            )
        },
        {
            "n_repeat_words": F.expr(
                "aggregate(transform(_at, (p, i) -> least(3, coalesce(get(_at, i + 1) - p, 3))), 0L, (a, x) -> a + x)"
            )
        },
    ]
    for step in steps:
        docs = docs.withColumns(step)
    return docs.drop("_text", "_words", "_lines", "_hashes", "_windows", "_sorted", "_near", "_at")


def base_failed() -> Column:
    """Too few words, or more than half of them in repeated windows."""
    return F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")


def _meet(rows: DataFrame, groups: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Rows with the columns of their group, of which there are few: these are repeated over salts, so a hot group is many tasks."""
    salted = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    return rows.withColumn("_salt", salt).join(salted, [key, "_salt"], how).drop("_salt")


def _cumulated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per group and ``_bin`` as ``_n``, those up to the bin as ``_upto``, those of the group as ``_all``."""
    counts = rows.groupBy(*keys, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*keys)
    return counts.withColumns({"_upto": F.sum("_n").over(group.orderBy("_bin")), "_all": F.sum("_n").over(group)})


def _factor(estimates: DataFrame, size: int, *carried: str) -> DataFrame:
    """The lower triangular factor of each covariance matrix, as columns _l{row}{column}, and its determinant ``_det``."""
    entries = []
    for i in range(size):
        for j in range(i + 1):
            rest = f"(_c{i}{j}" + "".join(f" - _l{i}{k} * _l{j}{k}" for k in range(j)) + ")"
            entries.append(f"sqrt{rest} AS _l{i}{j}" if i == j else f"{rest} / _l{j}{j} AS _l{i}{j}")
    det = " * ".join(f"_l{i}{i} * _l{i}{i}" for i in range(size))
    return estimates.selectExpr("_group", "_start", *[f"_m{i}" for i in range(size)], *entries, f"{det} AS _det", *carried)


def _distance(rows: DataFrame, names: list[str]) -> DataFrame:
    """Squared Mahalanobis distances, as ``distance``, of rows that carry their estimate."""
    steps = []
    for i, name in enumerate(names):
        rest = f"({name} - _m{i}" + "".join(f" - _l{i}{k} * _z{k}" for k in range(i)) + ")"
        steps.append(f"{rest} / _l{i}{i} AS _z{i}")
    return rows.selectExpr("*", *steps, " + ".join(f"_z{i} * _z{i}" for i in range(len(names))) + " AS distance")


def _sums(rows: DataFrame, values: list[Column], parts: dict[str, Column], carried: list[str]) -> DataFrame:
    """Per group and start the count, sums and sums of products of ``values`` over the rows of each part, under its name.

    ``carried`` are columns that are the same in all rows of a group and start.
    """
    rows = rows.withColumns({f"_y{i}": v for i, v in enumerate(values)})
    found = {"_w": F.lit(1.0), **{f"_s{i}": F.col(f"_y{i}") for i in range(len(values))}}
    found |= {f"_s{i}{j}": F.col(f"_y{i}") * F.col(f"_y{j}") for i in range(len(values)) for j in range(i + 1)}
    sums = [F.sum(F.when(chosen, v).otherwise(0.0)).alias(name + part)
            for part, chosen in parts.items() for name, v in found.items()]
    return rows.groupBy("_group", "_start").agg(*sums, *[F.min(c).alias(c) for c in carried])


def _moments(sums: DataFrame, size: int) -> DataFrame:
    """Means _a{i} and covariances _v{i}{j} besides the sums they come from."""
    found = sums.withColumns({f"_a{i}": F.col(f"_s{i}") / F.col("_w") for i in range(size)})
    return found.withColumns({
        f"_v{i}{j}": F.col(f"_s{i}{j}") / F.col("_w") - F.col(f"_a{i}") * F.col(f"_a{j}")
        for i in range(size) for j in range(i + 1)
    })


def _covariance(
    moments: DataFrame, scales: list[Column], centres: list[Column], factor: float, floors: list[float], *carried: str
) -> DataFrame:
    """Columns _m{i} and _c{i}{j} from moments of entries divided by ``scales``; floors are added to the diagonal."""
    pairs = [(i, j) for i in range(len(floors)) for j in range(i + 1)]
    return moments.select(
        "_group", "_start", *[c.alias(f"_m{i}") for i, c in enumerate(centres)],
        *[(factor * F.col(f"_v{i}{j}") * scales[i] * scales[j] + (floors[i] ** 2 if i == j else 0.0)).alias(f"_c{i}{j}")
          for i, j in pairs], *carried,
    )


def _starts(rows: DataFrame, names: list[str], floors: list[float]) -> DataFrame:
    """Three first estimates of each group: quartiles, plain moments, and signs.

    0: medians, and quartile distances without correlation.  1: mean and covariance of all rows.  2: medians, and the
    covariance of the directions in which rows lie from them, whatever their distance.
    """
    size = len(names)
    bins = F.array(*[
        F.struct(F.lit(i).alias("_entry"), F.floor(F.col(n) / (floors[i] / 4)).alias("_bin"))
        for i, n in enumerate(names)
    ])
    entries, keys = rows.select("_group", F.inline(bins)), ["_group", "_entry"]
    quarters = [
        F.min(F.when(F.col("_upto") >= share * F.col("_all"), F.col("_bin"))).alias(f"_q{k}")
        for k, share in ((1, 0.25), (2, 0.5), (3, 0.75))
    ]
    spread = _cumulated(entries, keys).groupBy(*keys).agg(*quarters)
    columns = []
    for i, floor in enumerate(floors):
        own = F.col("_entry") == i
        deviation = (F.col("_q3") - F.col("_q1")) * floor / 4 / 1.349
        columns.append(F.max(F.when(own, (F.col("_q2") + 0.5) * floor / 4)).alias(f"_m{i}"))
        columns.append(F.max(F.when(own, F.sqrt(deviation * deviation + floor * floor))).alias(f"_d{i}"))
    middle = write_once(spread.groupBy("_group").agg(*columns), "quartiles")

    zero = F.lit(0.0)
    quartiles = middle.select(
        "_group", F.lit(0).alias("_start"), *[f"_m{i}" for i in range(size)],
        *[(F.col(f"_d{i}") ** 2 if i == j else zero).alias(f"_c{i}{j}") for i in range(size) for j in range(i + 1)],
    )
    found = _meet(rows, middle, "_group")
    scaled = [(F.col(n) - F.col(f"_m{i}")) / F.col(f"_d{i}") for i, n in enumerate(names)]
    length = F.sqrt(reduce(add, [z * z for z in scaled]))
    both = found.withColumns({f"_u{i}": z for i, z in enumerate(scaled)}).withColumn("_length", length)
    both = both.withColumn("_start", F.explode(F.array(F.lit(1), F.lit(2))))
    plain = F.col("_start") == 1
    values = [F.when(plain, F.col(f"_u{i}")).when(F.col("_length") > 0, F.col(f"_u{i}") / F.col("_length")).otherwise(0.0)
              for i in range(size)]
    carried = [f"_{kind}{i}" for kind in "md" for i in range(size)]
    moments = write_once(_moments(_sums(both, values, {"": F.lit(True)}, carried), size), "moments")
    scales = [F.col(f"_d{i}") * F.when(plain, 1.0).otherwise(size ** 0.5) for i in range(size)]
    centres = [F.col(f"_m{i}") + F.when(plain, F.col(f"_a{i}") * F.col(f"_d{i}")).otherwise(0.0) for i in range(size)]
    return quartiles.unionByName(_covariance(moments, scales, centres, 1.0, floors))


def covariance_determinants(rows: DataFrame) -> DataFrame:
    """Per ``_group``: the centre and covariance factor of its most concentrated 75 % of vectors, and ``_det``.

    Each step takes the rows nearest by Mahalanobis distance and estimates anew from them, which does not increase
    the determinant of their covariance.  Three starts go on until their determinant no longer falls; the least of them
    is the group's.  Rows at the limit (distances within a thousandth) count with the same share each, so that exactly 75 %
    count and ties need no order.  The least deviations are added to the diagonal, so groups of equal rows have an
    estimate too.  Limits come from counts of bins, so no task sees a group's rows together; only groups and bins
    are shuffled.  The steps end: a determinant falls by ``STILL`` at least or stays, and cannot fall below that of the floors.
    """
    names, floors = list(VECTOR), [floor for _, floor in VECTOR.values()]
    size, keys = len(names), ["_group", "_start"]
    starts = _factor(_starts(rows, names, floors), size).withColumn("_det", F.lit(float("inf")))
    steps = [write_once(starts, "estimates")]  # a step's estimates, of those starts only whose determinant has fallen
    nearness = F.floor(F.log2(F.greatest("distance", F.lit(1e-6))) * FINENESS)
    limit = F.expr(f"percentile_disc({COVERAGE}) WITHIN GROUP (ORDER BY _bin)").cast("long")  # the bin in which the share is reached
    while not steps[-1].isEmpty():
        bins = _distance(_meet(rows, steps[-1], "_group"), names).select(*keys, nearness.alias("_bin"))
        limits = bins.groupBy(*keys).agg(limit.alias("_limit"), F.count(F.lit(1)).alias("_all"))
        limited = steps[-1].join(limits, keys)
        near = _distance(_meet(rows, limited, "_group"), names).withColumn("_bin", nearness).where("_bin <= _limit")
        # Entries are taken from the last centre, so no digits are lost.
        values = [F.col(n) - F.col(f"_m{i}") for i, n in enumerate(names)]
        parts = {"": F.col("_bin") < F.col("_limit"), "_edge": F.col("_bin") == F.col("_limit")}
        sums = _sums(near, values, parts, ["_all", "_det", *[f"_m{i}" for i in range(size)]])
        part = (COVERAGE * F.col("_all") - F.col("_w")) / F.col("_w_edge")
        total = [(F.col(c) + part * F.col(f"{c}_edge")).alias(c) for c in sums.columns if f"{c}_edge" in sums.columns]
        centres = [F.col(f"_m{i}") + F.col(f"_a{i}") for i in range(size)]
        sums = sums.select(*keys, F.col("_det").alias("_before"), *[f"_m{i}" for i in range(size)], *total)
        moments = write_once(_moments(sums, size), "moments")
        newer = _covariance(moments, [F.lit(1.0)] * size, centres, CONSISTENCY, floors, "_before")
        newer = _factor(newer, size, "_before").where(F.col("_det") < (1 - STILL) * F.col("_before"))
        steps.append(write_once(newer.drop("_before"), "estimates"))
        discard(moments)
    every = rows.sparkSession.read.schema(steps[0].schema).parquet(*[s._written_to for s in steps])
    least = F.min_by(F.struct(*[c for c in every.columns if c not in keys]), F.struct("_det", "_start"))
    found = write_once(every.groupBy("_group").agg(least.alias("_row")).select("_group", "_row.*"), "estimates")
    discard(*steps)
    return found


STATISTICS = ["n_words", "word_chars", "n_lines", "n_symbols", "n_dup_lines", "n_repeat_words"]
RESULTS = [*STATISTICS, "base_failed", "distance", "kept"]


def judge(rows: DataFrame, lang_col: str, source_col: str, cutoff: float, min_group: int) -> DataFrame:
    """Rows with statistics, and ``base_failed``, ``distance`` and ``kept`` besides."""
    keys = F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                      for c, n in ((lang_col, "lang"), (source_col, "source"))])
    entries = {name: F.expr(f"CAST({formula} AS DOUBLE)") for name, (formula, _) in VECTOR.items()}
    rows = rows.withColumns({"_key": keys, "base_failed": base_failed(), **entries})
    vectors = write_once(rows.where("NOT base_failed").select("_key", *entries), "vectors")
    large = vectors.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_group)
    large = write_once(large.select("_key", F.lit(True).alias("_large")), "groups")

    def grouped(rows: DataFrame) -> DataFrame:
        pooled = F.struct(F.col("_key.lang").alias("lang"), F.lit(None).cast("string").alias("source"))
        group = F.when(F.col("_large"), F.col("_key")).otherwise(pooled)
        return _meet(rows, large, "_key", "left").withColumn("_group", F.to_json(group)).drop("_large", "_key")

    points = write_once(grouped(vectors), "points")
    estimates = covariance_determinants(points)
    discard(vectors, points)
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff)
    judged = _distance(_meet(grouped(rows), estimates, "_group", "left"), list(VECTOR)).withColumn("kept", kept)
    return judged.drop(*[c for c in judged.columns if c[:2] in ("_m", "_l", "_z", "_d")], "_group", *VECTOR)


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    cutoff: float = CUTOFF,
    min_group: int = 50,
) -> DataFrame:
    """One row per input row: id, the statistics, ``base_failed``, ``distance`` and ``kept``.

    A row is rejected when it fails the base rules, or when the squared Mahalanobis
    distance of its vector from its language and source exceeds ``cutoff``, which one
    in a thousand normal vectors does.  Estimates rest on the rows that pass the base rules.
    Sources with fewer than ``min_group`` such rows share one group per language.

    * A null text has no words and fails the base rules.
    * Null languages and sources count as "".  Ids play no part, so null and repeated
      ids are judged like any others.
    * Where no row of a group passes the base rules, ``distance`` is null.
    * Other columns are ignored.  No rows give no rows.

    Texts are read once; statistics are written without them, and all later work is on
    those few numbers.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_source"),
                       F.col(lang_col).alias("_lang"), F.col(source_col).alias("_from"))
    rows = write_once(with_statistics(rows, "_source").drop("_source"), "statistics")
    return judge(rows, "_lang", "_from", cutoff, min_group).select(F.col("_id").alias(id_col), *RESULTS)


def accepted(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    cutoff: float = CUTOFF,
    min_group: int = 50,
) -> DataFrame:
    """The rows that ``quality_rules`` keeps, with their own columns.

    Rows are written once with their statistics beside them, so these are computed once
    and a row needs no id to find its verdict.  Texts are not shuffled while the
    estimates fit the broadcast limit.
    """
    columns = {c: F.col(c).alias(f"_own{k}") for k, c in enumerate(docs.columns)}
    names = {c: f"_own{k}" for k, c in enumerate(docs.columns)}
    rows = write_once(with_statistics(docs.select(*columns.values()), names[text_col]), "measured")
    kept = judge(rows, names[lang_col], names[source_col], cutoff, min_group).where("kept")
    return kept.select(*[F.col(own).alias(c) for c, own in names.items()])

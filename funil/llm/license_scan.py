"""Licence families of paragraphs: a trained classifier, with an unknown class, confirmed by templates."""

from __future__ import annotations

import json
import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

UNKNOWN = "unknown"

# Notices and sentences by which licence families are known.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to "
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "Apache License Version 2.0, January 2004. Terms and conditions for use, reproduction, and distribution.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "GNU General Public License version 2. Everyone is permitted to copy and distribute verbatim copies of this "
        "license document, but changing it is not allowed.",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation.",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
    ),
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Released under the Unlicense.",
    ),
    "CC0": (
        "Dedicated to the public domain under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
}
# Sentences about licences in general, which name no family.
GENERAL = (
    "All rights reserved.", "See the license file for details.", "You must have a valid license to drive.",
    "The terms and conditions apply to all orders.", "The public was free to use the software.",
    "Copyright of the photographs remains with their owners.", "A version of this work was released in January.",
    "The state granted a licence to sell copies under the law.", "The general public may visit at no charge.",
)
BLOCK = 30  # words; a window is two blocks one after the other, and the next one starts a block later
WINDOW = 2 * BLOCK
FIELD_BITS = 21  # of a class's sum over a window; three classes share a 64-bit integer
STEPS = (1 << 14) - 1  # a coefficient is a whole number up to this, so that 120 of them fit a field


@dataclass(frozen=True)
class Scanner:
    """A fitted classifier: coefficients as classes x features, intercepts, calibration; the last class is unknown."""

    coefficients: np.ndarray
    intercepts: np.ndarray
    slope: float
    intercept: float
    families: tuple[str, ...]

    @property
    def step(self) -> float:
        """What a step of a whole-number coefficient is worth."""
        return 2 * max(float(np.abs(self.coefficients).max()), 1e-12) / STEPS

    def packed(self) -> np.ndarray:
        """Per feature the coefficients of all classes as whole numbers, three to a 64-bit integer.

        All classes are raised by the same amount, which the difference of two classes does not show.
        """
        whole = np.rint(self.coefficients / self.step + STEPS / 2).astype(np.int64)
        out = np.zeros((-(-len(whole) // 3), whole.shape[1]), np.int64)
        for k, row in enumerate(whole):
            out[k // 3] += row << (FIELD_BITS * (k % 3))
        return out

    def least_steps(self, probability: float) -> list[int]:
        """Per family the least lead over the unknown class, in steps, that has a probability."""
        wanted = (math.log(probability / (1 - probability)) - self.intercept) / self.slope
        leads = wanted - (self.intercepts[:-1] - self.intercepts[-1])
        return [int(math.ceil(lead / self.step)) for lead in leads]


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _hashes(words: str | Column) -> Column:
    return F.transform(words, lambda word: F.xxhash64(word))


def _indexes(hashes: str, features: int) -> tuple[Column, Column]:
    """Feature numbers of the words, and of the pairs by their first words; the last word has no pair."""
    single = F.expr(f"transform({hashes}, h -> CAST(pmod(h, {features}L) AS INT))")
    pair = F.expr(
        f"transform(slice({hashes}, 1, size({hashes}) - 1),"
        f" (h, i) -> CAST(pmod(xxhash64(h, get({hashes}, i + 1)), {features}L) AS INT))"
    )
    return single, F.when(F.size(hashes) > 1, pair).otherwise(F.array().cast("array<int>"))


def units(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(``_id``, ``paragraph``, ``words``, ``hashes``): every paragraph with its lines joined, and each of its lines.

    A line without a letter or digit ends a paragraph.  Comment markers are no words, or
    dropped where they are letters.  Whole texts are covered; every word is hashed once.

    Generators are outer ones, here and in ``scan``: for the others Spark would test first whether an array
    has elements, and compute all that leads to it a second time.
    """
    parts = F.split(text_col, r"\n(?=[^\p{L}\p{N}\n]*(?:(?i:rem|dnl)[^\p{L}\p{N}\n]*)?(?:\n|\z))")
    blocks = docs.select(F.col(id_col).alias("_id"), F.posexplode_outer(parts).alias("paragraph", "_block"))
    plain = F.regexp_replace("_block", r"(?im)^[^\S\n]*(?:rem|dnl)(?=\s|\z)", " ")
    lines = F.filter(F.transform(F.split(plain, "\n"), _words), lambda x: F.size(x) > 0)
    rows = blocks.select("_id", "paragraph", lines.alias("_lines"))
    rows = rows.withColumn("_hashed", F.transform("_lines", _hashes))

    def each(lines: str) -> Column:
        joined = F.array(F.flatten(lines))
        return F.when(F.size(lines) > 1, F.concat(joined, F.col(lines))).otherwise(joined)

    zipped = F.arrays_zip(each("_lines").alias("words"), each("_hashed").alias("hashes"))
    return rows.select("_id", "paragraph", F.inline_outer(zipped).alias("words", "hashes"))


def _sample(docs: DataFrame, text_col: str, sample: int) -> DataFrame:
    """``sample`` different texts (``_text``), those with the smallest hashes; only hashes are sorted."""
    hashed = docs.where(F.length(text_col) > 0).select(F.xxhash64(text_col).alias("_hash"))
    least = hashed.distinct().orderBy("_hash").limit(sample).agg(F.max("_hash")).first()[0]
    chosen = docs.where((F.length(text_col) > 0) & (F.xxhash64(text_col) <= F.lit(least).cast("long")))
    return chosen.groupBy(F.xxhash64(text_col).alias("_hash")).agg(F.min(text_col).alias("_text")).select("_text")


def _examples(docs: DataFrame, text_col: str, sample: int, families: tuple[str, ...]) -> DataFrame:
    """Labelled rows: templates, alone and amid ordinary words, and ordinary lines; ``held`` ones are for calibration."""
    spark = docs.sparkSession
    named = r"(?i)licen[sc]|copyright|warrant|apache|mozilla|gnu|creative commons|public domain|unlicense"
    ordinary = (
        _sample(docs, text_col, sample)
        .select(F.explode(F.split("_text", "\n")).alias("_line"))
        .where(~F.col("_line").rlike(named))
        .select(_words(F.col("_line")).alias("words")).where("size(words) > 0")
        .select(F.slice("words", 1, WINDOW).alias("words"))
        .orderBy(F.xxhash64("words"), "words").limit(sample)
        .withColumns({"label": F.lit(float(len(families) - 1)), "weight": F.lit(1.0)})
    )
    known = []
    for label, family in enumerate(families):
        for text in TEMPLATES.get(family, GENERAL):
            half = " ".join(text.split()[: max(5, 2 * len(text.split()) // 3)])
            for variant in (text, f"{text} See LICENSE for details.", f"This file is part of the project. {text}",
                            f"Copyright 2020 the authors. {text} All rights reserved.", half):
                known.append((variant, float(label), max(1.0, sample / 200)))
    templates = spark.createDataFrame(known, "_line string, label double, weight double")
    rows = templates.select(_words(F.col("_line")).alias("words"), "label", "weight").unionByName(ordinary)
    return rows.withColumn("held", F.pmod(F.xxhash64("words"), F.lit(5)) == 0)


def train(docs: DataFrame, text_col: str = "text", sample: int = 1000, features: int = 1 << 12) -> Scanner:
    """Fit a multinomial logistic regression on counts of hashed words and word pairs, and calibrate its unknown class.

    Ordinary lines come from a bounded ``sample`` of different texts, the smallest by a hash, and
    number ``sample`` at most; families come from the templates.  Rows held out of the
    fit give a logistic curve: of the lead that a licence's own family has over the unknown
    class against the largest lead that any family has on other rows.
    """
    families = (*TEMPLATES, UNKNOWN)
    rows = _examples(docs, text_col, sample, families).withColumn("hashes", _hashes("words"))
    single, pair = _indexes("hashes", features)
    rows = rows.withColumn("_terms", F.concat(single, pair).cast("array<string>"))
    count = CountVectorizerModel.from_vocabulary([str(k) for k in range(features)], "_terms", "_features")
    # The rows are bounded by ``sample`` and the templates.
    rows = count.transform(rows).select("_terms", "_features", "label", "weight", "held").cache()
    fitted = LogisticRegression(
        featuresCol="_features", labelCol="label", weightCol="weight", family="multinomial", regParam=1e-3, maxIter=60
    ).fit(rows.where("NOT held"))
    coefficients, intercepts = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    margins = []
    for row in rows.where("held").select("_terms", "label", "weight").collect():  # bounded by the sample
        terms = np.array(row["_terms"], int)
        scores = coefficients[:, terms].sum(1) + intercepts
        leads, label = scores[:-1] - scores[-1], int(row["label"])
        licence = label < len(leads)
        margins.append(([float(leads[label] if licence else leads.max())], float(licence), row["weight"]))
    rows.unpersist()
    table = docs.sparkSession.createDataFrame(margins, "_l array<double>, label double, weight double")
    curve = LogisticRegression(featuresCol="_v", labelCol="label", weightCol="weight", regParam=1e-3).fit(
        table.select(array_to_vector("_l").alias("_v"), "label", "weight")
    )
    return Scanner(coefficients, intercepts, float(curve.coefficients[0]), float(curve.intercept), families)


def _templates() -> Column:
    """The words of every family's templates, by the number of the family; of a fixed size."""
    words = [
        [list(dict.fromkeys(w for w in re.split(r"[^\w]+|_", text.lower()) if w)) for text in texts]
        for texts in TEMPLATES.values()
    ]
    return F.from_json(F.lit(json.dumps(words)), "array<array<array<string>>>")


def _share(words: Column, of: Column) -> Column:
    return F.size(F.array_intersect(words, of)) / F.nullif(F.size(words), F.lit(0))


def _leads(rows: DataFrame, scanner: Scanner, min_probability: float) -> DataFrame:
    """``rows`` of ``hashes`` with ``_found``: of every window of the words the families above the probability, if any.

    A block's sum over its words and pairs gives all classes at once.  A window's is that of its
    two blocks, so nothing is looked up twice.  Sums of whole numbers are exact.
    """
    packed, unknown = scanner.packed(), len(scanner.families) - 1
    tables = [F.split(F.lit(",".join(map(str, part.tolist()))), ",").cast("array<long>") for part in packed]
    single, pair = _indexes("hashes", scanner.coefficients.shape[1])
    rows = rows.withColumns({"_single": single, "_pair": pair})
    rows = rows.withColumn("_blocks", F.expr(
        f"transform(sequence(0, (size(_single) - 1) div {BLOCK}), b -> concat("
        f"slice(_single, CAST(b * {BLOCK} + 1 AS INT), {BLOCK}), slice(_pair, CAST(b * {BLOCK} + 1 AS INT), {BLOCK})))"
    ))

    def total(block: Column, table: Column) -> Column:
        return F.aggregate(block, F.lit(0).cast("long"), lambda so_far, k: so_far + F.get(table, k))

    def sums(block: Column) -> Column:
        return F.array(*[total(block, table) for table in tables])

    rows = rows.withColumn("_sums", F.transform("_blocks", sums))

    def field(at: Column, family: Column) -> Column:
        part = F.floor(family / 3).cast("int")
        both = F.get(F.get("_sums", at), part) + F.coalesce(F.get(F.get("_sums", at + 1), part), F.lit(0))
        return _shifted(both, family)

    least = F.array(*[F.lit(k) for k in scanner.least_steps(min_probability)])
    windows = F.sequence(F.lit(0), F.greatest(F.size("_sums") - 2, F.lit(0)))

    def found(at: Column) -> Column:
        rest = field(at, F.lit(unknown))
        families = F.filter(
            F.sequence(F.lit(0), F.lit(unknown - 1)), lambda k: field(at, k) - rest >= F.get(least, k)
        )
        leads = F.transform(families, lambda k: F.struct((field(at, k) - rest).alias("steps"), k.alias("k")))
        return F.struct(at.alias("at"), leads.alias("families"))

    return rows.withColumn("_found", F.filter(F.transform(windows, found), lambda window: F.size(window["families"]) > 0))


def _shifted(value: Column, family: Column) -> Column:
    """The sum of a class out of the integer that holds those of three."""
    place = F.pmod(family, F.lit(3))
    shifted = F.when(place == 0, value).when(place == 1, F.shiftrightunsigned(value, FIELD_BITS)).otherwise(
        F.shiftrightunsigned(value, 2 * FIELD_BITS)
    )
    return shifted.bitwiseAND(F.lit((1 << FIELD_BITS) - 1))


def scan(
    docs: DataFrame,
    scanner: Scanner | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_probability: float = 0.5,
    min_overlap: float = 0.6,
) -> DataFrame:
    """Paragraphs that state a licence: id, ``paragraph``, ``family``, ``probability``, ``overlap``, ``confirmed``.

    Paragraphs end at blank lines and are judged as a whole, with wrapped lines joined,
    and line by line, in overlapping windows of 60 words; a pair of words counts where its first word is.
    Every family is judged for itself, so a window may have several; a paragraph has one row per
    family: its surest confirmed window, or its surest one where none is confirmed.
    ``probability`` is the calibrated probability of the family against the unknown class; what is below
    ``min_probability`` for all families is unknown and left out.  A prediction is ``confirmed``
    when the window has ``min_overlap`` of the words of one of the family's templates, and, where another
    family leads in the window, of those of its words that the other's template lacks: what one
    licence explains does not confirm a relative of it.

    * A null or empty text has no paragraphs.
    * Null ids stay null; rows repeated under one id count as one document.
    * Other columns are ignored.  No rows, or no licence, give no rows.

    Everything up to the prediction runs where the text is read; only paragraphs with a
    licence are shuffled.  The classifier and templates are of a fixed size.
    """
    scanner = scanner or train(docs, text_col)
    judged = _leads(units(docs, id_col, text_col), scanner, min_probability)
    found = judged.select("_id", "paragraph", "words", F.inline_outer("_found")).where("at IS NOT NULL")
    ahead = F.array(*[F.lit(float(b - scanner.intercepts[-1])) for b in scanner.intercepts[:-1]])
    leads = F.transform("families", lambda x: F.struct(
        (x["steps"] * F.lit(scanner.step) + F.get(ahead, x["k"])).alias("lead"), x["k"].alias("k")))
    found = found.select(
        "_id", "paragraph", F.slice("words", F.col("at") * BLOCK + 1, F.lit(WINDOW)).alias("words"), leads.alias("leads")
    ).withColumn("best", F.array_max("leads")["k"])
    found = found.select("_id", "paragraph", "words", "best", F.inline("leads").alias("lead", "k"))

    def nearest(family: Column) -> Column:
        """(``share``, ``words``) of the family's template of which the window has the largest share."""
        return F.array_max(F.transform(
            F.get(_templates(), family), lambda t: F.struct(_share(t, F.col("words")).alias("share"), t.alias("words"))
        ))

    found = found.withColumns({"own": nearest(F.col("k")), "first": nearest(F.col("best"))})
    further = F.array_except("own.words", "first.words")
    confirmed = (F.col("own.share") >= min_overlap) & (
        (F.col("k") == F.col("best")) | (F.coalesce(_share(further, F.col("words")), F.lit(0.0)) >= min_overlap)
    )
    names = F.array(*[F.lit(f) for f in scanner.families])
    probability = 1 / (1 + F.exp(-(F.lit(scanner.slope) * F.col("lead") + F.lit(scanner.intercept))))
    best = F.max(F.struct(
        confirmed.alias("confirmed"), probability.alias("probability"), F.col("own.share").alias("overlap")
    )).alias("_best")
    return found.groupBy("_id", "paragraph", F.get(names, F.col("k")).alias("family")).agg(best).select(
        F.col("_id").alias(id_col), "paragraph", "family", "_best.probability", "_best.overlap", "_best.confirmed"
    )


def document_licences(
    docs: DataFrame, scanner: Scanner | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, ``families`` (confirmed ones, in order), ``paragraphs`` and ``probability``.

    ``paragraphs`` counts the confirmed ones, ``probability`` is that of the surest; both
    are 0 for a document without a licence.  Rows repeated under one id share the result.
    """
    confirmed = scan(docs, scanner, id_col, text_col).where("confirmed")
    per_document = confirmed.groupBy(F.col(id_col).alias("_id")).agg(
        F.array_join(F.sort_array(F.collect_set("family")), ",").alias("families"),
        F.count_distinct("paragraph").alias("paragraphs"), F.max("probability").alias("probability"),
    )
    rows = docs.select(F.col(id_col).alias("_of"))
    return rows.join(per_document, F.col("_of").eqNullSafe(F.col("_id")), "left").select(
        F.col("_of").alias(id_col), F.coalesce("families", F.lit("")).alias("families"),
        F.coalesce("paragraphs", F.lit(0)).cast("long").alias("paragraphs"),
        F.coalesce("probability", F.lit(0.0)).alias("probability"),
    )

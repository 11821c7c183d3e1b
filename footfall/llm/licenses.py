"""Licence scans: a trained classifier of paragraphs, confirmed by templates.

Word n-grams (single words and pairs) of a paragraph are hashed into a sparse
vector, and a multinomial logistic regression names the licence family, ``unknown``
being one of them. It is trained on variants of the templates (words left out or
replaced, text before and after) and on the corpus's own paragraphs as ``unknown``: all
lines it can be asked about (those with a key word, see below) that are no notice. Lines with
the same features travel as one row with their number as its weight. The threshold is calibrated on
a half of these lines that is held out, all of it: the probability of a licence that only
a small share exceeds, in steps of ``STEP``.
A prediction counts once it is confirmed: enough of the words of one of the family's
templates have to stand in the paragraph, one that no other family has among them (if the
template has such words), so that the licence of a family that isn't listed takes no listed name.

A notice may be wrapped. So what is judged are all windows of adjacent lines with a word,
from one line up to as many as a template's words can be spread over: the lines between
the first and the last of a wrapped notice hold words of it alone. Of windows that
overlap, the one with the largest share of a template counts, then the one of fewest lines; a
window with two lines that are notices by themselves doesn't count. A notice may also stand inside
a long line. So pieces of 16, 32 and 64 words of it are judged too, each half over the one
before: a template lies whole in one that isn't much longer. Of the first and last line of a window only the words
next to the others are. A line counts as one paragraph, however many notices it holds.

Which windows overlap is found by sorting a text's windows by line; only those of one run of
overlapping windows are compared with each other. A text of many thousand notices is no worse than many texts.

Only what can be confirmed is classified. A window with a share ``s`` of a template's ``m``
different words lacks at most ``m - ceil(s m)`` of them, so it has one of any ``m - ceil(s m) + 1``
at least: the key words, chosen among the less common ones. Windows without a key word
are passed over, then those that reach the share with no template. Both follow from the
condition for confirming, so that changes no result. Texts are cut into words once, and those
with a key word are written down for training and scan.

Everything on the main path is a DataFrame operation or a model of Spark's own
library. Defined cases: NULL and empty texts have no paragraphs. A paragraph is a line with a word in
it, or a window of several; its number is that of its first line. Repeated rows are scanned
alike and counted once. An empty corpus trains on the templates alone and gives an empty
result.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from footfall.llm.words import NOT_ALNUM, alnum_words, ascii_lower
from footfall.sources.workspace import materialize

UNKNOWN = "unknown"

# Short notices by family.
TEMPLATES = {
    "agpl": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "This software is released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-nc-nd": [
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ],
    "cc-by-nc-sa": [
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ],
    "cc-by-nd": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related rights to this work. Released under CC0 1.0.",
        "This work is dedicated to the public domain under CC0 1.0.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "isc": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "SPDX-License-Identifier: ISC",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "proprietary": [
        "All rights reserved.",
        "All rights reserved. No part of this work may be reproduced without the written permission of the publisher.",
    ],
}

# Common words, the last choice for key words.
COMMON = set("a all and any are as be by can for has in is it may no not of on or part that the this to under use with without work you".split())

# Lines with these words are no examples of the unknown class.
MARKS = r"(?i)licen[cs]e|redistribution|permission|waived|public domain|free software"


@dataclass(frozen=True)
class LicenseParams:
    n_features: int = 1 << 14
    variants: int = 60
    false_positive_rate: float = 0.01
    min_template_share: float = 0.6


def _template_words() -> list[list[str]]:
    """The different words of every template, in order."""
    texts = [text for family in sorted(TEMPLATES) for text in TEMPLATES[family]]
    return [list(dict.fromkeys(w for w in re.split(NOT_ALNUM, t.lower()) if w)) for t in texts]


def _known_words() -> list[str]:
    return sorted({w for words in _template_words() for w in words})


def _own_words(family: str, line: str) -> list[str]:
    """The template's words that no template of another family has."""
    split = lambda text: {w for w in re.split(NOT_ALNUM, text.lower()) if w}
    others = [split(t) for f, texts in TEMPLATES.items() if f != family for t in texts]
    return sorted(split(line).difference(*others))


def _most_words() -> int:
    """Words of the longest template."""
    return max(
        len([w for w in re.split(NOT_ALNUM, t) if w]) for texts in TEMPLATES.values() for t in texts
    )


# Half the lengths of the pieces of a line; the last is no less than the longest template.
PIECES = (8, 16, 32)


def key_words(share: float) -> list[str]:
    """Words of which every text with ``share`` of a template's words has one at least."""
    keys: set[str] = set()
    for words in _template_words():
        lacking = len(words) - math.ceil(share * len(words) - 1e-9)
        keys.update(sorted(words, key=lambda w: (w in COMMON, w.isdigit()))[: lacking + 1])
    return sorted(keys)


def _has_key(words: Column, params: LicenseParams) -> Column:
    keys = key_words(params.min_template_share)
    return F.exists(words, lambda w: w.isin(keys))


def _confirmable(words: Column, params: LicenseParams) -> Column:
    """Whether the words have the share of some template, of any family.

    The template words among them become bits, looked at once for all templates.
    """
    known = _known_words()
    parts = [known[i : i + 63] for i in range(0, len(known), 63)]

    def bits(part: list[str]) -> Column:
        places = F.lit(part)
        return F.aggregate(
            F.array_intersect(places, words),
            F.lit(0).cast("long"),
            lambda seen, w: seen.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), (F.array_position(places, w) - 1).cast("int"))),
        )

    def enough(found: Column) -> Column:
        """Whether the bits of all parts hold the share of a template's."""
        tests = []
        for template in _template_words():
            masks = [sum(1 << part.index(w) for w in template if w in part) for part in parts]
            n = [F.bit_count(F.get(found, k).bitwiseAND(F.lit(mask).cast("long"))) for k, mask in enumerate(masks) if mask]
            tests.append(reduce(Column.__add__, n) / len(template) >= params.min_template_share)
        return reduce(Column.__or__, tests)

    # In an array of one, so that the bits are found once and not for every template.
    found = F.array(F.array(*[bits(part) for part in parts]))
    return F.coalesce(F.exists(found, enough), F.lit(False))


def keyed_lines(docs: DataFrame, params: LicenseParams = LicenseParams()) -> DataFrame:
    """Texts with a key word, cut up: ``doc_id``, ``of_text``, words by line, which have a key word."""
    lines = F.transform(F.split(ascii_lower(F.col("text")), "\n"), lambda x: alnum_words(x))
    keyed = F.transform("lines", lambda w: _has_key(w, params))
    rows = docs.select("doc_id", F.xxhash64("text").alias("of_text"), lines.alias("lines"))
    return rows.withColumn("keyed", keyed).where(F.array_contains("keyed", True))


def windows(rows: DataFrame, params: LicenseParams = LicenseParams()) -> DataFrame:
    """``doc_id``, ``of_text``, ``paragraph``, ``n_lines`` and ``words`` of windows with a key word.

    ``rows`` are those of ``keyed_lines``.
    """
    between = _most_words()
    rows = rows.withColumn("sizes", F.transform("lines", lambda w: F.size(w)))

    def reach(i: Column) -> Column:
        """Lines of the longest window from line ``i``; 0 where it has no word."""
        start = F.struct(
            F.when(F.get("sizes", i) > 0, 1).otherwise(0).alias("n"),
            F.lit(0).alias("inner"),
            (F.get("sizes", i) > 0).alias("open"),
        )

        def add(state: Column, size: Column) -> Column:
            more = state.open & (size > 0) & (state.inner <= between)
            return F.struct(
                (state.n + more.cast("int")).alias("n"),
                (state.inner + size).alias("inner"),
                more.alias("open"),
            )

        return F.aggregate(F.slice("sizes", i + 2, F.lit(between + 2)), start, add, lambda x: x.n)

    def of_line(i: Column) -> Column:
        sizes = F.filter(
            F.sequence(F.lit(1), F.greatest(reach(i), F.lit(1))),
            lambda n: (F.get("sizes", i) > 0) & F.array_contains(F.slice("keyed", i + 1, n), True),
        )
        return F.transform(sizes, lambda n: F.struct(i.alias("paragraph"), n.alias("n_lines")))

    near = F.flatten(F.transform(F.sequence(F.lit(0), F.size("lines") - 1), of_line))

    def pieces(words: Column) -> Column:
        """A line's words unless they are too many, and its overlapping pieces of several lengths."""
        n = F.size(words)
        none = F.array().cast("array<array<string>>")

        def of_length(half: int) -> Column:
            last = F.ceil((n - 2 * half) / half).cast("int")
            starts = F.sequence(F.lit(0), F.greatest(last, F.lit(0)))
            cut = F.transform(starts, lambda k: F.slice(words, k * half + 1, F.lit(2 * half)))
            return F.when(n > 2 * half, cut).otherwise(none)

        whole = F.when(n <= 2 * PIECES[-1], F.array(words)).otherwise(none)
        return F.concat(whole, *[of_length(half) for half in PIECES])

    def joined(x: Column) -> Column:
        """A window's words: the first line's last, those between, and the last line's first."""
        first, last = F.get("lines", x.paragraph), F.get("lines", x.paragraph + x.n_lines - 1)
        skipped = F.greatest(F.size(first) - between, F.lit(0))
        inner = F.flatten(F.slice("lines", x.paragraph + 2, F.greatest(x.n_lines - 2, F.lit(0))))
        return F.concat(
            F.slice(first, skipped + 1, F.lit(between)), inner, F.slice(last, F.lit(1), F.lit(between))
        )

    places = F.transform(
        near,
        lambda x: F.struct(
            x.paragraph.alias("paragraph"),
            x.n_lines.alias("n_lines"),
            F.when(x.n_lines == 1, pieces(F.get("lines", x.paragraph)))
            .otherwise(F.array(joined(x)))
            .alias("pieces"),
        ),
    )
    of_windows = rows.select("doc_id", "of_text", F.inline(places))
    words = of_windows.select("doc_id", "of_text", "paragraph", "n_lines", F.explode("pieces").alias("words"))
    return words.where(_has_key(F.col("words"), params))


# Stands for any word that no template has: what surrounds a notice says nothing about it.
OTHER_WORD = "*"


def _grams(words: Column) -> Column:
    """Single words and pairs."""
    n_pairs = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.zip_with(
        F.slice(words, F.lit(1), n_pairs),
        F.slice(words, F.lit(2), n_pairs),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return F.concat(words, pairs)


def _gram_set(words: Column) -> Column:
    """The different grams, words that no template has standing for each other; in order."""
    known = _known_words()
    seen = F.transform(words, lambda w: F.when(w.isin(known), w).otherwise(OTHER_WORD))
    return F.array_sort(F.array_distinct(_grams(seen)))


def _vectors(rows: DataFrame, params: LicenseParams) -> DataFrame:
    hashing = HashingTF(
        inputCol="grams", outputCol="features", numFeatures=params.n_features, binary=True
    )
    return hashing.transform(rows)


def _template_rows(spark: SparkSession) -> DataFrame:
    rows = [
        (family, text, _own_words(family, text))
        for family, texts in sorted(TEMPLATES.items())
        for text in texts
    ]
    made = spark.createDataFrame(rows, "family string, line string, own array<string>")
    return made.withColumn("words", alnum_words(ascii_lower(F.col("line"))))


def unknown_lines(rows: DataFrame, params: LicenseParams = LicenseParams()) -> DataFrame:
    """``words`` of all lines with a key word that are no notice; ``rows`` are those of ``keyed_lines``."""
    words = F.col("words")
    lines = rows.select(F.inline(F.arrays_zip(F.col("lines").alias("words"), "keyed")))
    return lines.where(
        F.col("keyed") & ~F.array_join(words, " ").rlike(MARKS) & ~_confirmable(words, params)
    ).select("words")


def template_variants(unknown: DataFrame, params: LicenseParams) -> DataFrame:
    """``family`` and ``words``: variants of every template.

    A variant leaves out one word in eight, by a hash, and stands between words of a long
    unknown line (other words, where there is none), up to as many on each side as a piece of a
    long line can hold.
    """
    templates = _template_rows(unknown.sparkSession).withColumn(
        "variant", F.explode(F.sequence(F.lit(0), F.lit(params.variants - 1)))
    )
    left_out = lambda x, i: F.pmod(F.xxhash64(x, i, F.col("variant")), F.lit(8)) != 0
    varied = templates.withColumn(
        "words",
        F.when(F.col("variant") == 0, F.col("words")).otherwise(F.filter("words", left_out)),
    )
    # One line per variant; as many of its words as can stand around a notice.
    most = 4 * _most_words()
    place = F.xxhash64("words")
    around = F.max_by(
        F.slice("words", F.lit(1), F.lit(most)), F.struct(F.least(F.size("words"), F.lit(most)), place)
    )
    surroundings = unknown.groupBy(F.pmod(place, F.lit(params.variants)).alias("number")).agg(around.alias("around"))
    around = F.coalesce("around", F.lit([OTHER_WORD] * most))
    # Half of the variants stand alone or nearly so.
    most = F.when(F.col("variant") % 2 == 0, 5).otherwise(2 * _most_words())
    n_before = F.pmod(F.xxhash64("variant", "line"), most).cast("int")
    n_after = F.pmod(F.xxhash64("line", "variant"), most).cast("int")
    return varied.join(surroundings, F.col("variant") == F.col("number"), "left").select(
        "family",
        F.concat(
            F.slice(around, F.lit(1), n_before), "words", F.slice(around, n_before + 1, n_after)
        ).alias("words"),
    )


# Steps in which the threshold is found.
STEP = 1 / 4096


@dataclass(frozen=True)
class LicenseModel:
    classifier: LogisticRegressionModel
    families: list[str]
    threshold: float


def train(docs: DataFrame, params: LicenseParams = LicenseParams()) -> LicenseModel:
    """Fits and calibrates on ``docs`` and the templates."""
    return train_on(materialize(keyed_lines(docs, params), "lines"), params)


def train_on(rows: DataFrame, params: LicenseParams = LicenseParams()) -> LicenseModel:
    """The same from the rows of ``keyed_lines``; every unknown line counts in the fit or the threshold."""
    unknown = unknown_lines(rows, params)
    grams = _gram_set(F.col("words")).alias("grams")
    # Equal lines are all in one half.
    held = F.pmod(F.xxhash64("grams"), F.lit(2)) == 1
    kinds = unknown.select(grams).groupBy("grams").agg(F.count("*").alias("n")).withColumn("held", held)
    kinds = materialize(kinds, "unknown")
    variants = materialize(template_variants(unknown, params).select("family", grams), "variants")
    families = [*sorted(TEMPLATES), UNKNOWN]
    label = F.array_position(F.lit(families), F.col("family")) - 1
    # The unknown lines weigh no more than the variants together, however many there are.
    n_taught = kinds.where("NOT held").agg(F.sum("n")).first()[0] or 0
    weight = min(1.0, variants.count() / max(n_taught, 1))
    # Lines without a word of any template, for a corpus that has no line to learn from.
    plain = rows.sparkSession.createDataFrame(
        [([OTHER_WORD], float(params.variants)), ([OTHER_WORD, f"{OTHER_WORD} {OTHER_WORD}"], float(params.variants))],
        "grams array<string>, weight double",
    )
    taught = (
        kinds.where("NOT held")
        .select("grams", (F.col("n") * weight).alias("weight"))
        .unionAll(plain)
        .select(F.lit(UNKNOWN).alias("family"), "grams", "weight")
        .unionAll(variants.select("family", "grams", F.lit(1.0)))
    )
    taught = _vectors(taught, params).select(label.cast("double").alias("label"), "features", "weight")
    fitted = LogisticRegression(
        family="multinomial", regParam=0.001, maxIter=200, tol=1e-6, weightCol="weight"
    ).fit(materialize(taught))
    held_out = _license_chance(fitted.transform(_vectors(kinds.where("held"), params)), len(families))
    return LicenseModel(fitted, families, max(0.3, min(0.9, _edge(held_out, params))))


def _edge(held_out: DataFrame, params: LicenseParams) -> float:
    """The least step that no more than ``false_positive_rate`` of the lines exceed; 0.5 without any."""
    step = F.ceil(F.col("chance") / STEP)
    # A bounded number of rows: one per step.
    counts = held_out.groupBy(step.alias("step")).agg(F.sum("n").alias("n")).orderBy("step").collect()
    above = total = sum(r.n for r in counts)
    for r in counts:
        above -= r.n
        if above <= params.false_positive_rate * total:
            return r.step * STEP
    return 0.5


def _license_chance(scored: DataFrame, n: int) -> DataFrame:
    """One more column: the probability that it is any licence."""
    return scored.withColumn(
        "chance", 1 - F.get(vector_to_array("probability"), F.lit(n - 1))
    )


def scan(docs: DataFrame, model: LicenseModel, params: LicenseParams = LicenseParams()) -> DataFrame:
    """Confirmed licence paragraphs: ``doc_id``, ``paragraph``, ``family``, ``chance``, ``share``."""
    return scan_rows(materialize(keyed_lines(docs, params), "lines"), model, params)


def scan_rows(rows: DataFrame, model: LicenseModel, params: LicenseParams = LicenseParams()) -> DataFrame:
    """The same from the rows of ``keyed_lines``."""
    spark = rows.sparkSession
    likely = windows(rows, params).where(_confirmable(F.col("words"), params))
    scored = _license_chance(
        model.classifier.transform(_vectors(likely.withColumn("grams", _gram_set(F.col("words"))), params)), len(model.families)
    )
    licence_only = F.slice(
        vector_to_array("probability"), F.lit(1), F.lit(len(model.families) - 1)
    )
    named = scored.where(F.col("chance") >= model.threshold).withColumn(
        "predicted",
        F.element_at(
            F.lit(model.families),
            F.array_position(licence_only, F.array_max(licence_only)).cast("int"),
        ),
    )
    templates = _template_rows(spark).groupBy("family").agg(
        F.collect_list(F.struct("words", "own")).alias("templates")
    )

    def share_of(t: Column) -> Column:
        named = (F.size(t.own) == 0) | F.arrays_overlap(t.own, F.col("words"))
        share = F.size(F.array_intersect(t.words, "words")) / F.size(F.array_distinct(t.words))
        return F.when(named, share).otherwise(0.0)

    shares = F.transform("templates", share_of)
    # One row per family of the fixed list above.
    confirmed = (
        named.join(F.broadcast(templates), F.col("predicted") == F.col("family"))
        .withColumn("share", F.array_max(shares))
        .where(F.col("share") >= params.min_template_share)
    )
    found = confirmed.select(
        "doc_id", "of_text", "paragraph", "n_lines", "family", "chance", "share"
    ).distinct()
    return _apart(_without_lists(found)).select("doc_id", "paragraph", "family", "chance", "share")


def _of_text() -> WindowSpec:
    return Window.partitionBy("doc_id", "of_text").orderBy("paragraph")


def _without_lists(found: DataFrame) -> DataFrame:
    """Without windows that hold two lines found by themselves."""
    paragraph, n_lines = F.col("paragraph"), F.col("n_lines")
    # As many lines as the longest window has, so that a frame holds no more than these.
    ahead = _of_text().rangeBetween(0, _most_words() + 1)
    lines = F.collect_set(F.when(n_lines == 1, paragraph)).over(ahead)
    inside = F.size(F.filter("lines", lambda y: y < paragraph + n_lines))
    return found.withColumn("lines", lines).where((n_lines == 1) | (inside < 2)).drop("lines")


def _apart(found: DataFrame) -> DataFrame:
    """Of windows that overlap the best; those of a text in runs that overlap no other run."""
    paragraph, n_lines = F.col("paragraph"), F.col("n_lines")
    before = _of_text().rowsBetween(Window.unboundedPreceding, -1)
    so_far = _of_text().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = F.coalesce(F.max(paragraph + n_lines).over(before), F.lit(0))
    runs = found.withColumn("starts", (paragraph >= reached).cast("int"))
    runs = runs.withColumn("run", F.sum("starts").over(so_far))
    order = (-F.col("share")).alias("order")
    one = F.struct(order, "n_lines", "paragraph", "family", "chance", "share")
    of_run = runs.groupBy("doc_id", "of_text", "run").agg(F.array_sort(F.collect_list(one)).alias("found"))

    def overlap(x: Column, y: Column) -> Column:
        return (x.paragraph < y.paragraph + y.n_lines) & (y.paragraph < x.paragraph + x.n_lines)

    # Each window, in order, that overlaps none taken before.
    taken = F.aggregate(
        "found",
        F.filter("found", lambda x: F.lit(False)),
        lambda taken, x: F.when(F.exists(taken, lambda y: overlap(x, y)), taken).otherwise(
            F.array_append(taken, x)
        ),
    )
    return of_run.select("doc_id", F.inline(taken))


def scan_documents(
    docs: DataFrame, params: LicenseParams = LicenseParams()
) -> DataFrame:
    """Per document: ``doc_id``, its licence ``families`` in order and ``n_paragraphs``."""
    docs = docs.select("doc_id", "text")
    rows = materialize(keyed_lines(docs, params), "lines")
    found = scan_rows(rows, train_on(rows, params), params)
    by_doc = found.groupBy("doc_id").agg(
        F.array_sort(F.collect_set("family")).alias("families"),
        F.countDistinct("paragraph").alias("n_paragraphs"),
    )
    by_doc = by_doc.withColumnRenamed("doc_id", "of")
    none = F.array().cast("array<string>")
    return (
        docs.select("doc_id")
        .distinct()
        .join(by_doc, F.col("doc_id").eqNullSafe(F.col("of")), "left")
        .select(
            "doc_id",
            F.coalesce("families", none).alias("families"),
            F.coalesce("n_paragraphs", F.lit(0)).cast("long").alias("n_paragraphs"),
        )
    )

"""Licence scan: a trained paragraph classifier on word n-grams, confirmed by templates.

Paragraphs end at lines without letters or digits.  Within one, wrapped lines are joined up
to a line that closes a sentence, so that one-line notices next to each other stay apart;
stretches of more than ``WINDOW`` words are cut into overlapping ones.  A text is cut only if
one search over the whole of it finds an anchor, a family's short name or a word that the
fitted regression finds indicative; a name that is an ordinary word of some language counts
beside a notice word alone.  A stretch with one of these is classified by a sparse
multinomial logistic regression on the presence of word 1- to 3-grams.

The regression learns from labelled sentences only: the templates and short names below and
their variants with a word left out, against sentences that merely talk about licences and
ordinary ones (class ``unknown``).  Part of them is held out to calibrate that class: a
family needs the probability, against unknown, that 99 % of the held-out variants of
templates reach.  The model does not depend on the scanned table, so neither does a
document's result depend on other documents.

A likely family counts only if a template of it confirms it: most of the template's word
pairs stand in the stretch, or most of the stretch's in the template, or a short name stands
in a notice's place (``under MIT``, ``MIT/Apache-2.0``).  A template that stands in the
stretch whole confirms its family by itself and leaves no other to resemblance.  A paragraph
with an anchor or a name whose stretches give no family is ``unknown``.

Everything runs as DataFrame expressions and Spark's own DataFrame estimators; the table is
read once.
"""

from __future__ import annotations

import json
from itertools import groupby

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize

VOCABULARY = 4096
CONFIRM = 0.6
LEAST_PROBABILITY, MOST_PROBABILITY = 0.5, 0.9  # bounds of the calibrated threshold
KEPT = 0.99  # share of the held-out variants above the threshold
HELD_OUT = 4  # one labelled sentence in so many calibrates
SHARE = 0.2  # least probability of a family among all classes
WINDOW, STEP = 96, 48  # words; the longest template has fewer than STEP
INDICATIVE = 1.0  # a word's weight for some family above that for unknown

# Beginnings of words that speak of licences
ANCHORS = ("licen", "copyright", "spdx", "warrant", "redistribut", "permission is", "public domain", "creative commons", "copyleft")

# Short notices as projects use them, by family
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
        "This project is released under the Apache 2.0 license.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
        "SPDX-License-Identifier: MIT",
        "This software is distributed under the terms of the MIT license.",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Released under the GPLv3 license.",
    ),
    "gpl-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "Released under the GPLv2 license.",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "agpl-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "public-domain": (
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has dedicated all copyright to the public domain.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
}
UNKNOWN = (
    "Please renew your driver's license before it expires.", "All rights reserved. Copyright 2019 by the author.",
    "The warranty covers parts and labor for two years.", "A licensed electrician should install the unit.",
    "Licensed under the terms of the agreement with the vendor.", "See the LICENSE file for details.",
    "No part of this publication may be copied without permission.", "The city issued a liquor license to the restaurant.",
    "This software is proprietary and confidential.", "Copyright notices must not be removed.",
    "You need a license to fish in this lake.", "The license fee is due in version 2 of the contract.",
    "Apache helicopters were licensed for export.", "Students at MIT need no parking license.",
    "Permission is required to enter the building.", "Released under a license of the publisher.",
    # ordinary sentences with the words of notices, also of other languages
    "This is a list of the files that you can find in the library.", "The work is subject to the following conditions.",
    "You may not use this at work, except with a free copy of the program.", "The public version of the software is found in the source code.",
    "Any person may deal with it at a later time, or publish it in any form.", "The foundation published a general study of the forms of law.",
    "He went to school at MIT under the old terms of the program.", "The project is under way and the terms are as stated.",
    "The author has dedicated the book to all who found it possible.", "To a large extent the use of the source is governed by style.",
    "International attribution of the work is associated with documentation.", "It is free of charge, without any restriction of use.",
    "The Apache people hold the land under terms of the treaty.", "A license plate was found under the car.",
    "Das Haus ist mit einer Lizenz und mit einem Garten versehen.", "Diese Software kommt mit License Manager und mit vielen Teilen.",
    "Wir fahren mit dem Auto unter die Linden, nicht mit der Bahn.", "Die Version ist mit dem Programm frei in der Bibliothek.",
    "Le public est dans la version de la source, avec une copie libre.", "La licence de conduire est sous les conditions de la loi.",
    "El permiso es de la persona con la forma de uso y de la obra.", "La version libre del programa es para el uso de la casa.",
)
FAMILIES = tuple(TEMPLATES)
NAMES = {
    "apache-2.0": ("apache", "apache-2.0", "apache2", "apache-2"),
    "mit": ("mit",),
    "gpl-3.0": ("gplv3", "gpl-3.0", "gpl-3", "gpl3", "gpl-3.0-or-later", "gpl-3.0-only"),
    "gpl-2.0": ("gplv2", "gpl-2.0", "gpl-2", "gpl2", "gpl-2.0-or-later", "gpl-2.0-only"),
    "lgpl": ("lgpl", "lgplv2", "lgplv2.1", "lgplv3", "lgpl-2.1", "lgpl-3.0", "lgpl-2.1-or-later", "lgpl-3.0-or-later"),
    "agpl-3.0": ("agpl", "agplv3", "agpl-3.0", "agpl-3.0-or-later", "agpl-3.0-only"),
    "bsd": ("bsd", "bsd-2-clause", "bsd-3-clause"),
    "mpl-2.0": ("mpl", "mpl-2.0", "mplv2"),
    "cc-by": ("cc-by", "cc-by-4.0"),
    "cc-by-sa": ("cc-by-sa", "cc-by-sa-4.0", "by-sa"),
    "cc-by-nc": ("cc-by-nc", "cc-by-nc-4.0", "by-nc"),
    "public-domain": ("cc0", "cc0-1.0", "unlicense"),
}
ALL_NAMES = tuple(n for names in NAMES.values() for n in names)
# Words of a notice before and after a short name
BEFORE = ("under", "license", "licence", "licensed", "licenced", "dual", "dual-licensed", "spdx-license-identifier")
AFTER = ("license", "licence", "licensed", "licenced", "terms")
# Names that are words of a language or a people's name: they count in a notice's place alone
ORDINARY_NAMES = ("mit", "apache")


def any_of(words) -> str:
    """A pattern for one of the words, their first letters looked at once."""
    escape = lambda w: w.replace(".", "[.]")
    by_letter = groupby(sorted(words), key=lambda w: w[0])
    return "(?:" + "|".join(f"{c}(?:{'|'.join(escape(w[1:]) for w in ws)})" for c, ws in by_letter) + ")"


def strong_pattern() -> str:
    """What an asked stretch must hold, lower-cased, to be an unknown licence if no family comes out."""
    names = any_of(n for n in ALL_NAMES if n not in ORDINARY_NAMES)
    odd, gap = any_of(ORDINARY_NAMES), "[^a-z0-9]{1,3}(?:the[^a-z0-9])?"
    beside = f"{any_of(BEFORE)}{gap}{odd}(?![a-z0-9])|{odd}[^a-z0-9]{{1,3}}(?:{any_of([*AFTER, *ALL_NAMES])})(?![a-z0-9])"
    return f"(?<![a-z0-9.-])(?:{any_of(ANCHORS)}|{names}(?![a-z0-9])|{beside})"


def words_of(line: Column) -> Column:
    """Lower-cased words; dots and hyphens inside a word belong to it."""
    return F.regexp_extract_all(F.lower(line), F.lit(r"[a-z0-9]+(?:[.-][a-z0-9]+)*"), F.lit(0))


def stretches(text: Column) -> Column:
    """Arrays of words with the paragraph's number: joined lines up to one that closes a sentence, long ones in windows."""
    paragraphs = F.split(text, r"\n[^\p{L}\p{N}\n]*(?=\n)")
    joined = lambda p: F.split(p, r"(?<=[.!?])[\"')\]]*[ \t\r]*\n")

    def cut(words):
        starts = F.sequence(F.lit(1), F.greatest(F.size(words) - STEP, F.lit(1)), F.lit(STEP))
        return F.when(F.size(words) > WINDOW, F.transform(starts, lambda i: F.slice(words, i, WINDOW))).otherwise(F.array(words))

    numbered = lambda p, k: F.transform(F.flatten(F.transform(F.transform(joined(p), words_of), cut)), lambda w: F.struct(k.alias("paragraph_no"), w.alias("words")))
    return F.flatten(F.transform(paragraphs, numbered))


def name_pairs(family: str) -> Column:
    """The word pairs in which a short name of ``family`` stands in a notice's place."""
    found = set()
    for n in NAMES[family]:
        other = [o for o in ALL_NAMES if o not in NAMES[family]]
        found |= {f"{w} {n}" for w in (*BEFORE, *other)} | {f"{n} {w}" for w in (*AFTER, *other)}
    return F.array(*map(F.lit, sorted(found)))


def grams(words: Column, n: int) -> Column:
    """Word n-grams, empty if there are fewer words."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(1)))
    some = F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))
    return F.when(F.size(words) >= n, some).otherwise(F.array().cast("array<string>"))


def features(words: Column) -> Column:
    return F.array_distinct(F.concat(words, grams(words, 2), grams(words, 3)))


def _literal_rows(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    """A small table ``(family, line)`` out of one literal."""
    listed = F.from_json(F.lit(json.dumps([{"family": f, "line": t} for f, t in rows])), "array<struct<family: string, line: string>>")
    return spark.range(1).select(F.explode(listed).alias("r")).select("r.*")


def template_rows(spark: SparkSession) -> DataFrame:
    short = [(f, t.format(n)) for f, names in NAMES.items() for n in names for t in ("Released under {}", "Distributed under the {} terms", "{} license", "Dual {}")]
    spaced = [(f, t.format(n.replace("-", " "))) for f, names in NAMES.items() for n in names if n.startswith("cc-") for t in ("{}", "Released under {}")]
    first = {f: names[0] for f, names in NAMES.items()}
    dual = [(f, f"Dual {a} {b}") for f, n in first.items() for o in first.values() if o != n for a, b in ((n, o), (o, n))]
    return _literal_rows(spark, [(f, t) for f, ts in TEMPLATES.items() for t in ts] + short + spaced + dual)


class Classifier:
    """The fitted vocabulary and regression, the calibrated probability and the words that send a stretch to it."""

    def __init__(self, vocabulary, regression, threshold: float = LEAST_PROBABILITY, indicative: tuple[str, ...] = ()):
        self.vocabulary, self.regression, self.threshold, self.indicative = vocabulary, regression, threshold, indicative

    def asked(self, lowered: Column) -> Column:
        """Whether a lower-cased text holds a reason to ask the regression."""
        words = f"|(?<![a-z0-9.-]){any_of(self.indicative)}(?![a-z0-9])" if self.indicative else ""
        return lowered.rlike(strong_pattern() + words)

    def probabilities(self, lines: DataFrame) -> DataFrame:
        """Adds ``p``, the probabilities of ``FAMILIES`` and of unknown, to rows with ``grams``."""
        scored = self.regression.transform(self.vocabulary.transform(lines))
        return scored.withColumn("p", vector_to_array("probability")).drop("probability", "rawPrediction", "prediction", "features", "grams")


def against_unknown(k: int) -> Column:
    """Probability of the ``k``-th family if it is that or unknown."""
    return F.col("p")[k] / (F.col("p")[k] + F.col("p")[len(FAMILIES)])


def train(spark: SparkSession) -> Classifier:
    """Fit on the labelled sentences of this module; one in ``HELD_OUT`` of them calibrates the unknown class."""
    known = template_rows(spark).unionByName(_literal_rows(spark, [("unknown", t) for t in UNKNOWN]))
    # one variant for every word left out, and the whole
    drop = F.explode(F.sequence(F.lit(0), F.size("words")))
    known = known.withColumn("words", words_of(F.col("line"))).select("family", "words", drop.alias("i"))
    known = known.select("family", F.filter("words", lambda _, k: k + 1 != F.col("i")).alias("words"), (F.col("i") == 0).alias("whole")).filter(F.size("words") > 1)
    label = F.lit(float(len(FAMILIES)))
    for k, family in enumerate(FAMILIES):
        label = F.when(F.col("family") == family, F.lit(float(k))).otherwise(label)
    held = ~F.col("whole") & (F.pmod(F.xxhash64("words"), F.lit(HELD_OUT)) == 0)
    rows = known.select(label.alias("label"), "family", features(F.col("words")).alias("grams"), held.alias("held"))
    rows = rows.coalesce(1).persist()  # literals only
    try:
        fitting = rows.filter("not held")
        vocabulary = CountVectorizer(inputCol="grams", outputCol="features", vocabSize=VOCABULARY, minDF=1, binary=True).fit(fitting)
        regression = LogisticRegression(family="multinomial", regParam=0.0005, elasticNetParam=0.2, maxIter=60).fit(vocabulary.transform(fitting))
        classifier = Classifier(vocabulary, regression)
        own = F.element_at(F.array(*(against_unknown(k) for k in range(len(FAMILIES)))), F.col("label").cast("int") + 1)
        held_out = classifier.probabilities(rows.filter("held and family != 'unknown'"))
        level = held_out.agg(F.percentile_approx(own, 1 - KEPT, 10_000)).first()[0]
        classifier.threshold = min(MOST_PROBABILITY, max(LEAST_PROBABILITY, level or 0.0))
        weights = regression.coefficientMatrix.toArray()
        margin = weights[:-1].max(0) - weights[-1]
        ordinary = {w for r in rows.filter("family = 'unknown'").select("grams").collect() for w in r.grams}  # the sentences above
        words = (w for w, m in zip(vocabulary.vocabulary, margin, strict=True) if m > INDICATIVE and " " not in w and w[0].isalpha())
        classifier.indicative = tuple(sorted(w for w in words if w not in ordinary and len(w) > 2 and w not in ALL_NAMES))
    finally:
        rows.unpersist()
    return classifier


def license_paragraphs(docs: DataFrame, classifier: Classifier | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row_id, doc_id, paragraph_no, families)``: the families of each paragraph that is a licence's.

    An empty array is the unknown class.  A row without such a paragraph has one row with a
    null number.  ``row_id`` tells rows with equal or null ids apart.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    classifier = classifier or train(docs.sparkSession)
    joined = lambda s: F.array_join(s["words"], " ")
    cut = F.filter(stretches(F.col("text")), lambda s: classifier.asked(joined(s)))
    asked = F.when(classifier.asked(F.lower("text")), cut)  # one search over the whole text first
    numbered = rows.withColumn("row_id", F.monotonically_increasing_id())  # not beside explode, which would number its output
    found = numbered.select("row_id", "doc_id", F.explode_outer(asked).alias("s"))
    found = found.select("row_id", "doc_id", F.col("s.paragraph_no"), F.coalesce("s.words", F.array().cast("array<string>")).alias("words"))
    found = found.withColumn("strong", F.array_join("words", " ").rlike(strong_pattern()))
    found = found.withColumn("grams", features(F.col("words"))).withColumn("pairs", F.array_distinct(grams(F.col("words"), 2)))
    predicted = classifier.probabilities(found)

    # the templates' word pairs as literals: which families' templates stand in the stretch whole, and how much they resemble it
    whole, alike, named = [], [], []
    for family, texts in TEMPLATES.items():
        each, contained = [F.lit(0.0)], [F.lit(False)]
        for text in texts:
            pairs = F.array_distinct(grams(words_of(F.lit(text)), 2))
            shared = F.size(F.array_intersect("pairs", pairs))
            each.append(shared / F.greatest(F.least(F.size(pairs), F.size("pairs")), F.lit(2)))
            contained.append(shared == F.size(pairs))
        whole.append(F.array_max(F.array(*contained)))
        alike.append(F.greatest(*each) >= CONFIRM)
        named.append(F.arrays_overlap("pairs", name_pairs(family)))
    judged = predicted.select("row_id", "doc_id", "paragraph_no", "strong", "p", *(F.array(*c).alias(n) for n, c in (("whole", whole), ("alike", alike), ("named", named))))
    some_whole = F.array_max("whole")
    families = []
    for k, family in enumerate(FAMILIES):
        likely = (against_unknown(k) >= classifier.threshold) & (F.col("p")[k] >= SHARE)
        confirmed = F.col("whole")[k] | (likely & (F.col("named")[k] | (F.col("alike")[k] & ~some_whole)))
        families.append(F.when(confirmed, F.lit(family)))
    judged = materialize(judged.select("row_id", "doc_id", "paragraph_no", "strong", F.array_compact(F.array(*families)).alias("families")), "licences")
    # a paragraph that was asked about for its words alone and gave no family is none of a licence
    paragraph = F.when(F.col("strong") | (F.size("families") > 0), F.col("paragraph_no"))
    return judged.groupBy("row_id", "doc_id", paragraph.alias("paragraph_no")).agg(F.array_distinct(F.flatten(F.collect_list("families"))).alias("families"))


def license_scan(docs: DataFrame, classifier: Classifier | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, families, n_licenses, n_unknown)``: one row per input row.

    ``families``: the confirmed families of a document's paragraphs, sorted and joined by
    commas (empty if none); ``n_licenses`` counts the families of each paragraph,
    ``n_unknown`` the paragraphs with an anchor or a short name that gave none.  A null or
    empty text has none; null ids and repeated rows are kept; an empty table gives no
    rows; other columns are not read.
    """
    return license_paragraphs(docs, classifier, id_col, text_col).groupBy("row_id", "doc_id").agg(
        F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_list("families")))), ",").alias("families"),
        F.sum(F.size("families")).cast("bigint").alias("n_licenses"),
        F.count_if(F.col("paragraph_no").isNotNull() & (F.size("families") == 0)).cast("bigint").alias("n_unknown"),
    ).drop("row_id")

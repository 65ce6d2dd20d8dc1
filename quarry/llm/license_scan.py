"""Licence scan: a trained paragraph classifier, scored with DataFrame functions only.

Training rows are runs of words of the templates below (their family is known) and, as the
class ``unknown``, plain sentences and at most ``MAX_NEGATIVES`` paragraphs of the corpus,
chosen by hash, that hold at most a third of any template. Features say which word 1- and
2-grams of the templates occur. A sparse (L1) multinomial logistic regression is fitted; the
probability below which a paragraph is unknown is calibrated on rows left out of the fit: the
smallest on a grid whose predictions there are right in at least ``PRECISION`` of cases.

Scanning is one projection over the text, without shuffle: a paragraph (a line) without any
word of a gram that speaks for a family cannot be predicted as one; the others get their
class probabilities, and a prediction counts only if the best template of all families is one
of that family: it holds ``CONFIRM`` of the paragraph's grams, or the paragraph holds that share
of it, and the paragraph holds the words that tell the licence from its siblings and none that
name a sibling (``MARKS``). Sentences that siblings share (``SHARED``) name no family.

The fit and the tables in the plan are bounded by the templates and ``MAX_NEGATIVES``.

Defined cases: NULL and blank texts have no paragraphs; NULL and repeated ids keep one row
each; an empty table gives an empty result (the fit then uses the fixed rows alone); columns
named as those added are replaced.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import BLANK, cut_lineage, let, read, sampled

MAX_NEGATIVES = 2000
PRECISION = 0.99
CONFIRM = 0.6
UNKNOWN = "unknown"

#: Notices of well-known licences.
TEMPLATES = {
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "BSD-2-Clause": (
        "Released under the BSD 2-Clause License",
        "Released under the Simplified BSD License",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-NC-ND-4.0": (
        "Licensed under CC BY-NC-ND 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ),
    "CC-BY-NC-SA-4.0": (
        "Licensed under CC BY-NC-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    "CC-BY-ND-4.0": (
        "Licensed under CC BY-ND 4.0",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0 1.0 Universal",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "ISC": (
        "Released under the ISC License",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "LGPL-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "MIT": (
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/",
    ),
}
#: Sentences that stand alike in several of these licences.
SHARED = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/",
    "This work is licensed under the GNU General Public License",
    "This work is licensed under a Creative Commons License",
    "Released under the BSD License",
)


class Marks(NamedTuple):
    """Word 1- and 2-grams: of every group of ``needs`` a paragraph must hold one, if the template
    that confirms it does; of ``bars`` it must hold none."""

    needs: tuple[tuple[str, ...], ...] = ()
    bars: tuple[str, ...] = ()


_AFFERO = ("affero", "agpl", "agplv3")
_LESSER = ("lesser", "lgpl", "lgplv2", "lgplv2.1", "lgplv3", "library general", "gnu library")
_V1, _V2 = ("version 1", "version 1.0", "v1", "gplv1"), ("version 2", "version 2.0", "v2", "v2.0", "gplv2", "gplv2.0", "gpl 2", "gpl 2.0")
_V21 = ("version 2.1", "v2.1", "lgplv2.1", "lgpl 2.1")
_V3 = ("version 3", "version 3.0", "v3", "v3.0", "gplv3", "gplv3.0", "lgplv3", "agplv3", "gpl 3", "gpl 3.0", "lgpl 3", "lgpl 3.0", "agpl 3", "agpl 3.0")
_GPL = ("general public", "gpl", "gplv2", "gplv2.0", "gplv3", "gplv3.0")
_BY, _OTHER_CC = ("by", "attribution"), ("1.0", "2.0", "2.5", "3.0")
_NC = ("nc", "noncommercial", "non commercial")
_ND = ("nd", "noderivatives", "noderivs", "no derivatives", "no derivs", "no derivative")
_SA = ("sa", "sharealike", "share alike")
#: What tells each licence from its siblings.
MARKS = {
    "AGPL-3.0": Marks((_AFFERO, _V3), (*_LESSER, *_V1, *_V2)),
    "Apache-2.0": Marks((("apache",),), ("version 1.0", "version 1.1", "license 1.0", "license 1.1")),
    "BSD-2-Clause": Marks((("2 clause", "two clause", "simplified bsd"),), ("3 clause", "4 clause", "0 clause", "1 clause")),
    "BSD-3-Clause": Marks((("3 clause", "three clause", "neither the"),), ("2 clause", "4 clause", "0 clause", "1 clause", "clause clear")),
    "CC-BY-4.0": Marks((_BY, ("4.0",)), (*_OTHER_CC, *_NC, *_ND, *_SA)),
    "CC-BY-NC-4.0": Marks((_BY, ("4.0",), _NC), (*_OTHER_CC, *_ND, *_SA)),
    "CC-BY-NC-ND-4.0": Marks((_BY, ("4.0",), _NC, _ND), (*_OTHER_CC, *_SA)),
    "CC-BY-NC-SA-4.0": Marks((_BY, ("4.0",), _NC, _SA), (*_OTHER_CC, *_ND)),
    "CC-BY-ND-4.0": Marks((_BY, ("4.0",), _ND), (*_OTHER_CC, *_NC, *_SA)),
    "CC-BY-SA-4.0": Marks((_BY, ("4.0",), _SA), (*_OTHER_CC, *_NC, *_ND)),
    "CC0-1.0": Marks(),
    "GPL-2.0": Marks((_GPL, _V2), (*_AFFERO, *_LESSER, *_V1, *_V21, *_V3)),
    "GPL-3.0": Marks((_GPL, _V3), (*_AFFERO, *_LESSER, *_V1, *_V2, *_V21)),
    "ISC": Marks((("isc", "appear in"),)),
    "LGPL-2.1": Marks((_LESSER, _V21), (*_AFFERO, *_V1, *_V2, *_V3)),
    "LGPL-3.0": Marks((_LESSER, _V3), (*_AFFERO, *_V1, *_V2, *_V21)),
    "MIT": Marks((("mit",),), ("no attribution", "mit 0", "accompanying documentation")),
    "MPL-2.0": Marks((("mozilla", "mpl"),), ("version 1.0", "version 1.1", "v 1.1", "mpl 1.1", "mpl 1.0")),
}
#: Sentences with words of licences that name none.
PLAIN = (
    "The driver has a license to drive in this country and may not drive without it",
    "This work was done under the general direction of the public office",
    "A copy of the book is free of charge in the library",
    "He was released under the terms of the law and had permission to use the software",
    "You may find the version at the web page of the foundation",
    "All rights reserved. The conditions of use are subject to change",
)
FAMILIES = [*sorted(TEMPLATES), UNKNOWN]


class Model(NamedTuple):
    grams: list[str]
    weights: list[list[float]]  # per gram, one per family
    bias: list[float]
    threshold: float


def grams(text: Column) -> Column:
    """The distinct word 1- and 2-grams of a text, in lower case."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:\.\p{N}+)*"), F.lit(0))
    pairs = lambda w: F.transform(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), lambda x, i: F.concat(x, F.lit(" "), F.get(w, i + 1)))
    return let(found, lambda w: F.array_distinct(F.concat(w, pairs(w))))


def _fixed(spark: SparkSession) -> DataFrame:
    """Every template with its family, and the sentences that name none."""
    rows = [(f, t) for f, ts in TEMPLATES.items() for t in ts] + [(UNKNOWN, t) for t in (*SHARED, *PLAIN)]
    return spark.createDataFrame(rows, "family string, text string")


def _runs(rows: DataFrame) -> DataFrame:
    """Runs of words of fixed sentences: whole ones, and all of 4 to 12 words."""
    w = F.split("text", " ")
    start = rows.withColumn("w", w).withColumn("i", F.explode(F.sequence(F.lit(1), F.size("w"))))
    cut = start.withColumn("n", F.explode(F.array(*[F.lit(n) for n in (4, 5, 6, 8, 10, 12)]))).filter(F.col("i") + F.col("n") <= F.size("w") + 1)
    cut = cut.select("family", F.array_join(F.slice("w", F.col("i"), F.col("n")), " ").alias("text"))
    # a short run may lie in templates of several families: it names none
    shared = cut.groupBy("text").agg(F.count_distinct("family").alias("k"), F.first("family").alias("family"))
    cut = shared.select(F.when(F.col("k") > 1, UNKNOWN).otherwise(F.col("family")).alias("family"), "text")
    whole = rows.withColumn("again", F.explode(F.array_repeat(F.lit(0), 20))).select("family", "text")
    return cut.unionByName(whole)


def _share(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.lit(1))


def _own_grams(text: str) -> set[str]:
    """``grams`` of a fixed text."""
    w = re.findall(r"[^\W_]+(?:\.\d+)*", text.lower())
    return {*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))}


def _confirmed(found: Column, family: Column) -> Column:
    """Whether the best of all templates that may stand for the paragraph is one of the family.

    A template may if it holds enough of the paragraph, or the other way round, and its marks do
    not speak against it; the best has the largest share of the grams of both."""
    none = F.array().cast("array<string>")
    listed = lambda x: F.array(*[F.lit(g) for g in x]) if x else none
    rows = []
    for name, ts in TEMPLATES.items():
        for t in ts:
            own = _own_grams(t)
            needs = [F.array(*[F.lit(g) for g in group]) for group in MARKS[name].needs if own & set(group)]
            rows.append(F.struct(F.lit(name).alias("family"), listed(sorted(own)).alias("g"), (F.array(*needs) if needs else F.array().cast("array<array<string>>")).alias("needs"), listed(MARKS[name].bars).alias("bars")))
    fits = lambda t: ((_share(found, t["g"]) >= CONFIRM) | (_share(t["g"], found) >= CONFIRM)) & F.forall(t["needs"], lambda x: F.arrays_overlap(x, found)) & ~F.arrays_overlap(t["bars"], found)
    both = lambda t: F.size(F.array_intersect(found, t["g"])) / F.size(F.array_union(found, t["g"]))
    ranked = F.transform(F.filter(F.array(*rows), fits), lambda t: F.struct(both(t).alias("share"), t["family"].alias("family")))
    return F.coalesce(let(ranked, lambda r: F.exists(r, lambda x: (x["family"] == family) & (x["share"] == F.array_max(r)["share"]))), F.lit(False))


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(BLANK)) != "")


def fit(docs: DataFrame, max_negatives: int = MAX_NEGATIVES) -> Model:
    spark = docs.sparkSession
    fixed = _fixed(spark)
    vocabulary = fixed.filter(F.col("family") != UNKNOWN).select(F.explode(grams(F.col("text"))).alias("g")).distinct().orderBy("g")
    names = [r.g for r in vocabulary.collect()]  # bounded by the templates
    n = docs.count()
    # about max_negatives documents by a hash of id and text, one paragraph of each by a hash of its text
    some = docs.filter(sampled(max_negatives / max(n, 1), "doc_id", "text"))
    lines = some.select(F.array_min(F.transform(paragraphs(F.col("text")), lambda x: F.struct(F.xxhash64(x).alias("h"), x.alias("text"))))["text"].alias("text")).dropna().distinct()
    templates = F.array(*[grams(F.lit(t)) for ts in TEMPLATES.values() for t in ts])
    negative = lines.withColumn("g", grams(F.col("text"))).filter(~F.exists(templates, lambda t: _share(t, F.col("g")) > 1 / 3))
    rows = _runs(fixed).unionByName(negative.select(F.lit(UNKNOWN).alias("family"), "text"))
    every = F.array(*[F.lit(x) for x in names])
    present = F.transform(every, lambda g: F.array_contains(F.col("g"), g).cast("double"))
    label = F.array_position(F.array(*[F.lit(f) for f in FAMILIES]), F.col("family")) - 1
    rows = rows.withColumn("g", F.array_intersect(grams(F.col("text")), every))
    rows = cut_lineage(rows.select("text", label.cast("double").alias("label"), array_to_vector(present).alias("features"), "g"))
    aside = F.pmod(F.xxhash64("text"), F.lit(4)) == 0
    model = LogisticRegression(family="multinomial", regParam=0.0005, elasticNetParam=0.5, maxIter=80).fit(rows.filter(~aside))
    matrix, bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    used = [i for i in range(len(names)) if abs(matrix[:, i]).max() > 1e-9]
    out = Model([names[i] for i in used], [matrix[:, i].tolist() for i in used], bias.tolist(), 0.0)
    tried = rows.filter(aside).select("label", _best(F.col("g"), out).alias("p"))
    grid = [0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.99]
    right = tried.filter(F.col("p.family") != UNKNOWN).select("p.score", (F.col("p.family") == F.element_at(F.array(*[F.lit(f) for f in FAMILIES]), (F.col("label") + 1).cast("int"))).alias("ok"))
    shares = right.agg(*[F.avg(F.when(F.col("score") >= t, F.col("ok").cast("double"))) for t in grid]).first()
    return out._replace(threshold=next((t for t, s in zip(grid, shares) if s is not None and s >= PRECISION), grid[-1]))


def _best(found: Column, model: Model) -> Column:
    """The most likely family and its probability, from the grams of a paragraph."""
    names = F.array(*[F.lit(g) for g in model.grams]).cast("array<string>")
    table = F.array(*[F.array(*[F.lit(float(x)) for x in w]) for w in model.weights]).cast("array<array<double>>")
    start = F.array(*[F.lit(float(x)) for x in model.bias])
    add = lambda a, g: let(F.get(table, (F.array_position(names, g) - 1).cast("int")), lambda w: F.zip_with(a, w, lambda x, y: x + y))
    logits = F.aggregate(F.array_intersect(found, names), start, add)
    families = F.array(*[F.lit(f) for f in FAMILIES])

    def soft(z: Column) -> Column:
        top = F.array_max(z)
        total = F.aggregate(z, F.lit(0.0), lambda a, x: a + F.exp(x - top))
        return F.struct(F.element_at(families, F.array_position(z, top).cast("int")).alias("family"), (F.lit(1.0) / total).alias("score"))

    return let(logits, soft)


def find(text: Column, model: Model) -> Column:
    """The licence paragraphs of a text: array of (paragraph, family, score)."""
    speaking = sorted({w for g, x in zip(model.grams, model.weights) if max(x[:-1]) > 0 for w in g.split(" ")})
    words = F.array(*[F.lit(w) for w in speaking]).cast("array<string>")
    lines = F.transform(paragraphs(text), lambda x: F.struct(x.alias("paragraph"), F.regexp_extract_all(F.lower(x), F.lit(r"[\p{L}\p{N}]+(?:\.\p{N}+)*"), F.lit(0)).alias("w")))
    lines = F.filter(lines, lambda x: F.arrays_overlap(x["w"], words))
    judged = F.transform(lines, lambda x: let(grams(x["paragraph"]), lambda g: F.struct(x["paragraph"].alias("paragraph"), g.alias("g"), _best(g, model).alias("p"))))
    sure = F.filter(judged, lambda x: (x["p"]["family"] != UNKNOWN) & (x["p"]["score"] >= model.threshold))

    return F.transform(F.filter(sure, lambda x: _confirmed(x["g"], x["p"]["family"])), lambda x: F.struct(x["paragraph"].alias("paragraph"), x["p"]["family"].alias("family"), x["p"]["score"].alias("score")))


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """docs with ``licenses``: array of (paragraph, family, score)."""
    return docs.withColumn("licenses", find(F.col("text"), model))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = scan(docs, fit(docs))
    families = F.array_join(F.array_sort(F.array_distinct(F.col("licenses.family"))), ",")
    return out.select("doc_id", F.size("licenses").cast("long").alias("n_paragraphs"), F.nullif(families, F.lit("")).alias("families"), F.array_max(F.col("licenses.score")).alias("score"))

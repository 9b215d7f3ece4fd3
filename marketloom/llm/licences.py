"""Licence scan: a trained paragraph classifier, confirmed by templates.

Paragraphs (lines) with a licence word are turned into sparse counts of word n-grams and classified by a
multinomial logistic regression over licence families and an unknown class. The model is trained on
notices made by rule from the names of the families, and on prose that merely mentions such words. How
sure it must be is calibrated on notices and prose left out of the training: the lowest probability
above which none of them gets a wrong family. A prediction is confirmed when the words of some
template of that family stand in the paragraph in their order of n-grams. Everything runs in the JVM.

A paragraph without any cue and without any word of a family's name is unknown without being scored. The
words are those of ``FAMILIES``, so every notice of the labelled rows is scored.

Defined results
    null or empty text: no rows. Ties between families: the first in ``FAMILIES``. Repeated rows: the same
    rows again. Empty table: no rows. Other columns: ignored. Null ids: kept.
"""

from __future__ import annotations

import re
from itertools import product

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.common import Stage

UNKNOWN = "unknown"
# Names under which notices refer to each family (fixed values), the shortest identifier first.
FAMILIES = {
    "MIT": ["MIT", "MIT License", "Expat License"],
    "Apache-2.0": ["Apache-2.0", "Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0"],
    "GPL-3.0": ["GPL-3.0", "GNU General Public License, version 3", "GNU GPL v3", "GPLv3"],
    "GPL-2.0": ["GPL-2.0", "GNU General Public License, version 2", "GNU GPL v2", "GPLv2"],
    "LGPL": ["LGPL-3.0", "GNU Lesser General Public License", "LGPLv3", "LGPL"],
    "AGPL-3.0": ["AGPL-3.0", "GNU Affero General Public License, version 3", "AGPLv3"],
    "MPL-2.0": ["MPL-2.0", "Mozilla Public License, version 2.0", "Mozilla Public License"],
    "BSD": ["BSD-3-Clause", "BSD License", "BSD 2-Clause License", "3-clause BSD license"],
    "ISC": ["ISC", "ISC License"],
    "CC-BY": ["CC-BY-4.0", "CC BY 4.0", "Creative Commons Attribution 4.0"],
    "CC-BY-SA": ["CC-BY-SA-4.0", "CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0"],
    "CC-BY-NC": ["CC-BY-NC-4.0", "CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0"],
    "CC0": ["CC0-1.0", "CC0", "CC0 1.0 Universal"],
}
SENTENCES = {
    "MIT": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software"],
    "GPL-3.0": ["redistribute it and/or modify it under the terms of the GNU General Public License version 3"],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted"],
    "CC0": ["has waived all copyright and related rights to this work"],
}
FRAMES = [
    "Licensed under {}.", "Released under the {}.", "This work is licensed under the {}.", "Licensed under the {}", "SPDX-License-Identifier: {}",
    "Distributed under the terms of the {}.", "This file is available under {} license", "License: {}", "The content is published under a {} license.",
    "See the {} for details.", "Permission to use this text is granted under {}",
]
PROSE = [
    "the licence of the driver was lost", "a license to fish in the river", "copyright holders met in town", "he gave his permission to leave", "no warranty on the old car",
    "licensed doctors work here", "released under pressure from the public", "this work is about the general public", "public domain of the king",
    "the version 2.0 was released", "distributed under the trees", "creative people in common rooms", "all rights reserved by the hotel", "terms of the peace",
    "licensed restaurant under new owners", "the license plate of the car", "redistribution of wealth", "license", "permission", "copyright 2020", "mozilla and apache tribes",
    "this file is large", "see the manual for details", "the mit in boston", "bsd", "an isc meeting", "gnu is an animal", "the content is published", "cc the others by mail", "under the license of the city",
]
CUES = r"(?i)\b(licen[sc]e[sd]?|licensing|copyright|spdx|permission|warrant(y|ies)|redistribut\w*|creative commons|public domain|gnu|a?l?gpl\w*|apache|mozilla|mpl\S*|bsd\S*|cc0\S*|cc[ -]by\S*)"
NAME_WORDS = sorted({w for names in FAMILIES.values() for n in names for w in re.findall(r"[a-z0-9]+(?:[.][0-9]+)*", n.lower())})
NAMED = rf"(?i)(?<![\p{{L}}\p{{N}}])({'|'.join(map(re.escape, NAME_WORDS))})(?![\p{{L}}\p{{N}}])"
SIZES = (1, 2, 3)
DIMENSIONS = 1 << 14
LEAST_SIMILARITY = 0.6


def words(paragraph: Column) -> Column:
    """Lower-case words; versions and identifiers stay whole."""
    return F.regexp_extract_all(F.lower(paragraph), F.lit(r"[\p{L}\p{N}]+(?:[.][\p{N}]+)*"), F.lit(0))


def grams(w: Column, n: int) -> Column:
    at = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.concat_ws(" ", F.slice(w, i, F.lit(n))))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once a row.

    A plain column would be copied by the optimizer into every place that uses it when a filter on what follows is
    pushed down: the words of a paragraph would be cut again for each of its n-grams.
    """
    return df.select(*[c for c in df.columns if c != name], F.explode(F.array(value)).alias(name))


def featured(df: DataFrame, paragraph: str) -> DataFrame:
    w = once(df, "words", words(F.col(paragraph)))
    counted = w.withColumn("grams", F.concat(*[grams(F.col("words"), n) for n in SIZES]))
    return HashingTF(inputCol="grams", outputCol="features", numFeatures=DIMENSIONS).transform(counted)


def labelled_rows() -> list[tuple[str, str, int]]:
    """(paragraph, family, part): part 1 is left out of the training and calibrates."""
    rows = []
    for family, names in FAMILIES.items():
        notices = [f.format(n) for f, n in product(FRAMES, names)] + SENTENCES.get(family, [])
        rows += [(text, family, int(i % 5 == 4)) for i, text in enumerate(notices)]
    mixed = [f"{a}, {b}" for a, b in zip(PROSE, PROSE[3:] + PROSE[:3])]
    return rows + [(text, UNKNOWN, int(i % 5 == 4)) for i, text in enumerate(PROSE + mixed)]


class Model:
    def __init__(self, regression, names: list[str], least: float):
        self.regression, self.names, self.least = regression, names, least

    def classify(self, df: DataFrame, paragraph: str) -> DataFrame:
        """Adds ``family`` and ``probability``; a family the model is not sure of is unknown."""
        scored = once(self.regression.transform(featured(df, paragraph)), "p", vector_to_array("probability"))
        best = F.array_max("p")
        family = F.element_at(F.lit(self.names), F.array_position("p", best).cast("int"))
        return scored.withColumn("probability", best).withColumn("family", F.when(best >= self.least, family).otherwise(F.lit(UNKNOWN)))


def fit(spark: SparkSession, rows: list[tuple[str, str, int]] | None = None) -> Model:
    """Train on part 0 of the labelled rows and calibrate the least probability on part 1."""
    names = [*FAMILIES, UNKNOWN]
    table = spark.createDataFrame([(t, f, float(names.index(f)), p) for t, f, p in (rows or labelled_rows())], "text string, name string, label double, part int")
    made = featured(table.coalesce(2), "text")
    regression = LogisticRegression(maxIter=60, regParam=0.002, family="multinomial").fit(made.filter("part = 0"))
    first = Model(regression, names, 0.0).classify(table.filter("part = 1").select("text", "name"), "text")
    wrong = first.filter((F.col("family") != F.col("name")) & (F.col("family") != UNKNOWN)).agg(F.max("probability")).first()[0]
    return Model(regression, names, max(0.5, (wrong or 0.0) + 1e-6))


def templates(spark: SparkSession) -> DataFrame:
    """``family`` and the word pairs and words of each of its templates: a table of fixed size."""
    rows = [(family, t) for family, names in FAMILIES.items() for t in [*names, *SENTENCES.get(family, [])]]
    w = spark.createDataFrame(rows, "family string, template string").withColumn("w", words(F.col("template")))
    parts = F.array_distinct(F.concat(grams(F.col("w"), 1), grams(F.col("w"), 2)))
    return w.select("family", parts.alias("parts")).groupBy("family").agg(F.array_sort(F.collect_list("parts")).alias("templates"))


def asked(text: Column) -> Column:
    """Whether a paragraph is scored."""
    return text.rlike(CUES) | text.rlike(NAMED)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """One row per paragraph with a family: ``id``, ``paragraph`` (from 0), ``text``, ``family``, ``probability``, ``similarity``, ``confirmed``."""
    spark = docs.sparkSession
    model = model or fit(spark)
    known = Stage(spark, "licences").keep("templates", templates(spark).coalesce(1))
    lines = docs.filter(asked(F.col(text_col))).select(F.col(id_col).alias("id"), F.posexplode(F.split(text_col, "\n")).alias("paragraph", "text"))
    scored = model.classify(lines.filter(asked(F.col("text"))), "text").filter(F.col("family") != UNKNOWN)
    own = F.concat(grams(F.col("words"), 1), grams(F.col("words"), 2))
    with_parts = scored.withColumn("own", F.array_distinct(own)).join(F.broadcast(known), "family")
    share = F.array_max(F.transform("templates", lambda t: F.size(F.array_intersect(t, F.col("own"))) / F.size(t)))
    return with_parts.withColumn("similarity", share).select(
        "id", "paragraph", "text", "family", "probability", "similarity", (F.col("similarity") >= LEAST_SIMILARITY).alias("confirmed")
    )

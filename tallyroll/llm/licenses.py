"""Licence notices: a trained paragraph classifier, confirmed by comparison with templates.

Paragraphs are lines. Features are n-grams of one to three words with a telling word
in them, so a paragraph without a telling word has none and is unknown by construction;
only the others are classified. A multinomial logistic regression names the licence
family. Below a probability that is calibrated on rows set aside, the family is unknown.
A named family is confirmed if the paragraph holds most word pairs of one of the family's
templates or names, or, being long itself, has most of its own pairs from a template.
The unknown class is learned from notices of other licences, real and made up, and its
threshold is calibrated on licences and turns of phrase that the fit has not seen. All of
it is DataFrame expressions and Spark's own model.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.llm.common import about, table, texts
from tallyroll.runtime import stage

UNKNOWN = "unknown"

# Notices by which each family of licences is usually applied.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "This project is released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "This software is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Released under the GNU General Public License, version 2 or any later version.",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "Released under the ISC License.",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-SA 4.0.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.",
    ),
    "public-domain": (
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright under CC0 1.0.",
    ),
}

# Names by which each family is called in short notices.
NAMES: dict[str, tuple[str, ...]] = {
    "apache": ("Apache License 2.0", "Apache License, Version 2.0", "Apache-2.0", "Apache 2.0", "Apache 2 license", "Apache License", "Apache Software License"),
    "mit": ("MIT License", "MIT", "MIT licence", "MIT/X11 license", "MIT licensed", "MIT-style license", "Expat (MIT) license"),
    "gpl": ("GNU General Public License", "GNU GPL", "GPL", "GPLv3", "GPLv2", "GPL-3.0-or-later", "GPL-2.0-only", "GNU General Public License v2.0", "GNU GPL version 3"),
    "lgpl": ("GNU Lesser General Public License", "GNU LGPL", "LGPL", "LGPLv2.1", "LGPLv3", "LGPL-2.1-only", "LGPL-3.0-or-later", "GNU Library General Public License"),
    "bsd": ("BSD license", "BSD 3-Clause License", "BSD 2-Clause License", "BSD-3-Clause", "BSD-2-Clause", "BSD", "BSD-style license", "new BSD license", "BSD 3-Clause terms"),
    "mpl": ("Mozilla Public License", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0", "MPL 2.0", "MPL-2.0", "MPL", "MPL 1.1"),
    "isc": ("ISC License", "ISC", "ISC licence", "ISC licensed"),
    "cc-by": ("CC BY 4.0", "CC BY-SA 4.0", "CC-BY-4.0", "CC BY 3.0", "CC BY-SA 3.0", "Creative Commons Attribution 4.0 International", "Creative Commons Attribution-ShareAlike 4.0", "Creative Commons Attribution License"),
    "cc-by-nc": ("CC BY-NC 4.0", "CC BY-NC-SA 4.0", "CC-BY-NC-4.0", "CC BY-NC 3.0", "Creative Commons Attribution-NonCommercial 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0", "Creative Commons BY-NC"),
    "public-domain": ("public domain", "CC0", "CC0 1.0", "CC0 1.0 Universal", "CC0-1.0", "Unlicense", "public domain dedication"),
}

# Other licences. The second group is kept from the fit that calibrates the threshold.
OTHER_NAMES = (
    "Academic Free License 3.0", "Microsoft Public License", "SIL Open Font License 1.1", "Common Development and Distribution License 1.0",
    "GNU Free Documentation License 1.3", "WTFPL license", "commercial license", "license of the vendor", "end user license agreement", "GFDL",
    "Open Data Commons Database License", "Ruby license", "Python Software Foundation License", "Common Public License 1.0",
)
HELD_OUT_NAMES = (
    "Eclipse Public License 2.0", "EPL-2.0", "GNU Affero General Public License version 3", "AGPL-3.0", "Boost Software License 1.0",
    "zlib license", "proprietary license", "Server Side Public License",
)
# Names of licences that do not exist: each pattern with each of the words.
MADE_UP_NAMES = ("{} Public License 2.0", "{} License, Version 2.0", "{} Software License 1.0", "GNU {} General Public License version 3", "{} license", "{} Commons License", "{}-style licence")
MADE_UP_WORDS = ("acorn", "harbor", "lantern", "meridian", "northern", "open", "shared", "orchid", "common", "quartz", "reciprocal", "source")

# What short notices say around a name. Every fourth is kept from the fit that calibrates the threshold.
NOTICES = (
    "{}", "Released under the {}.", "Licensed under the {}", "This code is available under the {}; see LICENSE.", "License: {}",
    "SPDX-License-Identifier: {}", "Distributed under the terms of the {}", "This code is {}, see the file.", "All texts: {}",
    "You may use, modify and redistribute it under the {} or later", "The software is covered by the {}.", "Available under {}.",
    "Copyright 2019 the authors, {}", "This project uses the {} for its source files.", "Dual licence, one of them the {}", "(c) 2020 under {}",
)
LONG = 8

# Sentences with telling words that license nothing.
OTHERS: tuple[str, ...] = (
    "A fishing license is required at the lake.", "Her driving licence expired in May.", "The license plate was covered in mud.",
    "Permission to land was granted by the tower.", "He asked for permission to leave the room.", "The warranty covers parts for two years.",
    "Researchers at MIT measured the effect.", "MIT opened a new building.", "The Apache helicopter flew low over the hills.",
    "The Apache people lived in the south west.", "GNU are large antelopes of the plains.", "Copyright 2020 Example Corporation.",
    "All rights reserved.", "The software was slow and the program crashed.", "Copyright law protects authors.",
    "The city will redistribute the funds next year.", "Mozilla held a meeting in town.", "They moved to the public domain name system.",
    "She works at the Mozilla Foundation.", "He took a degree at MIT.", "Students of MIT met the Apache chiefs.", "The foundation gave money to the school.",
    "You may not sell this program without written permission.", "No part of it may be copied without prior permission of the publisher.",
    "Commercial use of the software is not permitted.", "Use of this software is permitted to members only.",
    "Licence fees rose by three percent.", "A licensed electrician must do the work.", "The pub is licensed until midnight.",
)

_TELLING = (
    r"(?:un|sub)?licen[cs]\p{L}*|copyright\p{L}*|warrant\p{L}*|redistribut\p{L}*|permission|permitted|software|spdx|gnu|l?gpl"
    r"|apache|mit|bsd|cc0?|commons|mozilla|mpl|isc|domain|foundation"
)
_TELLING_WORD = f"^(?:{_TELLING})$"
# Matches a line in lower case if, and only if, one of its words is telling.
_TELLING_TEXT = rf"(?<![\p{{L}}\p{{N}}])(?:(?:{_TELLING})(?![\p{{L}}\p{{N}}])|l?gplv?\p{{N}})"

# Every match of the pattern above holds one of them.
_TELLING_STEMS = (
    "licenc", "licens", "copyright", "warrant", "redistribut", "permission", "permitted", "software", "spdx", "gnu", "gpl",
    "apache", "mit", "bsd", "cc", "commons", "mozilla", "mpl", "isc", "domain", "foundation",
)

FEATURES = 1 << 13
#: About so many documents, drawn by a hash, give the lines that are examples of no licence.
MAX_DOCS = 300
#: The fewest and most words of a part of a template that is an example.
LEAST_WORDS, MOST_WORDS = 3, 30
#: The share of word pairs that confirms a family.
CONFIRM = 0.8
PRECISION = 0.98


def _once(value: Column, function: Callable[[Column], Column]) -> Column:
    """``function`` of a value that is computed once, however often it is named and wherever a filter is moved to."""
    return F.element_at(F.transform(F.array(value), function), 1)


def words_of(text: Column) -> Column:
    """Words in lower case; a version that is written onto gpl or lgpl is a word of its own."""
    low = F.regexp_replace(F.lower(text), r"(?<![\p{L}\p{N}])(l?gpl)v?(?=\p{N})", "$1 ")
    return F.array_remove(F.split(low, r"[^\p{L}\p{N}]+"), "")


def _grams(words: Column) -> Column:
    """n-grams of one to three words that hold a telling word."""

    def runs(own: Column, places: Column, n: int) -> Column:
        last = F.size(own) - n + 1
        starts = F.flatten(F.transform(places, lambda p: F.sequence(F.greatest(p - n + 1, F.lit(1)), F.least(p, last))))
        every = F.transform(F.array_distinct(starts), lambda i: F.array_join(F.slice(own, i, n), " "))
        return F.when(last >= 1, every).otherwise(F.expr("array()").cast("array<string>"))

    def all_runs(own: Column) -> Column:
        places = F.array_compact(F.transform(own, lambda w, i: F.when(w.rlike(_TELLING_WORD), i + 1)))
        return _once(places, lambda at: F.concat(runs(own, at, 1), runs(own, at, 2), runs(own, at, 3)))

    return F.array_distinct(_once(words, all_runs))


def _pairs(words: Column) -> Column:
    def pairs(own: Column) -> Column:
        one = F.transform(F.sequence(F.lit(1), F.size(own) - 1), lambda i: F.array_join(F.slice(own, i, 2), " "))
        return F.when(F.size(own) >= 2, F.array_distinct(one)).otherwise(own)

    return _once(words, pairs)


def _listed(spark: SparkSession, rows: list[tuple[str, str, bool]]) -> DataFrame:
    """family, text and aside of the fixed rows."""
    listed = F.array(*[F.struct(F.lit(a).alias("family"), F.lit(b).alias("text"), F.lit(c).alias("aside")) for a, b, c in rows])
    return spark.range(1).select(F.inline(listed))


def _templates(spark: SparkSession, names: bool) -> DataFrame:
    """family and words of every template, and of every name if ``names``."""
    rows = [(family, text, False) for family, every in TEMPLATES.items() for text in (*every, *(NAMES[family] if names else ()))]
    return _listed(spark, rows).select("family", words_of(F.col("text")).alias("words"))


def _notices(spark: SparkSession) -> DataFrame:
    """family, words and aside of each name, real or made up, in each notice."""
    rows = [(family, name, False) for family, every in NAMES.items() for name in every]
    rows += [(UNKNOWN, name, False) for name in OTHER_NAMES] + [(UNKNOWN, name, True) for name in HELD_OUT_NAMES]
    patterns = _listed(spark, [(UNKNOWN, pattern, False) for pattern in MADE_UP_NAMES])
    word = F.explode(F.array(*[F.lit(w) for w in MADE_UP_WORDS])).alias("word")
    made_up = patterns.select("family", "text", "aside", word).select("family", F.replace("text", F.lit("{}"), "word").alias("text"), "aside")
    said = F.posexplode(F.array(*[F.lit(n) for n in NOTICES])).alias("number", "notice")
    every = _listed(spark, rows).union(made_up).select("family", "text", "aside", said)
    return every.select(
        "family", words_of(F.replace("notice", F.lit("{}"), "text")).alias("words"), (F.col("aside") | (F.col("number") % 4 == 3)).alias("aside")
    )


def examples(docs: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """family, words and aside of the training rows: runs of words of the templates, names in notices, and lines that license nothing.

    ``aside`` marks what is kept from the first fit; it is null where a hash may decide.
    """
    spark = docs.sparkSession
    templates, by_hash = _templates(spark, names=False), F.lit(None).cast("boolean").alias("aside")
    n = F.size("words")
    runs = templates.select("family", "words", F.explode(F.sequence(F.lit(1), n)).alias("at"))
    runs = runs.select("family", "words", "at", F.explode(F.sequence(F.lit(LEAST_WORDS), F.lit(MOST_WORDS))).alias("size"))
    runs = runs.where(F.col("at") + F.col("size") - 1 <= n).select("family", F.expr("slice(words, at, size)").alias("words"))
    others = _listed(spark, [(UNKNOWN, text, False) for text in OTHERS]).select("family", words_of(F.col("text")).alias("words"))
    some = about(texts(docs), max_docs, "doc_id", "text")
    lines = some.select(F.explode(F.split("text", "\n")).alias("line"))
    plain = lines.where(~F.lower("line").rlike(r"licen[cs]|copyright|public domain|spdx")).select(F.lit(UNKNOWN).alias("family"), words_of(F.col("line")).alias("words"))
    return runs.union(templates).union(others).union(plain).select("family", "words", by_hash).union(_notices(spark))


@dataclass(frozen=True)
class Classifier:
    families: tuple[str, ...]
    model: LogisticRegressionModel
    threshold: float

    def transform(self, grams: DataFrame) -> DataFrame:
        """Adds family, which may be unknown, and probability to rows with ``grams``."""
        scored = self.model.transform(HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features").transform(grams))
        families = F.array(*[F.lit(x) for x in self.families[1:]])

        def name(chance: Column) -> Column:
            best = F.array_max(chance)
            named = F.element_at(families, F.array_position(chance, best).cast("int"))
            return F.struct(F.when(best >= self.threshold, named).otherwise(UNKNOWN).alias("family"), best.alias("probability"))

        best = _once(F.slice(vector_to_array("probability"), 2, len(self.families) - 1), name)
        scored = scored.withColumn("best", best).withColumns({"family": F.col("best.family"), "probability": F.col("best.probability")})
        return scored.drop("features", "rawPrediction", "prediction", "best")


def train(docs: DataFrame, max_docs: int = MAX_DOCS) -> Classifier:
    """Fit on the examples; some are set aside to calibrate the unknown class: licences that no other example
    names, every fourth turn of phrase, and every fifth of the rest, by hash.

    The threshold is the smallest probability from which on the set-aside rows that are
    named are right in PRECISION of all cases.
    """
    families = (UNKNOWN, *TEMPLATES)
    label = F.array_position(F.array(*[F.lit(x) for x in families]), F.col("family")) - 1
    # What several families have says nothing of any.
    one = F.when(F.count_distinct("family") == 1, F.min("family")).otherwise(UNKNOWN).alias("family")
    # Examples are few by construction: the templates' runs, and the lines of max_docs documents.
    drawn = F.pmod(F.xxhash64("grams"), F.lit(5)) == 4
    rows = stage(examples(docs, max_docs).select("family", _grams(F.col("words")).alias("grams"), "aside").where(F.size("grams") > 0)
                 .groupBy("grams").agg(one, F.bool_and("aside").alias("aside"))
                 .select("family", "grams", label.cast("double").alias("label"), F.coalesce("aside", drawn).alias("aside")), "license-examples")
    hashed = HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features").transform(rows)
    aside = F.col("aside")
    learner = LogisticRegression(family="multinomial", regParam=1e-4, maxIter=40)
    first = Classifier(families, learner.fit(hashed.where(~aside).coalesce(1)), 0.0)
    tried = first.transform(rows.where(aside).withColumnRenamed("family", "true_family"))
    steps = [0.5 + 0.02 * i for i in range(25)]
    right = F.col("family") == F.col("true_family")
    row = tried.agg(*[F.avg(F.when(F.col("probability") >= t, right.cast("int"))).alias(f"t{i}") for i, t in enumerate(steps)]).first()
    threshold = next((t for i, t in enumerate(steps) if row[f"t{i}"] is not None and row[f"t{i}"] >= PRECISION), steps[-1])
    return Classifier(families, learner.fit(hashed.coalesce(1)), threshold)


def _holds_any(text: Column, stems: tuple[str, ...]) -> Column:
    """Plain search, much faster than a pattern; the array of one element has ``text`` computed once."""
    return F.exists(F.array(text), lambda t: reduce(Column.__or__, [t.contains(s) for s in stems]))


def find_licenses(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """doc_id, line (from 0), family, probability, similarity and confirmed of every line that names a licence family.

    Null and empty texts have none; repeated rows are searched alike; other columns are not read.
    """
    spark = docs.sparkSession
    lines = texts(docs).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "paragraph"))
    # The plain search is much faster than the pattern, which it only goes before.
    lines = lines.where(_holds_any(F.lower("paragraph"), _TELLING_STEMS)).where(F.lower("paragraph").rlike(_TELLING_TEXT))
    lines = lines.select("doc_id", "line", words_of(F.col("paragraph")).alias("words")).withColumn("grams", _grams(F.col("words")))
    named = classifier.transform(lines).where(F.col("family") != UNKNOWN)
    templates = _templates(spark, names=True).groupBy("family").agg(F.collect_set(_pairs(F.col("words"))).alias("templates"))
    # One row per family.
    both = named.withColumn("pairs", _pairs(F.col("words"))).join(F.broadcast(templates), "family")
    # A name of one word has no pair: the word itself must be there, beside one that speaks of a licence.
    speaks = F.exists("words", lambda w: w.rlike(r"licen[cs]|^spdx$"))
    own = F.when(speaks, F.concat("pairs", F.array_distinct("words"))).otherwise(F.col("pairs"))
    least = F.when(F.size("pairs") >= LONG, F.size("pairs"))
    shared = F.transform("templates", lambda t: F.size(F.array_intersect(t, F.col("own"))) / F.least(F.size(t), F.col("least")))
    both = both.withColumns({"own": own, "least": least}).withColumn("similarity", F.array_max(shared))
    return both.select("doc_id", "line", "family", "probability", "similarity", (F.col("similarity") >= CONFIRM).alias("confirmed"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return find_licenses(docs, train(docs))

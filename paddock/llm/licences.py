"""Licence families of paragraphs by a sparse n-gram logistic regression.

Everything is DataFrame, SQL and JVM machine-learning functions. Features
are the word n-grams (1 to 3) of the families' templates that hold a
trigger: a template word that hardly any corpus paragraph has. A paragraph
without a trigger has no features and is unknown, so only the others are
scored, whatever the corpus size. The classes are the families and
``unknown``; how probable a family must be is calibrated on examples kept
out of the fit, and a prediction counts as confirmed when the paragraph and
a template of the family share enough word 3-grams.

The fit reads the templates and at most about ``max_sample`` corpus
paragraphs (an id-hash sample, any line of a document); triggers come from
the counts of the template words over all paragraphs, and features and scores
cover every paragraph. Null and empty text have no paragraphs: no licence. Rows
are judged one by one (a repeated row as its twin, null ids kept); an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, text_table

UNKNOWN = "unknown"
MAX_SAMPLE = 4000
VARIANTS = 6

#: fixed values: wordings by family; `unknown` has wordings that only look alike
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "This project is released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        "This software is distributed under the terms of the MIT license.",
        "Licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the 3-Clause BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Licensed under the GPL, version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Content is available under CC BY-SA 4.0.",
        "Licensed under the Creative Commons Attribution-ShareAlike license.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Available under CC BY-NC-SA 4.0 for non commercial use.",
    ],
    "proprietary": [
        "Copyright. All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced or distributed without the prior written permission of the publisher.",
        "This software is proprietary and confidential; unauthorized copying is strictly prohibited.",
    ],
    UNKNOWN: [
        "The driver showed the police officer a driving license.",
        "The apache helicopter landed near the public school.",
        "Researchers at MIT published a new version of the study.",
        "He reserved a table and all guests had the right to speak.",
        "The general public was free to use the common library.",
        "The source of the river is subject to the mountain weather.",
        "She was granted permission to visit the foundation.",
        "The gnu is a large antelope of the creative commons of nature.",
        "Attribution of the painting is disputed by international experts.",
        "The license plate was copied and the file was closed.",
        "Its terms and conditions are met without restriction.",
        "The version of the program you received is not commercial.",
    ],
}


def words_of(c: Column) -> Column:
    return F.array_remove(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), "")


def ngrams(words: str, n: int) -> Column:
    if n == 1:
        return F.col(words)
    return F.expr(f"CASE WHEN size({words}) >= {n} THEN transform(sequence(1, size({words}) - {n - 1}), i -> array_join(slice({words}, i, {n}), ' ')) ELSE cast(array() as array<string>) END")


def template_table(spark: SparkSession) -> DataFrame:
    """(family, text) from the wordings above, as literals."""
    rows = [F.struct(F.lit(f).alias("family"), F.lit(t).alias("text")) for f, ts in TEMPLATES.items() for t in ts]
    return spark.range(1).select(F.inline(F.array(*rows)))


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, k, n, words): the lines of every text that hold a word."""
    keyed = text_table(docs).withColumn("k", F.xxhash64("doc_id", "text"))
    lines = keyed.select("doc_id", "k", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    return lines.select("doc_id", "k", "n", words_of(F.col("line")).alias("words")).where(F.size("words") > 0)


def with_features(rows: DataFrame, triggers: list[str]) -> DataFrame:
    """Adds ``terms``: the n-grams that hold a trigger."""
    every = rows.withColumn("g", F.flatten(F.array(ngrams("words", 1), ngrams("words", 2), ngrams("words", 3))))
    held = F.array(*(F.lit(t) for t in triggers)) if triggers else F.expr("cast(array() as array<string>)")
    return every.withColumn("terms", F.filter("g", lambda g: F.arrays_overlap(F.split(g, " "), held))).drop("g")


class Model:
    def __init__(self, triggers: list[str], fitted: PipelineModel, calibration: LogisticRegressionModel, families: list[str]):
        self.triggers, self.fitted, self.calibration, self.families = triggers, fitted, calibration, families

    def predict(self, rows: DataFrame) -> DataFrame:
        """Adds family (the best one) and probability (that it isn't unknown)."""
        out = margins(self.fitted.transform(with_features(rows, self.triggers)), self.families)
        out = self.calibration.transform(VectorAssembler(inputCols=["margin"], outputCol="m").transform(out))
        return out.withColumn("probability", vector_to_array("pc")[1]).drop("m", "rc", "pc", "hc", "terms", "f", "margin")


def margins(scored: DataFrame, families: list[str]) -> DataFrame:
    """family: the most probable one; margin: its log odds against unknown."""
    p = vector_to_array(F.col("probs"))
    named = F.array(*(F.struct(p[i].alias("p"), F.lit(f).alias("f")) for i, f in enumerate(families) if f != UNKNOWN))
    best = F.array_max(named)
    other = p[families.index(UNKNOWN)]
    out = scored.withColumn("_best", best).withColumn("margin", F.log((F.col("_best.p") + 1e-9) / (other + 1e-9)))
    return out.withColumn("family", F.col("_best.f")).drop("_best", "raw", "probs", "hit")


def pick_triggers(docs: DataFrame, wordings: DataFrame, like: Column, rare: float) -> list[str]:
    """Template words that at most ``rare`` of all ordinary paragraphs have,
    and the rarest word of each wording, so that none is out of reach."""
    known = [r["words"] for r in wordings.where(F.col("family") != UNKNOWN).select("words").collect()]  # the constants above
    vocabulary = sorted({w for ws in known for w in ws})
    least = min(len(set(ws[i : i + 3])) for ws in known for i in range(len(ws) - 2))
    # generators, as merged projections would split a line again for each of its n-grams
    once = paragraphs(docs).select(F.explode(F.array("words")).alias("words"))
    held = once.select("words", F.array_intersect("words", F.array(*(F.lit(w) for w in vocabulary))).alias("held"))
    held = held.select(F.inline(F.array(F.struct("words", "held"))))
    # licences may be common; they don't count as ordinary. Only paragraphs with enough template words can be like them
    alike = F.when(F.size("held") >= least, F.arrays_overlap(ngrams("words", 3), like)).otherwise(False)
    ordinary = held.where(~alike).select(F.explode(F.concat(F.array(F.lit("")), "held")).alias("w"))  # "" counts the paragraphs
    counts = {r["w"]: r["n"] for r in ordinary.groupBy("w").agg(F.count("*").alias("n")).collect()}  # at most the vocabulary
    n = max(1, counts.get("", 0))
    usable = [w for w in vocabulary if len(w) > 1]
    rarest = {min((w for w in ws if len(w) > 1), key=lambda w: (counts.get(w, 0), w)) for ws in known}
    return sorted({w for w in usable if counts.get(w, 0) <= rare * n} | rarest)


def learn(docs: DataFrame, max_sample: int = MAX_SAMPLE, rare: float = 0.005) -> Model:
    spark = docs.sparkSession
    total = max(1, docs.count())
    scale = 1 << 20
    some = docs.where(F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit("sample")), F.lit(scale)) < int(scale * min(1.0, max_sample / total)))
    # one line with a word of each text, wherever it stands
    drawn = paragraphs(some).groupBy("k").agg(F.min(F.struct(F.xxhash64("k", "n").alias("h"), "n", "words")).alias("line"))
    sample = stored(drawn.select("line.words"), "paragraph-sample")
    wordings = template_table(spark).withColumn("words", words_of(F.col("text")))
    trigrams = wordings.where(F.col("family") != UNKNOWN).select(F.explode(ngrams("words", 3)).alias("t")).distinct()
    like = F.array(*(F.lit(r["t"]) for r in trigrams.collect()))  # of the templates above
    plain = sample.where(~F.arrays_overlap(ngrams("words", 3), like))
    triggers = pick_triggers(docs, wordings, like, rare)
    # each wording whole, and with every seventh word or so left out
    variants = wordings.select("family", "words", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS))).alias("v"))
    variants = variants.withColumn("words", F.expr("CASE WHEN v = 0 THEN words ELSE filter(words, (w, i) -> pmod(xxhash64(w, i, v), 7) <> 0) END"))
    examples = plain.select(F.lit(UNKNOWN).alias("family"), "words", F.pmod(F.xxhash64("words"), F.lit(VARIANTS + 1)).cast("int").alias("v"))
    families = sorted(TEMPLATES)
    label = F.array_position(F.array(*(F.lit(f) for f in families)), F.col("family")).cast("double") - 1
    rows = stored(with_features(variants.unionByName(examples), triggers).withColumn("label", label).select("label", "terms", "v"), "licence-examples")
    stages = [
        CountVectorizer(inputCol="terms", outputCol="f", binary=True, vocabSize=1 << 14),
        LogisticRegression(featuresCol="f", labelCol="label", rawPredictionCol="raw", probabilityCol="probs", predictionCol="hit", family="multinomial", regParam=2e-4, maxIter=60),
    ]
    fitted = Pipeline(stages=stages).fit(rows.where(F.col("v") != VARIANTS))
    held = margins(fitted.transform(rows.where(F.col("v") == VARIANTS)), families)
    held = held.withColumn("known", (F.col("label") != families.index(UNKNOWN)).cast("double"))
    held = VectorAssembler(inputCols=["margin"], outputCol="m").transform(held)
    calibration = LogisticRegression(featuresCol="m", labelCol="known", rawPredictionCol="rc", probabilityCol="pc", predictionCol="hc", regParam=1e-2, maxIter=50).fit(held)
    return Model(triggers, fitted, calibration, families)


def scan(docs: DataFrame, threshold: float = 0.5, similar: float = 0.5, max_sample: int = MAX_SAMPLE) -> DataFrame:
    """doc_id, n_paragraphs (licence paragraphs), families (sorted), family,
    probability and similarity of the most probable one (null without any),
    confirmed (a paragraph's similarity to its family's template is at least
    ``similar``)."""
    model = learn(docs, max_sample)
    held = F.array(*(F.lit(t) for t in model.triggers))
    maybe = paragraphs(docs).where(F.arrays_overlap("words", held)).distinct()
    found = model.predict(maybe).where(F.col("probability") >= threshold).withColumn("g", F.array_distinct(ngrams("words", 3)))
    forms = template_table(docs.sparkSession).where(F.col("family") != UNKNOWN).withColumn("words", words_of(F.col("text")))
    forms = forms.groupBy("family").agg(F.collect_list(F.array_distinct(ngrams("words", 3))).alias("forms"))  # the constants above
    common = lambda t: F.size(F.array_intersect(t, F.col("g"))) / F.greatest(F.least(F.size(t), F.size("g")), F.lit(1))
    compared = found.join(F.broadcast(forms), "family").withColumn("similarity", F.array_max(F.transform("forms", common)))
    best = F.max(F.struct("probability", "similarity", "family")).alias("best")
    summary = compared.groupBy("k").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("family")).alias("families"), best, F.max(F.col("similarity") >= similar).alias("sure"))
    out = text_table(docs).select("doc_id", F.xxhash64("doc_id", "text").alias("k")).join(summary, "k", "left")
    return out.select(
        "doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_paragraphs"), F.coalesce(F.array_join("families", ","), F.lit("")).alias("families"),
        F.col("best.family").alias("family"), F.col("best.probability").alias("probability"), F.col("best.similarity").alias("similarity"), F.coalesce("sure", F.lit(False)).alias("confirmed"),
    )

"""Licence scan: a sparse word n-gram logistic regression over paragraphs, confirmed against templates.

Paragraphs are lines. Features are the distinct words, word pairs and word triples of a paragraph. The
multinomial regression has one class for every licence family and one for anything else; its L1 penalty
leaves few n-grams with a weight, so that nearly all n-grams of a corpus fall away in a broadcast join
with the weights (at most ``vocabulary`` rows) before anything is grouped. Class probabilities are
calibrated by one temperature that is fitted on held-out rows. A predicted family is confirmed when the
paragraph contains enough of the word triples of one of the family's templates.

Training rows: the templates, whole, in windows and between words of the corpus; and, as the class of
anything else, corpus paragraphs that resemble no template, ``negatives`` of them at most (those with the
smallest hashes). Everything runs on DataFrames and Spark's own learner.

Defined results: null and empty texts have no paragraphs and no findings; repeated rows of one id and text
give one finding for each paragraph; ties go to the family that comes first in the alphabet; a null id stays;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import query, stored, table

#: How licences are named and granted in texts.
TEMPLATES: dict[str, list[str]] = {
    "agpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "Licensed under the GNU Affero General Public License, version 3.",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License", "Licensed under the GNU Lesser General Public License, version 2.1."],
    "mit": [
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
        "SPDX-License-Identifier: MIT",
    ],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0."],
    "proprietary": ["All rights reserved. Unauthorized copying of this file, via any medium, is strictly prohibited.", "Proprietary and confidential. All rights reserved."],
    "public-domain": ["This is free and unencumbered software released into the public domain.", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0."],
}
OTHER = "other"
NEGATIVES, VOCABULARY = 5000, 20_000
MIN_PROBABILITY, MIN_SIMILARITY = 0.5, 0.6


def words(paragraph: Column) -> Column:
    return F.array_remove(F.split(F.lower(paragraph), r"[^\p{L}\p{N}]+"), "")


#: Hashes of the words, word pairs and word triples of the column w; triples are marked by the last bit.
GRAMS = (
    "flatten(transform(w, (x, i) -> filter(array(shiftleft(xxhash64(x), 1), shiftleft(xxhash64(x, get(w, i + 1)), 1), shiftleft(xxhash64(x, get(w, i + 1), get(w, i + 2)), 1) | 1), "
    "(g, k) -> i + k < size(w))))"
)


def _literal(spark: SparkSession, rows: list[dict], ddl: str) -> DataFrame:
    """A small table held in the plan itself."""
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{ddl}>>")).alias("r")).select("r.*")


def templates(spark: SparkSession) -> DataFrame:
    """family, template (number), w, grams."""
    rows = [{"family": f, "template": i, "text": t} for f, texts in sorted(TEMPLATES.items()) for i, t in enumerate(texts)]
    frame = _literal(spark, rows, "family: string, template: int, text: string")
    return frame.select("family", "template", words(F.col("text")).alias("w")).withColumn("grams", F.array_distinct(F.expr(GRAMS)))


def paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, print (hash of the text), paragraph (from 0), body for every line of every row."""
    return docs.select("doc_id", F.xxhash64("text").alias("print"), F.posexplode(F.split("text", "\n")).alias("paragraph", "body"))


def training_rows(docs: DataFrame, negatives: int = NEGATIVES) -> DataFrame:
    """label, w: labelled rows; at most ``negatives`` of them are paragraphs of ``docs``."""
    spark = docs.sparkSession
    known = templates(spark)
    triples = known.select(F.explode("grams").alias("g")).where("g & 1 = 1").distinct()
    marks = sorted(r["g"] for r in triples.collect())
    bodies = paragraphs(docs).where(F.length(F.trim("body")) > 0).select("body", F.xxhash64("body").alias("h"))
    last = bodies.select("h").orderBy("h").limit(negatives).agg(F.max("h").alias("h")).scalar()  # only hashes are gathered
    sample = bodies.where(F.col("h") <= last).select("body").dropDuplicates()
    sample = sample.select(words(F.col("body")).alias("w")).where(F.size("w") > 0)
    sample = sample.withColumn("like", F.size(F.array_intersect(F.expr(GRAMS), F.lit(marks))))
    plain = stored(sample.where("like = 0").select("w"), "licence-negatives")
    positive = known.select(F.col("family").alias("label"), "w")
    windows = F.expr("explode(transform(sequence(1, greatest(1, size(w) - 7), 2), i -> slice(w, i, 8)))")
    cut = positive.where(F.size("w") > 8).select("label", windows.alias("w"))
    # templates between words of the corpus: each is paired with a few negatives by number
    numbered = plain.select("w", F.pmod(F.xxhash64("w"), F.lit(16)).cast("int").alias("k")).groupBy("k").agg(F.min("w").alias("around"))
    inside = positive.select("label", "w", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("k")).join(numbered, "k")
    inside = inside.select("label", F.concat(F.slice("around", 1, 6), "w", F.slice("around", 7, 6)).alias("w"))
    other = plain.select(F.lit(OTHER).alias("label"), "w")
    alone = _literal(spark, [{"label": OTHER, "w": w} for w in (["license"], ["under", "the"], ["version"], ["the"], ["this", "work"], ["free"])], "label: string, w: array<string>")
    return positive.unionByName(cut).unionByName(inside).unionByName(other).unionByName(alone)


class Model:
    """Weights by n-gram hash, intercepts and temperature; ``families`` are the classes but the last, OTHER."""

    def __init__(self, families: list[str], weights: list[dict], intercepts: list[float], temperature: float):
        self.families, self.weights, self.intercepts, self.temperature = families, weights, intercepts, temperature


def fit(docs: DataFrame, negatives: int = NEGATIVES, vocabulary: int = VOCABULARY) -> Model:
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizer
    from pyspark.ml.functions import vector_to_array

    rows = training_rows(docs, negatives)
    families = [*sorted(TEMPLATES), OTHER]
    label = F.array_position(F.lit(families), F.col("label")).cast("double") - 1
    grams = F.transform(F.array_distinct(F.expr(GRAMS)), lambda g: g.cast("string"))
    rows = rows.select(label.alias("label"), grams.alias("grams"), F.xxhash64("w").alias("h"), F.when(F.col("label") == OTHER, 1.0).otherwise(4.0).alias("importance"))
    rows = stored(rows.coalesce(1).sortWithinPartitions("h", "label"), "licence-training")
    counted = CountVectorizer(inputCol="grams", outputCol="vector", vocabSize=vocabulary, minDF=2, binary=True).fit(rows)
    vectors = counted.transform(rows)
    learner = LogisticRegression(featuresCol="vector", family="multinomial", elasticNetParam=1.0, regParam=5e-4, maxIter=100, standardization=False, weightCol="importance")
    model = learner.fit(vectors.where("pmod(h, 5) <> 0 or label < {}".format(len(families) - 1)))
    matrix, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    matrix, intercepts = matrix - matrix[-1], intercepts - intercepts[-1]  # relative to OTHER
    weights = [{"g": int(g), "weights": [float(x) for x in matrix[:, k]]} for k, g in enumerate(counted.vocabulary) if abs(matrix[:, k]).max() > 1e-9]
    # temperature: the best of a grid by log loss on rows whose negatives weren't trained on
    held = model.transform(vectors.where("pmod(h, 5) = 0")).select("label", vector_to_array("rawPrediction").alias("z"))
    losses = {}
    for t in (0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0):
        own = F.get("z", F.col("label").cast("int"))
        losses[t] = F.avg(F.log(_exp_sum(F.transform("z", _divide(t)))) - (own - F.array_max("z")) / t).alias(str(t))
    found = held.agg(*losses.values()).first()
    temperature = min(losses, key=lambda t: (found[str(t)] if found[str(t)] is not None else math.inf, t))
    return Model(families, weights, [float(x) for x in intercepts], temperature)


def _divide(t: float):
    return lambda x: x / t


def _exp_sum(z: Column) -> Column:
    """Sum of exp(x - largest x) over an array."""
    return F.aggregate(F.transform(z, lambda x: F.exp(x - F.array_max(z))), F.lit(0.0), lambda a, x: a + x)


def scan(docs: DataFrame, model: Model, min_probability: float = MIN_PROBABILITY, min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """doc_id, paragraph, licence, probability, similarity, confirmed for every paragraph that is rather a licence than not.

    licence is the likeliest family; confirmed says that the paragraph contains ``min_similarity`` of the word
    triples of one of its templates.
    """
    spark = docs.sparkSession
    known = templates(spark).select("family", "template", F.explode("grams").alias("g")).where("g & 1 = 1")
    sizes = known.groupBy("family", "template").agg(F.count(F.lit(1)).alias("triples"))
    marks = [{"g": r["g"], "weights": None} for r in known.select("g").distinct().collect()]
    listed = {w["g"] for w in model.weights}
    features = _literal(spark, model.weights + [m for m in marks if m["g"] not in listed], "g: bigint, weights: array<double>")
    key = ["doc_id", "print", "paragraph"]
    spread = paragraphs(docs).select(*key, words(F.col("body")).alias("w")).select(*key, F.explode(F.expr(GRAMS)).alias("g"))
    hits = spread.join(F.broadcast(features.select("g")), "g").groupBy(*key).agg(F.collect_set("g").alias("grams"))
    hits = stored(hits, "licence-hits")
    weight = hits.select(*key, F.explode("grams").alias("g")).join(F.broadcast(features), "g")
    sums = [F.sum(F.get("weights", F.lit(k))).alias(f"z{k}") for k in range(len(model.families))]
    scored = weight.groupBy(*key).agg(*sums)
    z = F.array(*[(F.coalesce(F.col(f"z{k}"), F.lit(0.0)) + b) / model.temperature for k, b in enumerate(model.intercepts)])
    scored = scored.select(*key, z.alias("z"))
    top = F.array_max(F.slice("z", 1, len(model.families) - 1))
    total = _exp_sum(F.col("z"))
    scored = scored.select(*key, F.get(F.lit(model.families), F.array_position("z", top).cast("int") - 1).alias("licence"), (F.exp(top - F.array_max("z")) / total).alias("probability"))
    scored = scored.where(F.col("probability") >= min_probability)
    near = hits.select(*key, F.explode("grams").alias("g")).join(F.broadcast(known), "g").groupBy(*key, "family", "template").agg(F.count(F.lit(1)).alias("n"))
    near = near.join(F.broadcast(sizes), ["family", "template"]).groupBy(*key, F.col("family").alias("licence")).agg(F.max(F.col("n") / F.col("triples")).alias("similarity"))
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))
    for c in ("print", "paragraph", "licence"):
        same = same & (F.col(f"a.{c}") == F.col(f"b.{c}"))
    joined = scored.alias("a").join(near.alias("b"), same, "left")
    similarity = F.coalesce(F.col("b.similarity"), F.lit(0.0))
    return joined.select("a.doc_id", "a.paragraph", "a.licence", "a.probability", similarity.alias("similarity"), (similarity >= min_similarity).alias("confirmed"))


@query("op9_license_paragraphs")
def op9_license_paragraphs(spark, folder):
    """Licence statements in all paragraphs of all documents."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return scan(docs, fit(docs))

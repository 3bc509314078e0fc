"""Licence paragraphs in documents: a trained classifier finds them, a comparison with templates confirms them.

A paragraph is a line of a text. Lines that are not believed alone are also judged as a run of neighbouring lines, since notices are wrapped.
Its features are its word bigrams and trigrams, of those that stand in a template and have a word that is no function word. A multinomial
logistic regression with an elastic net, so that most weights are zero, is trained on varied templates of each family, on licence-like texts
of no family (`unknown`: some of their own, and the templates without the words that name their family) and on ordinary paragraphs of the
corpus, a bounded sample (`none`). Weights become a small table; paragraphs are scored by joining their n-grams with it and summing per
class. The probability below which a family is not believed is calibrated on variants that were not trained on. A believed family must also
hold MIN_SIMILARITY of the n-grams of one of its templates, and the paragraph must not name a version of which none is the family's; a
paragraph that is like a licence but passes not all of this is `unknown`. Built of DataFrame expressions and Spark's own LogisticRegression.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.decontaminate import OUTER, let, row_key, words
from orderloom.llm.tables import staging

NONE, UNKNOWN = "none", "unknown"
VARIANTS = 24  # of each template; the last quarter calibrates
DROPPED = 12  # percent of a variant's words
SAMPLE_DOCS = 1_000  # documents whose paragraphs stand for `none`: those with the smallest hash of doc_id
SAMPLE_PARAGRAPHS = 4_000
BELIEVED_SHARE = 0.02  # of calibration variants that may fall below the probability that is believed
MIN_SIMILARITY = 0.6
MARKS = r"^[\s#*/;!%-]+"  # of comments, in front of a line

# Customary notices of each family, and licence-like texts of none.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license. See LICENSE in the project root for license information."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD", "Released under the BSD 3-Clause License."),
    ("BSD", "Released under the BSD 2-Clause License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("EPL-2.0", "Licensed under the Eclipse Public License, Version 2.0."),
    ("Artistic-2.0", "You can redistribute it and/or modify it under the terms of the Artistic License, version 2.0."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    (UNKNOWN, "All rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher."),
    (UNKNOWN, "Licensed under the terms of the agreement between the parties."),
    (UNKNOWN, "Use of this software is subject to the license terms that come with it."),
    (UNKNOWN, "This work is licensed under a proprietary license; contact the authors for terms."),
    (UNKNOWN, "You may use this material for personal use only; commercial use needs a separate license."),
)
# Words that name a family. Without them, and without numbers, a notice is like a licence, but of no family.
NAMES = ("mit", "apache", "gnu", "gpl", "general", "lesser", "affero", "bsd", "2-clause", "3-clause", "mozilla", "eclipse", "artistic", "boost", "creative", "commons",
         "cc", "cc0", "by", "by-sa", "by-nc", "by-nd", "attribution", "attribution-sharealike", "attribution-noncommercial", "attribution-noderivatives", "unencumbered")
VERSION = r"(?:version|v\.?|license|licence)[\s,]+([0-9]+(?:\.[0-9]+)*)"
# Function words; an n-gram of these alone is no feature.
FUNCTION_WORDS = ("a", "an", "and", "any", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "its", "no", "not", "of", "on", "or", "that", "the",
                  "this", "to", "under", "was", "were", "with", "you")


def _forms(text: Column) -> Column:
    return F.filter(F.transform(words(text), lambda w: F.lower(F.btrim(w, F.lit(OUTER)))), lambda w: w != "")


def _grams(forms: Column, sizes: tuple[int, ...]) -> Column:
    """Hashes of the n-grams that have a word that is no function word."""
    def of_size(f, n):
        return F.when(F.size(f) >= n, F.transform(F.filter(
            F.transform(F.sequence(F.lit(1), F.size(f) - n + 1), lambda i: F.slice(f, i, F.lit(n))),
            lambda g: F.exists(g, lambda w: ~w.isin(*FUNCTION_WORDS))), lambda g: F.xxhash64(g))).otherwise(F.array().cast("array<bigint>"))
    return let(forms, lambda f: F.flatten(F.array(*[of_size(f, n) for n in sizes])))


@dataclass
class Model:
    classes: list[str]
    weights: DataFrame  # gram, weights (by class)
    intercepts: list[float]
    templates: DataFrame  # gram, template (number), size (n-grams of the template)
    families: list[str]  # by template number
    believed: float


def _logits(table: DataFrame, keys: list[str], model: Model) -> DataFrame:
    """keys, probabilities by class, from rows keys, gram."""
    sums = [F.sum(F.get("weights", F.lit(c))).alias(f"z{c}") for c in range(len(model.classes))]
    joined = table.join(F.broadcast(model.weights), "gram").groupBy(*keys).agg(*sums)  # a row per n-gram of the templates at most
    z = F.array(*[F.col(f"z{c}") + model.intercepts[c] for c in range(len(model.classes))])
    top = joined.select(*keys, z.alias("z")).withColumn("e", F.transform("z", lambda x: F.exp(x - F.array_max("z"))))
    return top.select(*keys, F.transform("e", lambda x: x / F.aggregate("e", F.lit(0.0), lambda a, b: a + b)).alias("p"))


def train(docs: DataFrame) -> Model:
    """A model from TEMPLATES and a bounded sample of the paragraphs of docs (doc_id, text)."""
    spark: SparkSession = docs.sparkSession
    stage = staging(spark)
    base = spark.createDataFrame([(i, f, t) for i, (f, t) in enumerate(TEMPLATES)], "template int, family string, text string").coalesce(1)
    forms = base.select("template", "family", _forms(F.col("text")).alias("forms"))
    grams = stage(forms.select("template", "family", F.explode(F.array_distinct(_grams(F.col("forms"), (2, 3)))).alias("gram")))
    vocabulary = sorted(r.gram for r in grams.select("gram").distinct().collect())  # fixed by TEMPLATES
    varied = forms.withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1)))).withColumn(
        "forms", F.filter("forms", lambda w, i: (F.col("variant") == 0) | (F.pmod(F.xxhash64(w, i, F.col("variant")), F.lit(100)) >= DROPPED)))
    named = F.filter("forms", lambda w: ~w.isin(*NAMES) & ~w.rlike("[0-9]"))
    nameless = varied.filter((F.col("family") != UNKNOWN) & (F.size(named) < F.size("forms")) & (F.col("variant") % 4 != 2)).select(
        F.lit(UNKNOWN).alias("family"), "variant", F.transform("forms", lambda w: F.when(w.isin(*NAMES) | w.rlike("[0-9]"), "\x01").otherwise(w)).alias("forms"))
    varied = varied.select("family", "variant", "forms").unionByName(nameless).select("family", "variant", _grams(F.col("forms"), (2, 3)).alias("grams"))
    varied = varied.select("family", "variant", F.array_intersect("grams", F.array(*[F.lit(g) for g in vocabulary])).alias("grams")).filter("size(grams) > 0")
    ids = stage(docs.filter("doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS))
    lines = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select(F.explode(F.split("text", "\n")).alias("text"))  # SAMPLE_DOCS ids
    known = F.array(*[F.lit(g) for g in vocabulary])
    plain = lines.select("text", _grams(_forms(F.col("text")), (2, 3)).alias("grams")).filter(F.size("grams") > 0)
    # a paragraph half of whose n-grams are a template's may be a licence: it stands for nothing
    plain = plain.filter(F.size(F.array_intersect("grams", known)) < 0.5 * F.size("grams")).orderBy(F.xxhash64("text")).limit(SAMPLE_PARAGRAPHS)
    examples = varied.unionByName(plain.select(F.lit(NONE).alias("family"), F.lit(1).alias("variant"), "grams"))
    classes = [NONE, *sorted({f for f, _ in TEMPLATES})]
    number = F.array_position(F.array(*map(F.lit, classes)), F.col("family")) - 1
    examples = stage(examples.select("family", "variant", number.cast("double").alias("label"), F.transform("grams", lambda g: g.cast("string")).alias("grams")).coalesce(2))
    vectors = CountVectorizerModel.from_vocabulary([str(g) for g in vocabulary], inputCol="grams", outputCol="features")
    vectors.setBinary(True)
    is_held = F.col("variant") >= VARIANTS * 3 // 4
    fitted = LogisticRegression(family="multinomial", regParam=2e-4, elasticNetParam=0.5, maxIter=60, standardization=False).fit(
        vectors.transform(examples.filter(~is_held)))
    matrix, intercepts = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    missing = len(classes) - len(matrix)  # classes without examples, if the corpus has no paragraph
    rows = [(g, [float(x) for x in matrix[:, j]] + [0.0] * missing) for j, g in enumerate(vocabulary)]
    weights = stage(spark.createDataFrame(rows, "gram long, weights array<double>").coalesce(1))
    size = grams.groupBy("template").agg(F.count("*").alias("size"))
    model = Model(classes, weights, [*map(float, intercepts), *[-50.0] * missing], stage(grams.join(size, "template").select("gram", "template", "size").coalesce(1)),
                  [f for f, _ in TEMPLATES], 0.0)
    held = stage(examples.filter(is_held & ~F.col("family").isin(NONE, UNKNOWN)).withColumn("row", F.monotonically_increasing_id()))
    scored = _logits(held.select("row", "label", F.explode(F.transform(F.array_distinct("grams"), lambda g: g.cast("long"))).alias("gram")), ["row", "label"], model)
    right = F.get("p", F.col("label").cast("int"))
    model.believed = float(scored.agg(F.percentile(right, F.lit(BELIEVED_SHARE))).first()[0] or 0.5)
    return model


def _judged(features: DataFrame, keys: list[str], model: Model) -> DataFrame:
    """keys, predicted_family, probability, n (the nearest template), similarity, confirmed of what is like a licence, from rows keys, gram."""
    scored = _logits(features, keys, model).withColumn("best", F.array_position("p", F.array_max("p")).cast("int") - 1).filter("best > 0")
    classes = F.array(*map(F.lit, model.classes))
    scored = scored.select(*keys, F.get(classes, F.col("best")).alias("predicted_family"), F.array_max("p").alias("probability"))
    common = features.join(F.broadcast(model.templates), "gram").groupBy(*keys, "template").agg((F.count("*") / F.first("size")).alias("similarity"))
    common = common.withColumn("predicted_family", F.get(F.array(*map(F.lit, model.families)), F.col("template")))
    nearest = common.groupBy(*keys, "predicted_family").agg(F.max(F.struct("similarity", (-F.col("template")).alias("t"))).alias("n"))
    judged = scored.join(nearest, [*keys, "predicted_family"], "left").withColumn("similarity", F.coalesce("n.similarity", F.lit(0.0)))
    return judged.withColumn("confirmed", (F.col("predicted_family") != UNKNOWN) & (F.col("probability") >= model.believed) & (F.col("similarity") >= MIN_SIMILARITY))


def _version(number: Column) -> Column:
    return F.regexp_replace(number, r"(\.0)+$", "")


def _other_version(family: Column, text: Column) -> Column:
    """Whether the text names versions, and none is that of the family."""
    own = _version(F.nullif(F.regexp_extract(family, r"-([0-9.]+)$", 1), F.lit("")))
    said = F.transform(F.regexp_extract_all(F.lower(text), F.lit(VERSION), F.lit(1)), _version)
    return own.isNotNull() & (F.size(said) > 0) & ~F.array_contains(said, own)


def licence_paragraphs(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per licence-like paragraph of docs (doc_id, text): doc_id, paragraph (line, from 0), family, predicted_family, probability,
    template, similarity, confirmed, text.

    family is the predicted one if its probability is believed and a template confirms it, else `unknown`; lines of a wrapped notice have
    the figures of the whole run. Null and empty texts have no
    paragraphs. Repeated rows are reported once. Extra columns are not read. Without documents the result is empty.
    """
    stage = staging(docs.sparkSession)
    model = model or train(docs)
    line = docs.select("doc_id", row_key(docs).alias("row_key"), F.posexplode(F.split("text", "\n")).alias("paragraph", "text"))
    pairs = line.select("row_key", "paragraph", F.explode(_grams(_forms(F.col("text")), (2,))).alias("gram"))
    # a trigram feature holds a bigram feature, so bigrams find every paragraph with a feature
    found = stage(pairs.join(F.broadcast(model.weights.select("gram")), "gram").select("row_key", "paragraph").distinct())
    lines = line.join(found.select("row_key").distinct(), "row_key", "left_semi").join(found, ["row_key", "paragraph"], "left_semi")
    lines = stage(lines.dropDuplicates(["row_key", "paragraph"]))
    keys = ["row_key", "paragraph"]
    features = stage(lines.select(*keys, F.explode(F.array_distinct(_grams(_forms(F.col("text")), (2, 3)))).alias("gram")))
    alone = _judged(features, keys, model).join(lines.select(*[F.col(k).alias(f"{k}_") for k in keys], "text"), (F.col("row_key") == F.col("row_key_")) & (F.col("paragraph") == F.col("paragraph_")))
    alone = stage(alone.withColumn("confirmed", F.col("confirmed") & ~_other_version(F.col("predicted_family"), F.col("text"))).drop("row_key_", "paragraph_", "text"))
    # lines that were not believed, in runs of neighbours: a line's number less its place among them is the same all over a run
    loose = lines.join(alone.filter("confirmed").select(*keys), keys, "left_anti").groupBy("row_key").agg(F.sort_array(F.collect_list(F.struct("paragraph", "text"))).alias("l"))
    loose = stage(loose.select("row_key", F.posexplode("l").alias("i", "l")).select("row_key", (F.col("l.paragraph") - F.col("i")).alias("run"), "l.*"))
    runs = loose.groupBy("row_key", "run").agg(F.sort_array(F.collect_list(F.struct("paragraph", F.regexp_replace("text", MARKS, "").alias("text")))).alias("l"))
    runs = runs.filter("size(l) > 1").select("row_key", "run", F.array_join(F.col("l.text"), " ").alias("text"))
    runs = stage(runs)
    wrapped = _judged(runs.select("row_key", "run", F.explode(F.array_distinct(_grams(_forms(F.col("text")), (2, 3)))).alias("gram")), ["row_key", "run"], model)
    wrapped = wrapped.join(runs.withColumnsRenamed({"row_key": "row_key_", "run": "run_"}), (F.col("row_key") == F.col("row_key_")) & (F.col("run") == F.col("run_")))
    wrapped = wrapped.withColumn("confirmed", F.col("confirmed") & ~_other_version(F.col("predicted_family"), F.col("text"))).drop("row_key_", "run_", "text")
    wrapped = loose.select(*keys, "run").join(wrapped.filter("confirmed"), ["row_key", "run"]).drop("run")
    judged = alone.join(wrapped.select(*keys, F.struct(*[c for c in wrapped.columns if c not in keys]).alias("w")), keys, "full")
    judged = judged.select(*keys, *[F.coalesce(f"w.{c}", c).alias(c) for c in wrapped.columns if c not in keys])
    return judged.join(lines, keys).select(
        "doc_id", "paragraph", F.when(F.col("confirmed"), F.col("predicted_family")).otherwise(F.lit(UNKNOWN)).alias("family"), "predicted_family",
        "probability", (-F.col("n.t")).alias("template"), "similarity", "confirmed", "text")

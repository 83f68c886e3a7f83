"""Licence scan: a trained paragraph classifier whose predictions a template comparison confirms.

A paragraph is a line of a text, or a passage over several lines, as in hard-wrapped licences and source headers. Its features are the words and word pairs it shares with the
templates below. A multinomial logistic regression over the licence families and an unknown
class is trained on variations of the templates (cut, with words dropped or replaced), and, for the
unknown class, on paragraphs of the corpus and on jumbled template words; its temperature
is fitted on held-out examples, so the probabilities are calibrated. A family counts only
if its probability is at least one half and the paragraph's word pairs agree with one of the
family's templates.

Only lines are scored that hold a word pair of a template, a family's own short word (FAMILY_WORDS) or a
template word of at least six letters; the template check would refuse all others. Passages are
looked for in windows of words that cover the whole text, whatever its line breaks and comment marks: where
a window agrees with a template, the passage goes from the first to the last word pair they share.
Different paragraphs are scored once each, however often they occur.
"""

from __future__ import annotations

import math
import random
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_lens.llm.common import join_spread, staging

# Sentences by which the families' licences are declared, from the licences' public texts.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the Software), to deal in the Software without restriction.",
    ],
    "Apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance"
        " with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation.",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation.",
    ],
    "BSD": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met.",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "reserved": [
        "Copyright. All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced without prior written permission.",
    ],
}
UNKNOWN = "unknown"
WORDS = r"[a-z0-9]+"
ANCHOR_LETTERS = 6
FAMILY_WORDS = ["bsd", "cc", "gnu", "mit", "nc"]
#: A window for passages begins at every so many words; it holds so many more than the longest template.
STEP = 16
#: Unknown paragraphs to learn from: at most so many, none longer than so many characters.
EXAMPLES, LONGEST_EXAMPLE = 1500, 2000
#: Least share of the shorter one's word pairs that a paragraph and a template have in common.
AGREEMENT = 0.5


def tokens(text: str) -> list[str]:
    return re.findall(WORDS, text.lower())


def pairs(words: list[str]) -> list[str]:
    return [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def grams(words: list[str]) -> set[str]:
    return {*words, *pairs(words)}


class Model(NamedTuple):
    families: list[str]
    #: Per feature one weight for each family, then one for the unknown class; temperature included.
    weights: dict[str, list[float]]
    bias: list[float]


def _examples(rng: random.Random, others: list[str], per_template: int) -> list[tuple[list[str], str]]:
    """Variations of the templates with their family, and unknown ones."""
    out = []
    every = [w for texts in TEMPLATES.values() for t in texts for w in tokens(t)]
    for family, texts in TEMPLATES.items():
        for text in texts:
            words = tokens(text)
            out.append((words, family))
            for _ in range(per_template):
                size = rng.randint(max(3, math.ceil(0.7 * len(words))), max(3, len(words)))
                begin = rng.randint(0, max(0, len(words) - size))
                kept = [w for w in words[begin : begin + size] if rng.random() > 0.05]
                extra = rng.choice(others).split()[: rng.randint(0, 4)] if others and rng.random() < 0.3 else []
                out.append((kept + [w for e in extra for w in tokens(e)], family))
                jumbled = [rng.choice(every) for _ in range(rng.randint(2, len(words)))]
                out.append((jumbled, UNKNOWN))
    out += [(tokens(t), UNKNOWN) for t in others]
    return out


def _trained(x, y, classes: int, rounds: int = 400, decay: float = 1e-4):
    """Multinomial logistic regression by gradient descent with momentum over all rows."""
    import numpy as np

    w, v = np.zeros((x.shape[1], classes)), np.zeros((x.shape[1], classes))
    aim = np.eye(classes)[y]
    for _ in range(rounds):
        p = _softmax(x @ w)
        v = 0.9 * v - 1.0 * (x.T @ (p - aim) / len(x) + decay * w)
        w = w + v
    return w


def _softmax(z):
    import numpy as np

    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(docs: DataFrame, sample: int = 300, per_template: int = 30, seed: int = 3, text: str = "text") -> Model:
    """Train on variations of the templates and the paragraphs of at most ``sample`` documents, chosen by a hash of the text."""
    import numpy as np

    known = {g for texts in TEMPLATES.values() for t in texts for g in grams(tokens(t))}
    own = docs.select(F.col(text).alias("t")).filter("t is not null").withColumn("h", F.xxhash64("t"))
    # Only hashes are sorted; the texts of at most ``sample`` of them are read again.
    few = own.join(F.broadcast(own.select("h").distinct().orderBy("h").limit(sample)), "h").dropDuplicates(["h"])
    few = few.select(F.explode(F.split("t", "\n")).alias("line")).filter(F.length("line").between(1, LONGEST_EXAMPLE))
    few = few.distinct().orderBy(F.xxhash64("line"), "line").limit(EXAMPLES).collect()
    lines = sorted(r["line"] for r in few if r["line"].strip())
    # Lines of the sample that are themselves licence lines teach nothing about the unknown.
    others = [t for t in lines if len(set(pairs(tokens(t))) & known) <= 1]
    rng = random.Random(seed)
    rng.shuffle(others)
    rows = _examples(rng, others, per_template)
    rng.shuffle(rows)
    families = list(TEMPLATES)
    number = {g: i for i, g in enumerate(sorted(known))}
    x = np.zeros((len(rows), len(number) + 1))
    x[:, -1] = 1
    for i, (words, _) in enumerate(rows):
        x[i, [number[g] for g in grams(words) if g in number]] = 1
    classes = [*families, UNKNOWN]
    y = np.array([classes.index(f) for _, f in rows])
    part = len(rows) * 2 // 3
    w = _trained(x[:part], y[:part], len(classes))
    loss = lambda t: -np.log(_softmax(x[part:] @ w / t)[np.arange(len(rows) - part), y[part:]] + 1e-12).mean()
    w /= min((0.25 * 1.2**k for k in range(16)), key=loss)
    return Model(families, {g: w[i].tolist() for g, i in number.items()}, w[-1].tolist())


def _paragraph_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORDS})"))


def _pairs(words: Column) -> Column:
    # No access by index: where a filter is pushed down, ``words`` would be computed again for each.
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat_ws(" ", a, b))


def _passages(texts: DataFrame) -> DataFrame:
    """Passages over several lines that share word pairs enough with a template: doc, row, paragraph, last, words."""
    spark, stage = texts.sparkSession, staging(texts.sparkSession)
    sets = [sorted(set(pairs(tokens(t)))) for ts in TEMPLATES.values() for t in ts]
    span = STEP + max(len(tokens(t)) for ts in TEMPLATES.values() for t in ts)
    words = F.flatten(
        F.transform("lines", lambda line, i: F.transform(_paragraph_words(line), lambda w: F.struct(w.alias("w"), i.alias("i"))))
    )
    every = texts.select("doc", "row", words.alias("all")).filter(F.size("all") > 1)
    starts = F.sequence(F.lit(0), F.size("all") - 1, F.lit(STEP))
    cut = every.select("doc", "row", F.posexplode(F.transform(starts, lambda s: F.slice("all", s + 1, span))).alias("at", "own"))
    cut = cut.filter(F.element_at("own", 1)["i"] < F.element_at("own", -1)["i"])
    known = sorted({p for own in sets for p in own})
    # A window that agrees with a template shares two word pairs with it at least.
    cut = cut.withColumn("near", F.filter(_pairs(F.col("own.w")), lambda p: p.isin(known)))
    cut = stage(cut.filter(F.size(F.array_distinct("near")) > 1).drop("near"), "cut")
    table = spark.createDataFrame([(t, len(own), p) for t, own in enumerate(sets) for p in own], "t int, n int, gram string")
    grams = cut.select("row", "at", _pairs(F.col("own.w")).alias("pairs"))
    grams = grams.select("row", "at", F.size(F.array_distinct("pairs")).alias("m"), F.posexplode("pairs").alias("j", "gram"))
    met = grams.join(F.broadcast(table), "gram").groupBy("row", "at", "t").agg(
        F.size(F.collect_set("gram")).alias("shared"), F.least(F.first("n"), F.first("m")).alias("least"),
        F.min("j").alias("begin"), F.max("j").alias("end"),
    )
    met = met.filter(F.col("shared") >= AGREEMENT * F.col("least")).select("row", "at", "begin", "end").distinct()
    own = F.slice("own", F.col("begin") + 1, F.col("end") - F.col("begin") + 2)
    met = cut.join(met, ["row", "at"]).select("doc", "row", own.alias("own"))
    met = met.select(
        "doc", "row", F.element_at("own", 1)["i"].alias("paragraph"), F.element_at("own", -1)["i"].alias("last"), F.col("own.w").alias("words")
    )
    return met.filter("paragraph < last").distinct()


def _apart(out: DataFrame) -> DataFrame:
    """Of paragraphs that overlap in a text the one that shares most with its template, then that of fewer lines.

    A line that holds a whole template stays next to a passage of another family.
    """
    both = out.filter("last > paragraph").select("row").distinct()
    names = ["paragraph", "last", "family", "probability", "template", "agreement", "whole"]
    rank = F.struct((-F.col("agreement") * F.col("shared")).alias("rank"), (F.col("last") - F.col("paragraph")).alias("lines"), *names)
    mixed = out.join(both, "row").groupBy("row").agg(F.first("doc").alias("doc"), F.sort_array(F.collect_list(rank)).alias("units"))

    def hides(k: Column, u: Column) -> Column:
        meet = (k["paragraph"] <= u["last"]) & (u["paragraph"] <= k["last"])
        return meet & ((k["family"] == u["family"]) | ~(k["whole"] | u["whole"]))

    def add(kept: Column, u: Column) -> Column:
        return F.when(F.exists(kept, lambda k: hides(k, u)), kept).otherwise(F.concat(kept, F.array(u)))

    kept = F.aggregate("units", F.filter("units", lambda u: F.lit(False)), add)
    mixed = mixed.select("doc", F.explode(kept).alias("u")).select("doc", *(f"u.{c}" for c in names))
    return out.join(both, "row", "left_anti").select("doc", *names).unionByName(mixed)


def scan(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per licence paragraph: key, paragraph (number of its first line, from 0), family, probability, template, agreement.

    ``family`` is ``unknown`` where the classifier names a family for a line that no template confirms;
    paragraphs that it finds unknown itself give no row. Whole texts are read; a null or empty
    text gives no rows, a null key stays null, repeated rows each give theirs. Columns other
    than ``key`` and ``text`` are not read.
    """
    spark, stage = docs.sparkSession, staging(docs.sparkSession)
    anchors = sorted({w for texts in TEMPLATES.values() for t in texts for w in tokens(t) if len(w) >= ANCHOR_LETTERS})
    known_pairs = sorted({p for texts in TEMPLATES.values() for t in texts for p in pairs(tokens(t))})
    texts = docs.select(F.col(key).alias("doc"), F.monotonically_increasing_id().alias("row"), F.split(text, "\n").alias("lines"))
    lines = texts.select("doc", "row", F.posexplode("lines").alias("paragraph", "line"))
    lines = lines.withColumn("words", _paragraph_words(F.col("line")))
    found = lines.filter(
        F.exists("words", lambda w: w.isin([*anchors, *FAMILY_WORDS])) | F.exists(_pairs(F.col("words")), lambda p: p.isin(known_pairs))
    )
    found = found.select("doc", "row", "paragraph", F.col("paragraph").alias("last"), "words").unionByName(_passages(texts))
    found = found.withColumn("id", F.md5(F.concat_ws(" ", "words")))
    found = stage(found, "found")
    different = stage(found.groupBy("id").agg(F.first("words").alias("words"), F.count(F.lit(1)).alias("n")), "different")
    parts = different.select("id", _pairs(F.col("words")).alias("pairs"), "words")
    all_grams = parts.select("id", F.explode(F.array_distinct(F.concat("words", "pairs"))).alias("gram"))

    # Both tables follow from the templates alone: some hundred rows.
    names = [*model.families, UNKNOWN]
    table = spark.createDataFrame([(g, w) for g, w in model.weights.items()], "gram string, w array<double>")
    scores = all_grams.join(F.broadcast(table), "gram").groupBy("id").agg(
        *(F.sum(F.col("w")[i]).alias(f"s{i}") for i in range(len(names)))
    )
    logits = [F.col(f"s{i}") + b for i, b in enumerate(model.bias)]
    top = F.greatest(*logits)
    total = sum((F.exp(z - top) for z in logits), F.lit(0.0))
    best = F.greatest(*(F.struct(z.alias("z"), F.lit(i).alias("i")) for i, z in enumerate(logits)))
    predicted = scores.select("id", best["i"].alias("i"), (F.exp(best["z"] - top) / total).alias("probability"))
    predicted = predicted.filter((F.col("i") < len(model.families)) & (F.col("probability") >= 0.5))

    sets = [(names.index(f), k, len(set(p)), p) for f, ts in TEMPLATES.items() for k, t in enumerate(ts) for p in [pairs(tokens(t))]]
    known = spark.createDataFrame([(i, k, n, g) for i, k, n, p in sets for g in set(p)], "i int, template int, n int, gram string")
    own = parts.select("id", F.size(F.array_distinct("pairs")).alias("m"), F.explode(F.array_distinct("pairs")).alias("gram"))
    shared = own.join(F.broadcast(known), "gram").groupBy("id", "i", "template").agg(
        F.count(F.lit(1)).alias("shared"), F.least(F.first("n"), F.first("m")).alias("least"), F.first("n").alias("whole")
    )
    shared = shared.withColumn("agreement", F.col("shared") / F.col("least"))
    confirmed = shared.groupBy("id", "i").agg(F.max(F.struct("agreement", -F.col("template"), "shared", "whole")).alias("best"))
    judged = predicted.join(confirmed, ["id", "i"], "left").join(different.select("id", "n"), "id")
    agreement = F.coalesce(F.col("best.agreement"), F.lit(0.0))
    label = F.when(agreement >= AGREEMENT, F.element_at(F.array(*map(F.lit, names)), F.col("i") + 1)).otherwise(UNKNOWN)
    judged = judged.select(
        "id", label.alias("family"), F.round("probability", 6).alias("probability"), (-F.col("best.col2")).alias("template"),
        F.round(agreement, 6).alias("agreement"), F.coalesce("best.shared", F.lit(0)).alias("shared"),
        F.coalesce(F.col("best.shared") == F.col("best.whole"), F.lit(False)).alias("all"), "n",
    )
    places = found.select("doc", "row", "paragraph", "last", "id")
    out = join_spread(places, stage(judged, "judged"), "id", "n").filter("family is not null")
    out = out.filter((F.col("paragraph") == F.col("last")) | (F.col("family") != UNKNOWN))
    out = stage(out.withColumn("whole", F.col("all") & (F.col("paragraph") == F.col("last"))), "judged")
    return _apart(out).select(F.col("doc").alias(key), "paragraph", "family", "probability", "template", "agreement")

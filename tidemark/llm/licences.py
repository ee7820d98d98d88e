"""Licence scan: a trained paragraph classifier, in DataFrame functions and Spark ML.

A paragraph is a line with a word.  Its features are the words and word pairs that the
training notices have, and how many other words there are; a multinomial logistic
regression with L1 (sparse weights) tells licence families and ``unknown`` apart.  It is
trained on the template sentences below, cut and varied by rule, against all corpus
paragraphs that no template resembles, together as heavy as ``UNKNOWN_ROWS`` of them.
``unknown`` is calibrated on a quarter of these paragraphs (by hash), kept out of the
training: the acceptance threshold is the least probability, in steps of 1 / ``STEPS``, at
which at most ``FALSE_RATE`` of them would be accepted, and never under ``LEAST``.
A notice may stand inside a longer line.  Every template is therefore laid against the
stretch of the line that fits it best, and both ways: twice the word pairs they share
over the pairs of both (a line of up to ``BLOCK`` words may instead lie inside a
template, as a line of a wrapped licence does: the share of its own pairs).  The words
of the best stretch are what is classified.  A prediction is confirmed when a template
of its family fits by ``CONFIRM`` or more and no other family's fits better; close
relatives (Affero, no-derivatives and the like) are families of their own, so that they
are not taken for their neighbours.

Scored are all paragraphs with a cue word and all others that half of their word
pairs could confirm (the templates' pairs taken together); no template could confirm
the rest, which are unknown whatever the classifier says and give no row.  The corpus is
read once: the paragraphs to score and the features of the others are written.

Rows: null and empty texts have no paragraphs; repeated rows give repeated rows; a
null id is kept; an empty table gives no rows (nothing to train on: the templates
alone, and every other paragraph stays unknown).
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import text_of, written

UNKNOWN_WEIGHT = 0.1   # of one unknown row in training, against 1 of a template's
UNKNOWN_ROWS = 2000    # the corpus weighs as so many unknown rows at most, however many it has
HELD = 4               # one paragraph of so many calibrates
OTHERS = (1, 2, 4, 8, 16, 32, 64)   # features: so many words that no training notice has
FALSE_RATE = 0.005
STEPS = 10_000
LEAST = 0.5
CONFIRM = 0.5
BLOCK, STRIDE = 128, 64   # a line's word pairs are compared in overlapping blocks
UNKNOWN = "unknown"

# Customary notices and grant sentences of public licence families.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction."),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an as is basis, without warranties or conditions of any kind."),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation.",
        "Released under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-3.0-or-later"),
    "agpl": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Affero General Public License as published by the Free Software Foundation.",
        "Released under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-or-later"),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later"),
    "bsd": (
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met."),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0"),
    "cc_by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0"),
    "cc_by_sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0"),
    "cc_by_nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "cc_by_nd": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-ND-4.0"),
    "cc_by_nc_sa": (
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-SA-4.0"),
    "cc_by_nc_nd": (
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-ND-4.0"),
    "cc0": (
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "SPDX-License-Identifier: CC0-1.0"),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense"),
    "proprietary": (
        "All rights reserved.",
        "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited."),
}
CUES = ("licen", "copyright", "spdx", "redistribut", "warrant", "public domain", "all rights", "proprietary",
        "permission is", "cc by", "cc0", "unencumbered")


def words(text: Column) -> Column:
    """Lower-case words; digits become one sign, so a version does not matter."""
    return F.regexp_extract_all(F.regexp_replace(F.lower(text), "[0-9]+", "0"), F.lit(r"[\p{L}0]+"), F.lit(0))


def pairs(column: str) -> Column:
    """Each word but the last, with the next one."""
    return F.transform(F.slice(column, F.lit(1), F.greatest(F.size(column) - 1, F.lit(0))),
                       lambda w, i: F.concat(w, F.lit(" "), F.get(column, i + 1)))


def terms(words_col: str) -> Column:
    """The training notices' words and pairs that are among a line's, and marks for the
    number of its other words.  A pair is put together only where its first word begins one."""
    known, known_pairs = _vocabulary()
    own = F.filter(words_col, lambda w: w.isin(known))
    other = F.size(words_col) - F.size(own)
    marks = F.filter(F.array(*[F.when(other >= n, F.lit(f"+{n}")) for n in OTHERS]), lambda m: m.isNotNull())
    return F.array_distinct(F.concat(own, pairs_among(words_col, known_pairs), marks))


def pairs_among(words_col: str, known: list[str]) -> Column:
    """The word pairs of a line that are ``known``, in order."""
    firsts = sorted({p.split(" ")[0] for p in known})
    made = F.transform(words_col, lambda w, i: F.when(w.isin(firsts), F.concat(w, F.lit(" "), F.get(words_col, i + 1))))
    return F.filter(made, lambda p: p.isin(known))


def vectors(rows: DataFrame) -> DataFrame:
    """Rows with ``terms``: their features."""
    known, known_pairs = _vocabulary()
    model = CountVectorizerModel.from_vocabulary([*known, *known_pairs, *[f"+{n}" for n in OTHERS]], "terms", "features")
    return model.setBinary(True).transform(rows)


def featured(rows: DataFrame) -> DataFrame:
    """Rows with a ``paragraph``: its words, terms and features."""
    return vectors(rows.withColumn("words", words(F.col("paragraph"))).withColumn("terms", terms("words")))


def lines(docs: DataFrame, text_col: str, *keep: Column) -> DataFrame:
    """``line, paragraph, words`` of every line.  The words come out of the generator,
    so that later filters read them and do not work them out again."""
    each = F.transform(F.split(text_of(text_col), "\n"),
                       lambda x: F.struct(x.alias("paragraph"), words(x).alias("words")))
    made = docs.select(*keep, F.posexplode(each).alias("line", "made"))
    return made.select(*[c for c in made.columns if c != "made"], "made.*")


def may_count(met: str) -> Column:
    """Whether a line has a cue word or could be confirmed at all: the share of its
    word pairs that any one template has is at most the share that all have.  ``met``:
    how many distinct ones all have.  A line has at least as many distinct pairs as
    distinct words, less one, so most lines' pairs need not be put together."""
    def share(n: Column) -> Column:
        return F.col(met) >= CONFIRM * F.greatest(n, F.lit(1))

    confirmed = F.when(F.col(met) == 0, False).when(~share(F.size(F.array_distinct("words")) - 1), False).otherwise(
        share(F.size(F.array_distinct(pairs("words")))))
    return _any(F.lower("paragraph")) | confirmed


def _pairs_of(template: str) -> list[str]:
    got = _words_of(template)
    return [f"{a} {b}" for a, b in zip(got, got[1:])]


def _words_of(text: str) -> list[str]:
    return re.findall(r"(?:[^\W\d_]|0)+", re.sub("[0-9]+", "0", text.lower()))


def _vocabulary() -> tuple[list[str], list[str]]:
    """Words and word pairs of the training notices."""
    texts = [t for _, t, _ in notices()]
    return (sorted({w for t in texts for w in _words_of(t)}), sorted({p for t in texts for p in _pairs_of(t)}))


def _templates() -> list[tuple[str, list[str]]]:
    """Family and distinct word pairs of every template."""
    return [(f, list(dict.fromkeys(_pairs_of(t)))) for f, ts in TEMPLATES.items() for t in ts]


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is read there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fits(words_col: str, pairs_col: str) -> Column:
    """How each template that shares a pair with the line fits it: ``sim``, where its
    best stretch starts (negative, so that the greatest is the leftmost) and ends, and the
    template's number."""
    every = _templates()
    holds: dict[str, list[int]] = {}
    for t, (_, own) in enumerate(every):
        for p in own:
            holds.setdefault(p, []).append(t)
    templates_of = F.create_map(*[x for p, ts in holds.items() for x in (F.lit(p), F.array(*[F.lit(t) for t in ts]))])
    sizes = F.array(*[F.lit(len(own)) for _, own in every])
    n = F.size(pairs_col)
    alone = n <= BLOCK

    def block(b: Column) -> Column:
        part = F.slice(pairs_col, b * STRIDE + 1, F.lit(BLOCK))
        known = F.filter(F.transform(part, lambda p, k: F.struct((k + b * STRIDE).alias("i"), p.alias("p"))),
                         lambda x: x["p"].isin(list(holds)))
        hits = F.flatten(F.transform(known, lambda x: F.transform(
            F.element_at(templates_of, x["p"]), lambda t: F.struct(t.alias("t"), x["i"].alias("i"), x["p"].alias("p")))))
        own_pairs = F.when(alone, F.size(F.array_distinct(part)))
        return _once(F.struct(hits.alias("hits"), own_pairs.alias("own_pairs")), lambda x: F.transform(
            F.array_distinct(F.transform(x["hits"], lambda h: h["t"])),
            lambda t: _once(F.filter(x["hits"], lambda h: h["t"] == t), lambda own: best(t, own, x["own_pairs"]))))

    def best(t: Column, own: Column, own_pairs: Column) -> Column:
        size = F.element_at(sizes, t + 1)
        shared = F.size(F.array_distinct(F.transform(own, lambda x: x["p"])))
        # a whole line that lies inside the template
        whole = F.when(alone, shared / own_pairs).otherwise(0.0)

        def measured(h: Column, inside: Column) -> Column:
            last = F.array_max(F.transform(inside, lambda x: x["i"]))
            both = F.size(F.array_distinct(F.transform(inside, lambda x: x["p"])))
            return F.struct((F.lit(2.0) * both / (size + last - h["i"] + 1)).alias("sim"), (-h["i"]).alias("start"),
                            last.alias("last"), t.alias("t"))

        def stretch(h: Column) -> Column:
            inside = F.filter(own, lambda x: (x["i"] >= h["i"]) & (x["i"] < h["i"] + size + size / 2 + 1))
            return _once(inside, lambda x: measured(h, x))

        return _once(F.array_max(F.transform(own, stretch)), lambda got: F.when(
            whole > got["sim"], F.struct(whole.alias("sim"), F.lit(0).alias("start"), (n - 1).alias("last"),
                                         t.alias("t"))).otherwise(got))

    blocks = F.sequence(F.lit(0), F.greatest(F.ceil((n - BLOCK) / STRIDE), F.lit(0)).cast("int"))
    return F.flatten(F.transform(blocks, block))


def stretch(words_col: str, best: str) -> Column:
    """The words of the stretch that fits a template best (all where nothing fits)."""
    start = -F.col(f"{best}.start")
    return F.when(F.col(best).isNull(), F.col(words_col)).otherwise(
        F.slice(words_col, start + 1, F.col(f"{best}.last") - start + 2))


def focused(rows: DataFrame) -> DataFrame:
    """Rows with a ``paragraph``: ``fits``, and the features of the stretch that fits a
    template best (of the whole paragraph where nothing fits)."""
    rows = rows.withColumn("words", words(F.col("paragraph"))).withColumn("pairs", pairs("words"))
    rows = rows.withColumn("fits", fits("words", "pairs")).withColumn("best", F.array_max("fits"))
    return vectors(rows.withColumn("words", stretch("words", "best")).withColumn("terms", terms("words")))


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, line, paragraph, held, features`` of all paragraphs.  Those that may count
    have their text and are to be scored; the others have features instead, ``held`` ones
    those of their best stretch, as a scored line has."""
    known = sorted({p for _, own in _templates() for p in own})
    rows = lines(docs, text_col, F.col(f"`{id_col}`").alias("doc_id")).filter(F.size("words") > 0)
    rows = rows.withColumn("met", F.size(F.array_distinct(pairs_among("words", known))))
    rows = rows.withColumn("counts", may_count("met"))
    rows = rows.withColumn("held", F.pmod(F.xxhash64("paragraph"), F.lit(HELD)) == 0)
    rows = rows.withColumn("pairs", F.when(~F.col("counts") & F.col("held") & (F.col("met") > 0), pairs("words")))
    rows = rows.withColumn("best", F.when(F.col("pairs").isNotNull(), F.array_max(fits("words", "pairs"))))
    rows = rows.withColumn("words", stretch("words", "best"))
    rows = rows.withColumn("terms", F.when(F.col("counts"), F.array().cast("array<string>")).otherwise(terms("words")))
    return vectors(rows).select("doc_id", "line", F.when(F.col("counts"), F.col("paragraph")).alias("paragraph"),
                                "held", "features")


def _any(low: Column) -> Column:
    found = F.lit(False)
    for c in CUES:
        found = found | low.contains(c)
    return found


def notices() -> list[tuple[str, str, bool]]:
    """Family, text and whether it is held out: templates with their varied forms, and
    ``unknown`` sentences with cue words outside a licence."""
    rows = []
    for family, texts in TEMPLATES.items():
        for t in texts:
            w = t.split()
            forms = [t, t.lower(), t.upper(), f"Copyright 2020 the authors. {t}", f"{t} See the LICENSE file.", f"// {t}",
                     f"{t} {t}"]
            if len(w) > 6:
                forms += [" ".join(w[:i] + w[i + 1:]) for i in range(0, len(w), 3)]
                forms += [" ".join(w[:-2]), " ".join(w[1:])]
            rows += [(family, f, i % 5 == 4) for i, f in enumerate(forms)]
    near = [(UNKNOWN, t, i % 4 == 0) for i, t in enumerate((   # cue words outside a licence
        "The driver was fined because the licence had expired.", "No warranty claims were made last year.",
        "They asked for permission to enter the building.", "Copyright is a chapter of this book.",
        "The song is in the public domain.", "The licence fee rose again.", "A proprietary blend of herbs.",
        "The factory redistributed the work among its staff.", "Copyright 2021 by the author.",
        "The pub lost its license to sell beer."))]
    return rows + near


def threshold_of(held: DataFrame) -> float:
    """The least ``probability``, in steps, at which at most ``FALSE_RATE`` of the rows are
    accepted; at most ``STEPS`` + 1 counts come to the driver."""
    counts = dict(held.groupBy(F.floor(F.col("probability") * STEPS).cast("int").alias("step")).count().collect())
    allowed, accepted = FALSE_RATE * sum(counts.values()), 0
    for step in range(STEPS, round(LEAST * STEPS) - 1, -1):
        accepted += counts.get(step, 0)
        if accepted > allowed:
            return (step + 1) / STEPS
    return LEAST


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per paragraph with a cue word or enough template pairs: ``doc_id, line,
    family`` (``unknown`` unless the prediction is likely enough and confirmed), ``predicted, probability,
    similarity``."""
    spark = docs.sparkSession
    classes = [*TEMPLATES, UNKNOWN]
    number = F.create_map(*[x for i, c in enumerate(classes) for x in (F.lit(c), F.lit(float(i)))])
    corpus = written(paragraphs(docs, id_col, text_col), "licence-paragraphs")
    plain = corpus.filter(F.col("paragraph").isNull())
    fitted = plain.filter(~F.col("held"))
    each = UNKNOWN_WEIGHT * min(1.0, UNKNOWN_ROWS / max(fitted.count(), 1))
    known = featured(spark.createDataFrame(notices(), "family string, paragraph string, held boolean").coalesce(1))
    rows = known.filter(~F.col("held")).select(
        number[F.col("family")].alias("label"), F.when(F.col("family") == UNKNOWN, UNKNOWN_WEIGHT).otherwise(1.0).alias("weight"),
        "features").unionAll(fitted.select(F.lit(float(len(TEMPLATES))), F.lit(each), "features"))
    model = LogisticRegression(regParam=0.0005, elasticNetParam=0.8, maxIter=40, standardization=False,
                               weightCol="weight").fit(rows)

    def predicted(df: DataFrame) -> DataFrame:
        probable = vector_to_array("probability")
        return (model.transform(df).withColumn("p", probable)
                .withColumn("at", F.array_position("p", F.array_max(F.slice("p", 1, len(TEMPLATES)))))
                .withColumn("predicted", F.element_at(F.array(*[F.lit(c) for c in classes]), F.col("at").cast("int")))
                .withColumn("probability", F.array_max(F.slice("p", 1, len(TEMPLATES)))))

    near = focused(known.filter(F.col("held") & (F.col("family") == UNKNOWN)).select("paragraph")).select("features")
    threshold = threshold_of(predicted(near.unionAll(plain.filter("held").select("features"))))

    family_of = F.array(*[F.lit(f) for f, _ in _templates()])
    own = F.filter("fits", lambda x: F.element_at(family_of, x["t"] + 1) == F.col("predicted"))
    similarity = F.coalesce(F.array_max(F.transform(own, lambda x: x["sim"])), F.lit(0.0))
    closest = F.coalesce(F.col("best.sim"), F.lit(0.0))
    scored = corpus.filter(F.col("paragraph").isNotNull()).select("doc_id", "line", "paragraph")
    got = predicted(focused(scored)).withColumn("similarity", similarity)
    sure = (F.col("probability") >= threshold) & (F.col("similarity") >= CONFIRM) & (F.col("similarity") >= closest)
    return got.select("doc_id", F.col("line").cast("long").alias("line"),
                      F.when(sure, F.col("predicted")).otherwise(UNKNOWN).alias("family"),
                      "predicted", "probability", "similarity")

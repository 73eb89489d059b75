"""Licence scan: a trained paragraph classifier, confirmed by templates.

A paragraph is a line (a long one is cut into overlapping windows of words), or what goes over a
line's end: up to WINDOW words of lines without a blank one between them.  Every paragraph that the
templates can confirm (below; so this leaves out none that could be named) is turned into hashed
word 1- and 2-grams and classified by a sparse (L1) multinomial logistic regression over licence families and ``unknown``.  The training set is
made of the notices below, parts of them, and versions with words left out, against a bounded
sample of the corpus's own paragraphs and of sentences that use licence words otherwise.  The
unknown class is calibrated on held-out training rows: a family is only named above the
probability that at most CALIBRATED of the held-out unknown paragraphs reach.  A prediction
then has to be confirmed by the family's templates: it must share at least CONFIRMED of the
smaller side's word 2-grams with one of them.  A notice that goes over line ends counts once in its
block of lines, and not at all if a line of it is named the same by itself.

Only DataFrame operations and ``pyspark.ml`` are used.

Defined cases: null text counts as empty and has no licence; rows that share doc_id and text
get the same result each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfeat import session
from clickfeat.llm import common

FEATURES = 1 << 13
WINDOW, STEP = 48, 24
#: Corpus paragraphs used as unknown ones; a fixed bound.
UNKNOWN_ROWS = 1000
CALIBRATED = 0.01
CONFIRMED = 0.5
UNKNOWN = "unknown"

#: Public licence notices, by family.
NOTICES = {
    "MIT": [
        "Released under the MIT License.", "Licensed under the MIT license.", "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "Released under the Apache 2.0 license.", "Available under Apache 2.0.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 2.", "Released under the GPL version 3 or later.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "LGPL": [
        "Released under the LGPL version 3 or later.", "Licensed under the LGPL, version 2.1.", "Licensed under the GNU Lesser General Public License, version 2.1.", "This library is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
    ],
    "BSD": [
        "Released under the BSD License.", "Licensed under the 3-clause BSD license.", "Use of this source code is governed by a BSD-style license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "CC": [
        "Licensed under CC BY-NC 4.0.", "Licensed under CC BY 4.0.", "Released under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC-SA 3.0.",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.", "To the extent possible under law, the author has waived all copyright under CC0 1.0 Universal.",
        "This work has been dedicated to the public domain.", "Released into the public domain under CC0.",
    ],
    "proprietary": [
        "All rights reserved.", "Copyright. All rights reserved.", "No part of this publication may be reproduced without the prior written permission of the publisher.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.",
    ],
}
#: Licence words in other use.
OTHERWISE = [
    "The driver lost his license after the accident.", "A fishing license costs ten dollars in this state.", "Her poetic license was noted by all critics.",
    "The license plate of the car was covered in mud.", "The warranty on the washing machine ends next year.", "She had permission to leave the house early.",
    "The public house was released from debt.", "The general asked the public for patience.", "He reserved all tables for the evening.",
    "The rights of the workers were discussed at length.", "The apache helicopter landed at noon.", "The students at MIT published a paper.",
    "A copy of the letter was sent to the editor.", "The restaurant applied for a license to serve wine.", "The version of the story he told was not true.",
    "The software was slow and crashed twice.", "Conditions on the road were bad after the storm.", "The foundation granted money for the new library.",
]
#: Stems of which no paragraph taken as an unknown one has any.
ANCHORS = r"(?i)[al]gpl|\bcc[\x20-]by|apache[\x20-]2|licen[cs]|copyright|rights\x20reserved|public\x20domain|permission|redistribut|warrant|\bgpl|\bmpl\b|\bcc0\b|\bcc\x20by|creative\x20commons|proprietary|prohibited|\bbsd\b|may\x20be\x20reproduced"


def words(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), r"[^a-z0-9.]+|\.(?=\s|$)"), lambda w: F.length(w) > 0)


def pairs(w: Column) -> Column:
    """The distinct word 2-grams."""
    many = F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - 1, F.lit(1))), lambda i: F.concat_ws(" ", F.slice(w, i, F.lit(2))))
    return F.array_distinct(F.when(F.size(w) > 0, many).otherwise(F.array().cast("array<string>")))


def grams(w: Column) -> Column:
    return F.concat(w, pairs(w))


def templates(spark: SparkSession) -> DataFrame:
    """(family, t): the distinct word 2-grams of every notice."""
    rows = spark.createDataFrame([(f, t) for f, ts in NOTICES.items() for t in ts], "family string, line string")
    return rows.select("family", pairs(words(F.col("line"))).alias("t"))


def shares(t: Column, g: Column, size: Column) -> Column:
    """The share of the smaller side's 2-grams that template ``t`` and ``g`` share; ``size``: of the paragraph's."""
    return F.size(F.array_intersect(t, g)) / F.least(F.size(t), size)


def telling(listed: list[list[str]]) -> tuple[list[str], int]:
    """Words of the templates, long ones first, that leave each template less than half of its 2-grams, and eight at
    most, without any of them; and the most 2-grams left."""
    chosen: set[str] = set()
    left = lambda t: [p for p in t if not chosen & set(p.split())]
    for t in listed:
        while len(rest := left(t)) > min(8, (len(t) - 1) // 2):
            chosen.add(max((w for p in rest for w in p.split()), key=lambda w: (len(w), w)))
    return sorted(chosen), max(len(left(t)) for t in listed)


def confirmable(listed: list[list[str]]):
    """Can any template confirm the paragraph of these words?  No classifier is asked.

    Without a telling word a paragraph shares at most ``rest`` 2-grams with a template, less than half of the template's,
    and too few for a paragraph of over 2 * rest different ones, as one of over 2 * rest + 1 different words has."""
    found, rest = telling(listed)
    tells = "(?:^| )(?:" + "|".join(x.replace(".", "\\.") for x in found) + ")(?: |$)"
    some = lambda w: F.concat_ws(" ", w).rlike(tells) | (F.size(F.array_distinct(w)) <= 2 * rest + 1)
    text = lambda x: F.array(*[F.lit(p) for p in x])
    every = sorted({p for t in listed for p in t})
    single = F.array(*[text(t) for t in listed])

    def gate(w: Column) -> Column:
        # exists over one value names it, so that it is computed once
        def known(g: Column) -> Column:
            return F.exists(F.array(F.filter(g, lambda p: p.isin(every))), lambda h: (F.size(h) > 0) & F.exists(single, lambda t: shares(t, h, F.size(g)) >= CONFIRMED))
        return some(w) & F.exists(F.array(pairs(w)), known)

    return gate


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, __h, w, block, line, last): the words of every paragraph that a template can confirm, its block of lines,
    and its lines (last > line: it goes over line ends)."""
    gate = confirmable([r.t for r in templates(docs.sparkSession).collect()])
    d = docs.select("doc_id", common.text_hash().alias("__h"), F.transform(F.split(F.coalesce("text", F.lit("")), r"\n"), words).alias("lines"))
    blank = F.transform("lines", lambda w, i: F.when(F.size(w) == 0, i))
    d = d.withColumn("blank", F.filter(blank, lambda i: i.isNotNull()))
    one = lambda w, i, j: F.struct(w.alias("w"), i.alias("line"), j.alias("last"))
    starts = lambda w: F.sequence(F.lit(1), F.greatest(F.size(w) - STEP, F.lit(1)), F.lit(STEP))
    own = F.flatten(F.transform("lines", lambda w, i: F.transform(starts(w), lambda k: one(F.slice(w, k, F.lit(WINDOW)), i, i))))

    def over(w: Column, i: Column) -> Column:
        """From at most STEP words before the end of line i, WINDOW words until a blank line."""
        first = F.slice(w, F.greatest(F.size(w) - STEP + 1, F.lit(1)), F.lit(STEP))
        start = F.struct(first.alias("w"), i.alias("last"), F.lit(True).alias("open"))

        def step(acc: Column, x: Column) -> Column:
            more = acc["open"] & (F.size(x) > 0) & (F.size(acc["w"]) < WINDOW)
            return F.struct(F.when(more, F.slice(F.concat(acc["w"], x), 1, WINDOW)).otherwise(acc["w"]).alias("w"),
                            F.when(more, acc["last"] + 1).otherwise(acc["last"]).alias("last"), more.alias("open"))

        return F.aggregate(F.slice("lines", i + 2, F.lit(WINDOW)), start, step, lambda acc: one(acc["w"], i, acc["last"]))

    wrapped = F.filter(F.transform("lines", lambda w, i: F.when((F.size(w) > 0) & (F.size(F.get("lines", i + 1)) > 0), over(w, i))), lambda x: x.isNotNull())
    d = d.select("doc_id", "__h", "blank", F.filter(F.concat(own, wrapped), lambda x: (F.size(x["w"]) > 0) & gate(x["w"])).alias("found"))
    # as a table, the list is computed once and not again in a filter on its size
    d = common.table(d, "licence-found")
    d = d.select("doc_id", "__h", "blank", F.explode("found").alias("x")).select("doc_id", "__h", "x.w", "x.line", "x.last", "blank")
    return d.select("doc_id", "__h", "w", "line", "last", F.size(F.filter("blank", lambda i: i < F.col("line"))).alias("block"))


def training_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(family, w, fold): notices, parts of them and versions with words left out; unknown paragraphs; a hash names the fold."""
    rows = [(f, t) for f, ts in NOTICES.items() for t in ts]
    known = spark.createDataFrame(rows, "family string, line string").select("family", words(F.col("line")).alias("w"))
    other = spark.createDataFrame([(UNKNOWN, t) for t in OTHERWISE], "family string, line string").select("family", words(F.col("line")).alias("w"))
    both = known.unionByName(other).withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(11))))
    # version v leaves out every word whose hash says so (none in version 0)
    drop = F.filter(F.transform(F.col("w"), lambda x: F.when((F.col("v") > 0) & (F.pmod(F.xxhash64(x, F.col("v")), F.lit(10)) == 0), "").otherwise(x)), lambda x: x != "")
    both = both.select("family", drop.alias("w"))
    line = F.explode(F.split(F.coalesce("text", F.lit("")), r"\n"))
    hashed = docs.select(F.xxhash64("text").alias("k"), "text")
    few = hashed.select("k").distinct().orderBy("k").limit(UNKNOWN_ROWS // 4)      # the hashes first: no task sorts texts
    corpus = (hashed.join(F.broadcast(few), "k").dropDuplicates(["k"]).select(line.alias("line"))
              .filter(~F.col("line").rlike(ANCHORS)).select(F.lit(UNKNOWN).alias("family"), F.slice(words(F.col("line")), 1, WINDOW).alias("w")))
    corpus = corpus.filter(F.size("w") > 0).orderBy(F.xxhash64("w")).limit(UNKNOWN_ROWS)
    # words of any paragraph around an anchor word are not evidence
    mixed = corpus.select("family", F.concat(F.slice("w", 1, 6), F.array(F.element_at(F.array(*[F.lit(x) for x in ("license", "permission", "copyright", "warranty", "public", "rights")]),
                          (F.pmod(F.xxhash64("w"), F.lit(6)) + 1).cast("int"))), F.slice("w", 7, 12)).alias("w"))
    return both.unionByName(corpus).unionByName(mixed).withColumn("fold", F.pmod(F.xxhash64("family", "w"), F.lit(5)))


def features(df: DataFrame) -> DataFrame:
    return HashingTF(inputCol="g", outputCol="features", numFeatures=FEATURES, binary=True).transform(df.withColumn("g", grams(F.col("w"))))


def fit(spark: SparkSession, docs: DataFrame):
    """(model, families, threshold)."""
    families = [UNKNOWN, *sorted(NOTICES)]
    rows = common.table(training_rows(spark, docs), "licence-training")
    label = F.array_position(F.array(*[F.lit(x) for x in families]), F.col("family")).cast("double") - 1
    rows = features(rows.coalesce(1)).withColumn("label", label).select("features", "label", "fold").cache()
    # families and unknown weigh the same however many rows they have
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    weight = F.element_at(F.array(*[F.lit(1.0 / max(1, counts.get(float(i), 1))) for i in range(len(families))]), (F.col("label") + 1).cast("int")) * 100
    rows = rows.withColumn("weight", weight)
    lr = LogisticRegression(maxIter=40, regParam=1e-3, elasticNetParam=0.5, weightCol="weight", family="multinomial")
    model = session.detached(lr.fit(rows.filter("fold <> 0")))
    seen = model.transform(rows.filter("fold = 0 and label = 0")).select((1 - F.element_at(as_array("probability"), 1)).alias("p"))
    reached = seen.approxQuantile("p", [1 - CALIBRATED], 0.0)
    rows.unpersist()
    return model, families, max(0.5, reached[0] if reached else 0.0)


def as_array(column: str) -> Column:
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(F.col(column))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_paragraphs (confirmed ones), families (comma-joined, by name), family (the
    likeliest, or none), score (its probability, 0 for none)."""
    spark = docs.sparkSession
    model, families, least = fit(spark, docs)
    # a paragraph that many documents share is classified once
    found = common.table(paragraphs(docs), "licence-paragraphs")
    distinct = found.select("w").distinct()
    p = model.transform(features(distinct)).withColumn("p", as_array("probability"))
    best = F.array_max(F.slice("p", 2, len(families) - 1))
    named = F.element_at(F.array(*[F.lit(x) for x in families]), F.array_position(F.slice("p", 2, len(families) - 1), best).cast("int") + 1)
    p = p.select("w", named.alias("family"), best.alias("score"), (1 - F.element_at("p", 1)).alias("known")).filter((F.col("known") >= least) & (F.col("score") >= 0.5))
    known = templates(spark).groupBy("family").agg(F.collect_list("t").alias("templates"))
    p = p.withColumn("g", pairs(F.col("w"))).join(F.broadcast(known), "family")          # one row per family
    shared = F.array_max(F.transform("templates", lambda t: shares(t, F.col("g"), F.size("g"))))
    sure = common.table(p.filter(shared >= CONFIRMED).select("w", "family", "score"), "licence-sure")
    many = found.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    sure = sure.join(many, "w")
    got = common.lookup(found, sure, ["w"], F.struct("doc_id", "__h"))
    wraps = F.col("last") > F.col("line")
    part = got.groupBy("doc_id", "__h", "block", "family").agg(
        F.count(F.when(~wraps, 1)).alias("own"), F.max(F.when(~wraps, F.col("score"))).alias("top_own"), F.max("score").alias("top_any"),
        F.collect_set(F.when(~wraps, F.col("line"))).alias("lines"), F.collect_set(F.when(wraps, F.struct("line", "last"))).alias("wraps"))
    # what goes over line ends counts where no line of it has that name by itself
    free = F.exists("wraps", lambda x: ~F.exists("lines", lambda i: (x["line"] <= i) & (i <= x["last"])))
    part = part.select("doc_id", "__h", "family", (F.col("own") + free.cast("long")).alias("n"), F.when(free, F.col("top_any")).otherwise(F.col("top_own")).alias("score"))
    top = F.max(F.struct("score", "family"))
    per = part.groupBy("doc_id", "__h").agg(F.sum("n").alias("n_paragraphs"), F.array_join(F.sort_array(F.collect_set("family")), ",").alias("families"), top.alias("top"))
    per = per.select(F.col("doc_id").alias("__id"), F.col("__h").alias("__g"), "n_paragraphs", "families", "top")
    d = docs.select("doc_id", common.text_hash().alias("__h"))
    j = d.join(per, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__g")), "left")
    return j.select("doc_id", F.coalesce("n_paragraphs", F.lit(0)).alias("n_paragraphs"), F.coalesce("families", F.lit("")).alias("families"),
                    F.coalesce("top.family", F.lit("none")).alias("family"), F.coalesce("top.score", F.lit(0.0)).alias("score"))

"""Licence families of paragraphs: a trained classifier, confirmed by templates.

Paragraphs (lines) are hashed word uni- and bigrams. A multinomial logistic
regression tells the licence families and ``none`` apart. It learns from the
families' templates, plain and set into words of the corpus, and from a bounded
sample of corpus lines (``SAMPLE`` documents and lines, by least hash) that share
little with any template.

The unknown class is calibrated on a part of these rows that training did not see:
a family counts only above a probability halfway between what other lines reach and
what lines of the family keep. A paragraph below it that is not ``none`` either is
unknown. A family is confirmed if a template of it has at least ``SHARE`` of its
three-word shingles in the paragraph, and the paragraph the words that tell the family
from its relatives (``TELLING``); else the paragraph is unknown too.

A notice may run over several lines up to a line without a word, or stand within a long
line. Texts that share a shingle with a template are therefore searched for stretches
that have ``SHARE`` of a template; the words of such a stretch are classified and
confirmed like a paragraph. Only texts that have one of the templates' ``anchors`` can have
such a stretch; they are found by plain search, before any text is split. It counts at the line where it starts, and the other lines
it runs over are not unknown.

All text is scored, on the JVM, without Python.

Defined cases: null and empty texts have no paragraph; lines without a word don't
count; rows of equal doc_id and text get equal results; other columns are ignored;
without documents there are no rows.
"""

from __future__ import annotations

import re

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, stage

NONE, UNKNOWN = "none", "unknown"
PLACES = 1 << 12
SAMPLE = 2000
SHINGLE = 3
SHARE = 0.6
#: Notices by which licences are commonly named.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    ],
    "bsd": [
        "Use of this source code is governed by a BSD-style license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
    ],
    "reserved": [
        "Copyright. All rights reserved.",
        "All rights reserved.",
    ],
}
#: Relatives of these families, which differ by a word or two.
RELATIVES = {
    "agpl": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "lgpl": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
    ],
}
FURTHER = r"(?! (?:nc|nd|sa|non ?commercial|no ?deriv|share ?alike))"
#: What the words of a notice must have to be of a family that has relatives.
TELLING = {
    "agpl": r"\b(?:affero|agpl)",
    "cc-by": rf"\b(?:cc by|commons attribution)\b{FURTHER}",
    "cc-by-nc": rf"\b(?:cc by|attribution) (?:nc|non ?commercial)\b{FURTHER}",
    "cc-by-sa": r"\b(?:cc by|attribution) (?:sa|share ?alike)\b",
    "gpl": r"\b(?:gnu general public|gnu gpl)\b",
    "lgpl": r"\b(?:lesser general|library general|lgpl)",
}


def tokens(line: Column) -> Column:
    return F.array_remove(F.split(F.lower(line), r"[^\p{L}\p{N}.]+|\.(?!\p{N})"), "")


def shingles(words: Column, width: int = SHINGLE) -> Column:
    """Runs of words, or all of them if they are fewer."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - width + 1, F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda k: F.array_join(F.slice(words, k, width), " ")))


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, sig, place, words) of every line that has a word."""
    lines = docs.select(
        "doc_id", F.xxhash64("text").alias("sig"), F.posexplode(F.split("text", "\n")).alias("place", "line")
    )
    return lines.select("doc_id", "sig", "place", tokens(F.col("line")).alias("words")).where(
        F.size("words") > 0
    )


def template_table(spark: SparkSession, templates: dict[str, list[str]]) -> DataFrame:
    rows = [(name, text) for name, texts in sorted(templates.items()) for text in texts]
    return spark.createDataFrame(rows, "family string, template string").select(
        "family", tokens(F.col("template")).alias("words")
    )


def closeness(words: Column, template_words: Column) -> Column:
    """Share of a template's shingles that the paragraph has."""
    own = shingles(template_words)
    return F.size(F.array_intersect(shingles(words), own)) / F.size(own)


def told(words: Column, family: Column) -> Column:
    """Whether the words have what tells the family from its relatives."""
    text = F.array_join(words, " ")
    verdict = F.lit(True)
    for name, pattern in TELLING.items():
        verdict = F.when(family == name, text.rlike(pattern)).otherwise(verdict)
    return verdict


def anchors(templates: list[list[str]], share: float = SHARE) -> list[str]:
    """Words of which every text has one that has ``share`` of a template's shingles.

    Of each template the longest words, until the shingles without any of them are fewer
    than that share.
    """
    found: set[str] = set()
    for words in templates:
        last = max(len(words) - SHINGLE + 1, 1)
        own = {tuple(words[k : k + SHINGLE]) for k in range(last)}
        for word in sorted(set(words), key=lambda x: (-len(x), x)):
            if sum(found.isdisjoint(shingle) for shingle in own) < share * len(own):
                break
            found.add(word)
    return sorted(found)


def stretches(docs: DataFrame, templates: DataFrame, share: float = SHARE) -> DataFrame:
    """(doc_id, sig, family, place, last, words, around): where a template begins and ends.

    ``place`` and ``last`` are lines, ``around`` has a few words more than ``words``.
    """
    own = templates.select("family", shingles(F.col("words")).alias("own"), (2 * F.size("words")).alias("reach"))
    texts = [row.words for row in templates.select("words").collect()]  # given by the caller, a few rows
    docs = docs.where(F.lower("text").rlike("|".join(map(re.escape, anchors(texts, share))) or r"\z."))
    listed = templates.agg(F.array_distinct(F.flatten(F.collect_list(shingles(F.col("words"))))).alias("all"))
    known = F.array(*map(F.lit, listed.first()["all"] or [])).cast("array<string>")
    # through an array of one, as the words must not be split anew for every shingle
    words = F.array(tokens(F.col("text")))
    some = docs.where(F.get(F.transform(words, lambda x: F.arrays_overlap(shingles(x), known)), F.lit(0)))
    some = some.select("doc_id", F.xxhash64("text").alias("sig"), "text").dropDuplicates(["doc_id", "sig"])
    lines = some.select("doc_id", "sig", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    lines = lines.select("doc_id", "sig", "place", tokens(F.col("line")).alias("words"))
    order = Window.partitionBy("doc_id", "sig").orderBy("place")
    blocks = (
        lines.withColumn("block", F.sum(F.when(F.size("words") == 0, 1).otherwise(0)).over(order))
        .where(F.size("words") > 0)
        .groupBy("doc_id", "sig", "block")
        .agg(F.array_sort(F.collect_list(F.struct("place", "words"))).alias("lines"))
        .select(
            "doc_id",
            "sig",
            F.flatten("lines.words").alias("words"),
            F.flatten(F.transform("lines", lambda x: F.array_repeat(x["place"], F.size(x["words"])))).alias("places"),
        )
    )
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - SHINGLE + 1, F.lit(1)))
    runs = F.transform(starts, lambda k: F.array_join(F.slice("words", k, SHINGLE), " "))
    near = (
        blocks.withColumn("runs", runs)
        .join(F.broadcast(own), F.arrays_overlap("runs", "own"))
        .where(F.size(F.array_intersect("runs", "own")) >= share * F.size("own"))
        .withColumn(
            "hits", F.filter(F.transform("runs", lambda x, k: F.when(F.array_contains("own", x), k)), F.isnotnull)
        )
    )

    def ahead(at: Column) -> Column:
        return F.slice("runs", at + 1, F.col("reach"))

    def shared(part: Column) -> Column:
        return F.size(F.array_intersect(part, "own"))

    def step(acc: Column, at: Column) -> Column:
        most = shared(ahead(at))
        lengths = F.sequence(F.lit(1), F.size(ahead(at)))
        least = F.array_min(F.filter(lengths, lambda n: shared(F.slice("runs", at + 1, n)) == most))
        end = at + least - 1
        found = F.concat(acc["found"], F.array(F.struct(at.alias("first"), end.alias("end"))))
        begins = (at > acc["end"]) & (most >= share * F.size("own"))
        return F.when(begins, F.struct(end.alias("end"), found.alias("found"))).otherwise(acc)

    none = F.struct(
        F.lit(-1).alias("end"), F.array().cast("array<struct<first:int,end:int>>").alias("found")
    )
    each = near.withColumn("one", F.explode(F.aggregate("hits", none, step)["found"]))
    size = F.col("one.end") - F.col("one.first") + SHINGLE
    return each.select(
        "doc_id",
        "sig",
        "family",
        F.get("places", F.col("one.first")).alias("place"),
        F.get("places", F.least(F.col("one.end") + SHINGLE, F.size("words")) - 1).alias("last"),
        F.slice("words", F.col("one.first") + 1, size).alias("words"),
        F.slice("words", F.col("one.first") + 1, size + SHINGLE).alias("around"),
    )


def training_rows(docs: DataFrame, templates: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(family, words, fold): templates, templates within corpus words, corpus lines."""
    least = docs.where("text is not null and doc_id is not null").select("doc_id").distinct()
    least = least.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    lines = paragraphs(docs.join(F.broadcast(least), "doc_id", "left_semi")).distinct()
    order = F.xxhash64("doc_id", "sig", "place")
    chosen = lines.withColumn("order", order).orderBy("order", "doc_id", "sig", "place").limit(sample)
    listed = templates.agg(F.collect_list(F.struct("family", "words")).alias("listed"))
    families = listed.first()["listed"]  # the templates given by the caller, a few rows
    known = F.array(
        *(
            F.struct(
                F.lit(row["family"]).alias("family"),
                F.array(*map(F.lit, row["words"])).alias("words"),
            )
            for row in families
        )
    )
    most = F.array_max(F.transform(known, lambda row: closeness(F.col("words"), row["words"])))
    clean = chosen.where(most < 0.5).withColumn("fold", F.pmod("order", F.lit(4)))
    negatives = clean.select(F.lit(NONE).alias("family"), "words", "fold")
    one = F.get(known, F.pmod(F.shiftright("order", 8), F.lit(len(families))).cast("int"))
    within = clean.select(
        one["family"].alias("family"),
        F.when(
            F.col("fold") % 2 == 0, F.concat(F.slice("words", 1, 4), one["words"])
        ).otherwise(F.concat(one["words"], F.slice("words", 1, 4))).alias("words"),
        "fold",
    )
    plain = templates.select("family", "words", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("fold"))
    many = plain.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(5)))).drop("again")
    return negatives.unionByName(within).unionByName(many.withColumn("fold", F.col("fold").cast("long")))


class Classifier:
    """The fitted pipeline, its class names and the probability a family needs."""

    def __init__(self, model: PipelineModel, names: list[str], cut: float):
        self.model, self.names, self.cut = model, names, cut

    def classify(self, lines: DataFrame) -> DataFrame:
        """``lines`` with family and chance: the likeliest family, none or unknown."""
        scored = self.model.transform(lines).withColumn("_p", vector_to_array("probability"))
        names = F.array(*map(F.lit, self.names))
        best = F.get(names, F.col("prediction").cast("int"))
        chance = F.array_max("_p")
        family = F.when(best == NONE, NONE).when(chance >= self.cut, best).otherwise(UNKNOWN)
        return scored.select(*lines.columns, family.alias("family"), chance.alias("chance"))


def train(docs: DataFrame, templates: DataFrame, sample: int = SAMPLE, places: int = PLACES) -> Classifier:
    names = [NONE] + sorted(row.family for row in templates.select("family").distinct().collect())
    index = F.array_position(F.array(*map(F.lit, names)), F.col("family")) - 1
    rows = stage(training_rows(docs, templates, sample).withColumn("label", index.cast("double")), "training")
    steps = [
        NGram(n=2, inputCol="words", outputCol="_pairs"),
        HashingTF(numFeatures=places, inputCol="words", outputCol="_one", binary=True),
        HashingTF(numFeatures=places, inputCol="_pairs", outputCol="_two", binary=True),
        VectorAssembler(inputCols=["_one", "_two"], outputCol="_features"),
        LogisticRegression(featuresCol="_features", labelCol="label", family="multinomial", regParam=1e-3, maxIter=40),
    ]
    model = Pipeline(stages=steps).fit(rows.where("fold <> 3"))
    chance = vector_to_array("probability")
    seen = model.transform(rows.where("fold = 3")).select(
        "family",
        F.get(chance, F.col("label").cast("int")).alias("own"),
        F.array_max(F.slice(chance, 2, len(names))).alias("other"),
    )
    ends = seen.agg(
        F.percentile_approx(F.when(F.col("family") == NONE, F.col("other")), 0.99, 10_000).alias("low"),
        F.percentile_approx(F.when(F.col("family") != NONE, F.col("own")), 0.05, 10_000).alias("high"),
    ).first()
    cut = ((ends["low"] or 0.0) + (ends["high"] if ends["high"] is not None else 1.0)) / 2
    discard(rows)
    return Classifier(model, names, cut)


def scan(docs: DataFrame, templates: DataFrame, classifier: Classifier, share: float = SHARE) -> DataFrame:
    """doc_id, n_paragraphs, n_licensed, n_unknown, licences of every row."""
    lines = paragraphs(docs)
    found = classifier.classify(lines).where(F.col("family") != NONE)
    own = templates.select(F.col("family").alias("_family"), F.col("words").alias("_words"))
    own_share = F.when(told(F.col("words"), F.col("_family")), closeness(F.col("words"), F.col("_words")))
    confirmed = (
        found.join(own, F.col("family") == F.col("_family"), "left")
        .withColumn("_near", F.coalesce(own_share, F.lit(0.0)))
        .groupBy("doc_id", "sig", "place", "family")
        .agg(F.max("_near").alias("_near"))
    )
    family = F.when(F.col("_near") >= share, F.col("family")).otherwise(UNKNOWN)
    judged = confirmed.select("doc_id", "sig", "place", F.col("place").alias("last"), family.alias("family"))
    runs = stage(stretches(docs, templates, share).withColumnRenamed("family", "_own"), "stretches")
    runs = classifier.classify(runs).where((F.col("family") == F.col("_own")) & told(F.col("around"), F.col("_own")))
    known = F.col("family") != UNKNOWN
    over = F.flatten(F.collect_list(F.when(known, F.sequence("place", "last"))))
    per_doc = (
        judged.unionByName(runs.select("doc_id", "sig", "place", "last", "family"))
        .groupBy("doc_id", "sig")
        .agg(
            F.count_distinct(F.when(known, F.col("place"))).alias("n_licensed"),
            F.size(F.array_except(F.collect_set(F.when(~known, F.col("place"))), over)).cast("long").alias("n_unknown"),
            F.array_join(F.array_sort(F.collect_set(F.when(known, F.col("family")))), ",").alias("licences"),
        )
    )
    all_lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(r"[\p{L}\p{N}]"))
    counted = docs.select(
        "doc_id", F.xxhash64("text").alias("sig"), F.size(all_lines).cast("long").alias("n_paragraphs")
    )
    same = F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d.sig") == F.col("p.sig"))
    return counted.alias("d").join(per_doc.alias("p"), same, "left").select(
        "d.doc_id",
        "n_paragraphs",
        F.coalesce("n_licensed", F.lit(0)).alias("n_licensed"),
        F.coalesce("n_unknown", F.lit(0)).alias("n_unknown"),
        F.coalesce("licences", F.lit("")).alias("licences"),
    )

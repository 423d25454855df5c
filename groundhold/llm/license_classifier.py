"""Licence paragraphs: sparse word n-gram logistic regression with a calibrated unknown class, confirmed by templates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACE, SPACES, materialize, words

# Short public notices, by licence family.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    ],
    "bsd-3-clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ],
    "cc-by-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "reserved": ["All rights reserved."],
}
# What tells a family from its relatives: a paragraph has the first pattern and not the second. Names, versions and modifiers
# are a word or two among many, which neither a share of words nor a probability weighs as heavily as a reader does.
_OTHER_VERSION = r"\b(version|v\.?|licen[sc]e|public license,?|international|by|attribution)[ -]?(0|1|2|3)(\.\d+)?\b"
MARKS = {
    "apache-2.0": (r"\bapache licen[sc]e\b.{0,12}\b2(\.0)?\b(?!\.\d)", r"\bversion 1\b|\blicen[sc]e,? (v|version )?1\.\d"),
    "bsd-3-clause": (
        r"\bbsd\b.{0,12}\b(3|three)[ -]clause\b|\b(3|three)[ -]clause bsd\b|redistribution and use in source and binary forms",
        r"\b(0|1|2|4|zero|one|two|four)[ -]clause\b",
    ),
    "cc-by-4.0": (
        r"\bcc[ -]by\b.{0,4}\b4\.0\b|\bcreative commons attribution\b.{0,4}\b4\.0\b",
        rf"non-?commercial|\bby-nc|share-?alike|\bby-sa|no-?deriv|\bby-nd|{_OTHER_VERSION}",
    ),
    "cc-by-nc-4.0": (
        r"\bcc[ -]by-nc\b.{0,4}\b4\.0\b|\bcreative commons attribution[ -]non-?commercial\b.{0,4}\b4\.0\b",
        rf"share-?alike|\bnc-sa|no-?deriv|\bnc-nd|{_OTHER_VERSION}",
    ),
    "gpl-3.0": (
        r"\bgnu general public licen[sc]e\b.{0,12}\b(version |v)?3\b|free software: you can redistribute",
        r"\blesser\b|\blibrary general\b|\baffero\b|\bl?gpl-?v?2|\bversion [12]\b|free software; you can",
    ),
    "mit": (r"\bmit licen[sc]e\b|permission is hereby granted, free of charge, to any person obtaining", r"\bmit-0\b|no attribution"),
    "mpl-2.0": (r"\bmozilla public licen[sc]e\b.{0,12}\b2\.0\b", r"\b(version|v\.?) ?1(\.\d)?\b"),
    "reserved": (r"\ball rights reserved\b", r"\bsome rights reserved\b|\bno rights reserved\b"),
}
UNKNOWN = "unknown"
CONFIRMED = 0.8  # share of a template's words that a paragraph must have
SAMPLE = 600  # paragraphs of the corpus that the classifier learns from, by smallest hash; a bound for any corpus
FEATURES = 1 << 15
HOLDOUT = 3  # one labelled row in so many sets the thresholds


def _tokens(text: Column) -> Column:
    """Lower-case words without marks around them."""
    cleaned = F.transform(words(F.lower(text)), lambda w: F.regexp_replace(w, r"^[^\w]+|[^\w]+$", ""))
    return F.filter(cleaned, lambda w: w != "")


def _plain(text: str) -> list[str]:
    import re

    return [w for w in (re.sub(r"^\W+|\W+$", "", x) for x in text.lower().split()) if w]


def anchors() -> list[str]:
    """Words of which any text that holds ``CONFIRMED`` of a template's words has one.

    A template's rarest fifth and one more would do for one template; taken are, for each, its longest words.
    """
    found = set()
    for texts in TEMPLATES.values():
        for text in texts:
            own = sorted(set(_plain(text)), key=lambda w: (-len(w), w))
            found.update(own[: len(own) - -(-8 * len(own) // 10) + 1])
    # A word that contains another anchor is found with it.
    return sorted(w for w in found if not any(v != w and v in w for v in found))


def _has_anchor(text: Column) -> Column:
    low = F.lower(text)
    found = F.lit(False)
    for word in anchors():
        found = found | F.contains(low, F.lit(word))
    return found


def _labelled(paragraphs: DataFrame) -> DataFrame:
    """label, text, part: notices in and out of surroundings, and paragraphs without a notice.

    Every sampled paragraph gives itself, two of its stretches with the words of notices thrown among them (both
    unknown), and one positive row for each notice: alone, before, behind or between words of the paragraph, or with a
    word missing, as its hash has it.
    """
    plain = paragraphs.filter(~_has_anchor(F.col("line")))
    sample = plain.select("line").distinct().orderBy(F.xxhash64("line"), "line").limit(SAMPLE)
    sample = materialize(sample.select("line", words(F.col("line")).alias("w")), "licence-sample")
    notices = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(label).alias("label"), F.lit(text).alias("text"))
        for i, (label, text) in enumerate((k, t) for k, texts in TEMPLATES.items() for t in texts)
    ])
    each = sample.select("line", "w", F.explode(notices).alias("n")).select("line", "w", "n.*")
    draw = F.pmod(F.xxhash64("line", "i"), F.lit(1000))
    own = words(F.col("text"))
    lost = (draw % F.size(own)).cast("int")
    fewer = F.array_join(F.filter(own, lambda w, k: k != lost), " ")
    some = F.array_join(F.slice("w", 1, 8), " ")
    more = F.array_join(F.slice("w", 9, 6), " ")
    variants = F.when(draw < 300, F.col("text")).when(draw < 450, F.concat_ws(" ", some, "text")).when(
        draw < 600, F.concat_ws(" ", "text", some)
    ).when(draw < 750, F.concat_ws(" ", some, "text", more)).otherwise(F.when(F.size(own) > 5, fewer).otherwise(F.col("text")))
    positives = each.select("label", variants.alias("text"), draw.alias("draw"))
    thrown = each.filter("i % 4 = 0").select(
        F.lit(UNKNOWN).alias("label"), draw.alias("draw"),
        F.concat_ws(" ", some, F.element_at(own, (draw % F.size(own)).cast("int") + 1), more).alias("text"),
    )
    itself = sample.select(F.lit(UNKNOWN).alias("label"), F.col("line").alias("text"), F.pmod(F.xxhash64("line"), F.lit(1000)).alias("draw"))
    rows = positives.unionByName(thrown).unionByName(itself)
    return materialize(rows.select("label", "text", (F.pmod(F.xxhash64("text", "draw"), F.lit(HOLDOUT)) == 0).alias("held")), "licence-labels")


def _features(rows: DataFrame) -> DataFrame:
    tokens = rows.withColumn("tokens", _tokens(F.col("text")))
    pairs = NGram(n=2, inputCol="tokens", outputCol="pairs").transform(tokens)
    grams = pairs.withColumn("grams", F.concat("tokens", "pairs"))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features").transform(grams)


def train(paragraphs: DataFrame) -> tuple[LogisticRegressionModel, dict[str, float], list[str]]:
    """(model, probability from which each family counts as known, families in the model's order).

    The thresholds are calibrated on held-out rows: a family's lies above every probability that it gives to a row of
    another label which the comparison with the templates would let pass, and is one half at least.
    """
    names = sorted([UNKNOWN, *TEMPLATES])
    index = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(float(i)))])
    rows = _features(_labelled(paragraphs)).withColumn("y", F.element_at(index, F.col("label")))
    fit = LogisticRegression(
        labelCol="y", featuresCol="features", family="multinomial", regParam=1e-4, elasticNetParam=0.5, maxIter=60
    )
    known = rows.filter("not held").select("y", "features")
    if known.isEmpty():
        return None, {}, names
    model = fit.fit(known)
    held = _predicted(model, rows.filter("held"), names)
    passed = _confirmed(F.col("family"), F.col("tokens"), F.col("text")) >= CONFIRMED
    wrong = held.filter(F.col("family") != F.col("label")).filter(passed).groupBy("family").agg(F.max("probability").alias("p")).collect()  # one per family
    above = {r["family"]: float(r["p"]) for r in wrong}
    return model, {n: max(0.5, above.get(n, 0.0) + 1e-6) for n in names}, names


def _predicted(model: LogisticRegressionModel, rows: DataFrame, names: Sequence[str]) -> DataFrame:
    scored = model.transform(rows)
    families = F.array(*map(F.lit, names[: model.numClasses]))
    best = F.get(families, F.col("prediction").cast("int"))
    found = scored.withColumn("p", vector_to_array("probability"))
    return found.withColumn("family", best).withColumn("probability", F.array_max("p")).drop("p", "rawPrediction", "prediction")


def _confirmed(family: Column, tokens: Column, text: Column) -> Column:
    """The largest share of the words of a template of the family that the paragraph has; 0 without the family's marks."""
    share, plain = F.lit(0.0), F.lower(F.regexp_replace(text, SPACES, " "))
    marked = F.lit(False)
    for name, (own, foreign) in MARKS.items():
        marked = marked | ((family == name) & plain.rlike(own) & ~plain.rlike(foreign))
    for name, texts in TEMPLATES.items():
        for text in texts:
            own = sorted(set(_plain(text)))
            common = F.size(F.array_intersect(tokens, F.array(*map(F.lit, own)))) / len(own)
            share = F.greatest(share, F.when(family == name, common).otherwise(0.0))
    return F.when(marked, share).otherwise(0.0)


#: Words of a stretch of lines, at least, unless its block of lines ends before: twice those of the longest template.
STRETCH = 2 * max(len(_plain(text)) for texts in TEMPLATES.values() for text in texts)


def _stretches(lines: Column, found: Column) -> Column:
    """Array of (first, last, text): from each line on, the lines up to ``STRETCH`` words or a blank one, joined by blanks.

    A hard-wrapped notice lies in the stretch from its first line on, which has no more words behind it than a notice has.
    ``found`` tells which lines hold an anchor; stretches without one, and those of a single line, are left out.
    """
    begin = F.struct(F.lit("").alias("text"), F.lit(0).alias("n"), F.lit(0).alias("words"), F.lit(True).alias("open"))

    def add(state: Column, line: Column) -> Column:
        more = state["open"] & line.rlike(SPACE.replace("[", "[^"))
        total = state["words"] + F.size(words(line))
        longer = F.struct(
            F.concat_ws(" ", F.when(state["n"] > 0, state["text"]), line).alias("text"), (state["n"] + 1).alias("n"),
            total.alias("words"), (total < STRETCH).alias("open"),
        )
        closed = F.struct(state["text"].alias("text"), state["n"].alias("n"), state["words"].alias("words"), F.lit(False).alias("open"))
        return F.when(more, longer).otherwise(closed)

    def stretch(i: Column) -> Column:
        near = F.exists(F.slice(found, i + 1, STRETCH), lambda x: x)
        joined = F.aggregate(F.slice(lines, i + 1, STRETCH), begin, add)
        return F.when(near, F.transform(F.array(joined), lambda s: F.struct(i.alias("first"), (i + s["n"] - 1).alias("last"), s["text"].alias("text")))[0])

    every = F.transform(F.sequence(F.lit(0), F.size(lines) - 1), stretch)
    return F.filter(every, lambda s: s.isNotNull() & (s["last"] > s["first"]) & _has_anchor(s["text"]))


def _apart(verdicts: DataFrame) -> DataFrame:
    """Verdicts on lines, and of those on stretches the first of each overlapping few that hold no such line."""
    own = W.partitionBy("row", "family").orderBy("first", F.desc("last"))
    line = F.when(F.col("first") == F.col("last"), F.col("first"))
    here = F.min(line).over(own.rowsBetween(0, W.unboundedFollowing))
    marked = verdicts.select("*", line.isNotNull().alias("line"), here.alias("next_line"))
    marked = marked.filter("line or next_line is null or next_line > last")
    before = F.max(F.when(~F.col("line"), F.col("last"))).over(own.rowsBetween(W.unboundedPreceding, -1))
    return marked.select("*", before.alias("before")).filter("line or before is null or before < first")


def licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_paragraphs, n_candidates, n_licences, licence, families, probability.

    Paragraphs are lines with a word. Candidates hold an anchor, a word without which no template can be confirmed; the
    others can only be unknown and are not scored. Notices that are wrapped over lines are found in stretches of lines that
    follow each other, scored besides the single lines; a stretch counts where none of its lines is a licence of the same
    family, and once where several overlap. n_candidates counts lines. A candidate is a licence if the classifier's best family reaches its
    threshold and the paragraph has ``CONFIRMED`` of the words of one of the family's templates and its ``MARKS``: the name,
    version and modifiers of the family and of none of its relatives. licence is the family of
    the most probable one, the first of equals, or null; families lists all, sorted.

    Null, empty and blank texts have no paragraphs. Rows that repeat are scanned each. A corpus without paragraphs trains no
    classifier and has no licences. An empty table gives no rows; other columns are ignored.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    split = slim.select("id", F.split(F.coalesce("text", F.lit("")), "\n").alias("lines"))
    split = split.select("id", "lines", F.transform("lines", _has_anchor).alias("found"))
    some = F.when(F.array_contains("found", True), _stretches(F.col("lines"), F.col("found")))
    single = F.transform("lines", lambda x, i: F.struct(i.alias("first"), i.alias("last"), x.alias("text")))
    found = split.select(
        "id", F.size(F.filter("lines", lambda x: x.rlike(SPACE.replace("[", "[^")))).cast("long").alias("n_paragraphs"),
        F.filter(single, lambda s: F.get("found", s["first"])).alias("candidates"), some.alias("stretches"),
    )
    found = found.select("*", F.monotonically_increasing_id().alias("row"))
    found = materialize(found, "licence-candidates")
    paragraphs = slim.select(F.explode(F.split("text", "\n")).alias("line")).filter(F.col("line").rlike(SPACE.replace("[", "[^")))
    model, thresholds, names = train(paragraphs)
    both = F.concat("candidates", F.coalesce("stretches", F.array().cast("array<struct<first:int,last:int,text:string>>")))
    candidates = found.select("row", F.explode(both).alias("c")).select("row", "c.*")
    if model is None:
        verdicts = candidates.select("row", "first", "last", F.lit(0.0).alias("probability"), F.lit(None).cast("string").alias("family")).limit(0)
    else:
        scored = _predicted(model, _features(candidates), names)
        least = F.element_at(F.create_map(*[x for n in names for x in (F.lit(n), F.lit(thresholds[n]))]), F.col("family"))
        sure = (F.col("family") != UNKNOWN) & (F.col("probability") >= least)
        verdicts = scored.filter(sure & (_confirmed(F.col("family"), F.col("tokens"), F.col("text")) >= CONFIRMED)).select(
            "row", "first", "last", "probability", "family"
        )
    per = _apart(verdicts).groupBy("row").agg(
        F.count("*").alias("n_licences"), F.sort_array(F.collect_set("family")).alias("families"),
        F.max_by("family", F.struct("probability", -F.col("first"))).alias("licence"), F.max("probability").alias("probability"),
    )
    joined = found.join(per.withColumnRenamed("row", "of"), F.col("row") == F.col("of"), "left")
    return joined.select(
        F.col("id").alias("doc_id"), "n_paragraphs", F.size("candidates").cast("long").alias("n_candidates"),
        F.coalesce("n_licences", F.lit(0)).alias("n_licences"), "licence",
        F.coalesce("families", F.array().cast("array<string>")).alias("families"), "probability",
    )

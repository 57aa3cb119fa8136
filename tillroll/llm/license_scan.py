"""Operator 8: license scans by diagonal voting, with DataFrame functions only.

The rolling hashes of K consecutive words of every whole text are joined with those of the templates. A hit votes for the
diagonal text position - template position; votes are counted per document, template and diagonal. Neighbouring diagonals
(up to GAP apart, as after inserted or missing words) are merged in the order of the diagonals, whatever other diagonals
a repeated phrase of the template votes for, and the span of each merged group is verified: the
words that hits cover must make up MIN_TEMPLATE of the template and MIN_SPAN of the span. Beside the templates' labels the
base phrases are counted where their words stand consecutively.

Templates are a parameter of bounded size (TEMPLATES_BYTES), so their hashes are broadcast. Hits are counted by partial
aggregation; what is grouped later are a document's diagonals for one template.

Defined results: words are lower-cased as in common.WORD_CLASS; a null or empty text has no words, counts 0, null positions, empty labels
and score 0; rows of equal doc_id and text share their hits and each have a row; an empty table gives an empty result;
other columns are ignored. Score: the best verified share of a template, or 0.5 if only base phrases were found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

K, GAP, MIN_TEMPLATE, MIN_SPAN = 4, 3, 0.7, 0.6
TEMPLATES_BYTES = 1 << 20
#: The base phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Notices as their licenses prescribe or suggest them, and common short forms, by label.
TEMPLATES = (
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
     "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
     "persons to whom the Software is furnished to do so"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
     "later version."),
    ("gpl-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("bsd-text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met"),
    ("isc-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("mit-notice", "Released under the MIT License."),
    ("cc-by-notice", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
)

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text. Full lower case differs from that of A-Z only in words with other letters, none of which is in
    a phrase."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _SEPARATORS), lambda w: w != "")


def rolling_hashes(word_hashes: Column) -> Column:
    """The hash of K consecutive words from each position on; K is a power of two."""
    out, width = word_hashes, 1
    while width < K:
        shifted = F.slice(out, F.lit(width + 1), F.greatest(F.size(out) - width, F.lit(0)))
        kept = F.slice(out, F.lit(1), F.greatest(F.size(out) - width, F.lit(0)))
        out, width = F.zip_with(kept, shifted, lambda a, b: F.xxhash64(a, b)), 2 * width
    return out


def template_hashes(spark, templates=TEMPLATES) -> DataFrame:
    """template, label, template_words, hash, template_at."""
    if sum(len(t) for _, t in templates) > TEMPLATES_BYTES:
        raise ValueError(f"templates are limited to {TEMPLATES_BYTES} characters: their hashes are broadcast")
    rows = spark.createDataFrame([(i, label, text) for i, (label, text) in enumerate(templates)], "template int, label string, text string")
    rows = rows.withColumn("words", words(F.col("text")))
    hashed = rows.select("template", "label", F.size("words").alias("template_words"),
                         F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    return hashed.select("template", "label", "template_words",
                         F.posexplode(rolling_hashes(F.col("h"))).alias("template_at", "hash"))


def _base(columns: DataFrame) -> DataFrame:
    """Adds n_words, n_base, first_word, last_word and the base labels to rows with `words`. Every word gets a space on either
    side, so that neighbouring phrases share none and positions are counts of spaces."""
    line = F.concat(F.lit(" "), F.array_join("words", "  "), F.lit(" "))
    rows = columns.withColumn("n_words", F.size("words").cast("long")).withColumn("line", line)
    counts, firsts, lasts, labels = [], [], [], []

    def before(part: Column) -> Column:
        return F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))

    for phrase, label in PHRASES.items():
        size = len(phrase.split())
        spaced = "".join(f" {w} " for w in phrase.split())
        here = F.contains("line", F.lit(spaced))
        counts.append(F.when(here, (F.length("line") - F.length(F.replace("line", F.lit(spaced), F.lit("")))) / len(spaced)).otherwise(0))
        firsts.append(F.when(here, before(F.substring_index("line", spaced, 1)) / 2))
        lasts.append(F.when(here, F.col("n_words") - before(F.substring_index("line", spaced, -1)) / 2 - size))
        labels.append(F.when(here, F.lit(label)))
    total = counts[0] + counts[1] + counts[2] + counts[3]
    return rows.withColumns({
        "n_base": F.round(total).cast("long"), "first_word": F.least(*firsts).cast("long"),
        "last_word": F.greatest(*lasts).cast("long"), "base": F.array_compact(F.array(*labels))}).drop("line")


def spans(documents: DataFrame, templates=TEMPLATES) -> DataFrame:
    """Verified spans: doc_id, tie (hash of the text), template, label, first_word, end_word, covered (words that hits cover) and share of the
    template."""
    rows = C.text_rows(documents, "doc_id", "text").select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"), words(F.col("text")).alias("words"))
    hashed = rows.select("doc_id", "tie", F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    grams = hashed.select("doc_id", "tie", F.posexplode(rolling_hashes(F.col("h"))).alias("at", "hash"))
    known = F.broadcast(template_hashes(documents.sparkSession, templates))
    hits = grams.join(known, "hash").withColumn("diagonal", F.col("at") - F.col("template_at"))
    key = ["doc_id", "tie", "template"]
    votes = hits.groupBy(*key, "diagonal").agg(
        F.first("label").alias("label"), F.first("template_words").alias("template_words"),
        F.min("at").alias("low"), F.max("at").alias("high"), F.collect_set("at").alias("ats"))
    # diagonals in order: each is merged with the next one if that is up to GAP away, however many follow each other so
    order = Window.partitionBy(*key).orderBy("diagonal")
    apart = F.when(F.col("diagonal") - F.lag("diagonal").over(order) <= GAP, 0).otherwise(1)
    votes = votes.withColumn("apart", apart).withColumn("near", F.sum("apart").over(order))
    # of merged diagonals, those whose hits follow each other within the template's length are one span
    place = Window.partitionBy(*key, "near").orderBy("low", "diagonal")
    reach = F.max(F.col("high")).over(place.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("low") - reach <= F.col("template_words"), 0).otherwise(1)
    merged = votes.withColumn("fresh", fresh).withColumn("band", F.sum("fresh").over(place)).groupBy(*key, "near", "band").agg(
        F.first("label").alias("label"), F.first("template_words").alias("template_words"), F.min("low").alias("low"),
        F.max("high").alias("high"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("ats"))
    # covered words: each hit covers K words, or as many as are left until the next hit
    covered = F.aggregate("ats", F.struct(F.lit(0).alias("n"), F.lit(-K).alias("at")), lambda st, at: F.struct(
        (st["n"] + F.least(F.lit(K), at - st["at"])).alias("n"), at.alias("at")), lambda st: st["n"])
    checked = merged.withColumn("covered", covered).withColumn("end", F.col("high") + K)
    checked = checked.where((F.col("covered") >= F.col("template_words") * MIN_TEMPLATE)
                            & (F.col("covered") >= (F.col("end") - F.col("low")) * MIN_SPAN))
    return checked.select(*key, "label", F.col("low").cast("long").alias("first_word"), F.col("end").cast("long").alias("end_word"),
                          "covered", F.least(F.lit(1.0), F.col("covered") / F.col("template_words")).alias("share"))


def scanned(documents: DataFrame, templates=TEMPLATES) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score."""
    found = spans(documents, templates).groupBy("doc_id", "tie").agg(
        F.collect_set("label").alias("own"), F.max("share").alias("share"))
    found = C.written(found, "license-spans")
    rows = C.text_rows(documents, "doc_id", "text").select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"), words(F.col("text")).alias("words"))
    rows = _base(rows).drop("words")
    both = rows.alias("r").join(found.alias("f"), F.col("r.doc_id").eqNullSafe(F.col("f.doc_id")) & (
        F.col("r.tie") == F.col("f.tie")), "left").select("r.*", "own", "share")
    own = F.coalesce("own", F.array().cast("array<string>"))
    score = F.greatest(F.coalesce("share", F.lit(0.0)), F.when(F.col("n_base") > 0, 0.5).otherwise(0.0))
    return both.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                       F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
                       F.array_join(F.array_sort(F.array_union("base", own)), ",").alias("labels"), score.alias("score"))

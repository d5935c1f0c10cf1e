"""Licence scans by diagonal voting (operator 1).

Texts and licence templates are cut into words (A-Z lower-cased; digits,
letters and everything beyond ASCII).  Every rolling word pair of a text is
hashed and joined to the template positions with the same hash.  A hit votes
for the diagonal ``text position - template position``; votes are gathered per
diagonal as a bit set of matched template positions.  Neighbouring diagonals
(a word was inserted or left out) merge, and a merged span is verified: it must
cover enough of the template's words within a span of plausible length.  Copies
of a short notice that follow one another merge into a span longer than that;
it is judged by the stretch of plausible length that covers most.

Phrases ("mit license") must match whole on one diagonal; every such diagonal
is a place.  Notices are the opening words of common licence texts; their hits
must agree in a third word, so that frequent pairs don't vote.

Rows: a null or wordless text has zero counts, null positions and no labels.
Repeated rows are scanned alike, also under a null id.  Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from usagelens.llm.common import ascii_lower, stage

GAP = 8                 # diagonals this close belong to one span
MIN_COVERAGE = 0.6      # share of a notice's votes that a span must have
MAX_STRETCH = 2         # a span is at most this many times as long as its notice
MAX_VOTES = 60          # votes of a template are bits of one long

# Phrases of the base rule with their labels.
PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))
# Opening words of public licence texts and notices, with their labels.
NOTICES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
               "compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
)
#: every byte of ASCII but letters and digits separates words (after lower-casing)
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def template_words(text: str) -> list[str]:
    return [w for w in re.split(SEPARATORS, re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]


def template_rows() -> list[tuple]:
    """(template, label, phrase?, votes, words, position, three words) for every word pair of every template."""
    rows = []
    for n, (label, text, phrase) in enumerate([(*p, True) for p in PHRASES] + [(*p, False) for p in NOTICES]):
        w = template_words(text)
        votes = len(w) - (1 if phrase else 2)
        if votes > MAX_VOTES:
            raise ValueError(f"template too long: {text}")
        rows += [(n, label, phrase, votes, len(w), k, w[k], w[k + 1], None if phrase else w[k + 2]) for k in range(votes)]
    return rows


def templates(spark: SparkSession) -> DataFrame:
    """The templates' word pairs as an inline relation: at most ``MAX_VOTES`` rows a template, whatever the corpus."""
    lit = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x)
    rows = ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in template_rows())
    return spark.sql("SELECT * FROM VALUES " + rows + " AS t(template, label, phrase, votes, n_template, tpos, t1, t2, t3)") \
        .withColumn("gram", F.xxhash64("t1", "t2"))


def licence_words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("tag"),
                       licence_words(F.col("text")).alias("words"))


def votes(docs: DataFrame) -> DataFrame:
    """One row per document, template and diagonal: matched template positions as bits, first and last hit."""
    # the outer form: the plain one would have the words cut twice, once to test for emptiness
    at = _keyed(docs).select("doc_id", "tag", "words", F.posexplode_outer("words").alias("p", "w1"))
    hits = at.select("doc_id", "tag", "words", "p", "w1", F.get("words", F.col("p") + 1).alias("w2")).where("w2 is not null")
    t = F.broadcast(templates(docs.sparkSession))        # fixed values of this module, a few hundred short rows
    joined = hits.join(t, (F.xxhash64("w1", "w2") == t.gram) & (F.col("w1") == t.t1) & (F.col("w2") == t.t2)
                       & (t.t3.isNull() | (F.get("words", F.col("p") + 2) == t.t3)))
    return joined.groupBy("doc_id", "tag", "template", "label", "phrase", "votes", "n_template",
                          (F.col("p") - F.col("tpos")).alias("diagonal")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, tpos)")).alias("bits"), F.min("p").alias("first"), F.max("p").alias("last"))


def _stretches(diagonals: Column, longest: Column, n_template: Column) -> Column:
    """For every diagonal of a span, in order of its first hit: template positions matched from there on within ``longest`` words.

    Hits within ``longest`` words lie on fewer than ``longest + n_template`` diagonals, so no more are looked at.
    """
    def stretch(x, i):
        within = F.filter(F.slice(diagonals, i + 1, longest + n_template), lambda y: y["last"] - x["first"] + 1 <= longest)
        bits = F.aggregate(within, F.lit(0).cast("long"), lambda a, y: a.bitwiseOR(y["bits"]))
        return F.struct(F.bit_count(bits).alias("n"), (-x["first"]).alias("from"), F.array_max(F.transform(within, lambda y: y["last"])).alias("to"))
    return F.transform(diagonals, stretch)


def spans(docs: DataFrame) -> DataFrame:
    """Verified places, one per template and run of neighbouring diagonals: doc_id, tag, label, phrase, first_word, last_word (of the span), coverage."""
    # staged, as phrases and notices both read it: the words of the corpus are cut once for both
    v = stage(votes(docs), "licence_votes").withColumn("n", F.bit_count("bits"))
    places = v.where("phrase and n = votes").select(
        "doc_id", "tag", "label", "phrase", F.col("diagonal").cast("long").alias("first_word"),
        (F.col("diagonal") + F.col("n_template") - 1).cast("long").alias("last_word"), F.lit(1.0).alias("coverage"))
    own = Window.partitionBy("doc_id", "tag", "template").orderBy("diagonal")
    near = v.where("not phrase and (n > 1 or votes < 3)") \
        .withColumn("new", F.coalesce((F.col("diagonal") - F.lag("diagonal").over(own) > GAP).cast("int"), F.lit(1))) \
        .withColumn("span", F.sum("new").over(own))
    merged = near.groupBy("doc_id", "tag", "template", "label", "votes", "n_template", "span") \
        .agg(F.bit_or("bits").alias("bits"), F.min("first").alias("first"), (F.max("last") + 2).alias("last"),
             F.array_sort(F.collect_list(F.struct("first", (F.col("last") + 2).alias("last"), "bits"))).alias("diagonals")) \
        .where(F.bit_count("bits") / F.col("votes") >= MIN_COVERAGE)
    longest = F.col("n_template") * MAX_STRETCH
    whole = F.struct(F.bit_count("bits").alias("n"), (-F.col("first")).alias("from"), F.col("last").alias("to"))
    best = F.when(F.col("last") - F.col("first") + 1 <= longest, whole).otherwise(F.array_max(_stretches(F.col("diagonals"), longest, F.col("n_template"))))
    notices = merged.select("doc_id", "tag", "label", "votes", best.alias("best")).where(F.col("best.n") / F.col("votes") >= MIN_COVERAGE) \
        .select("doc_id", "tag", "label", F.lit(False).alias("phrase"), (-F.col("best.from")).cast("long").alias("first_word"),
                F.col("best.to").cast("long").alias("last_word"), (F.col("best.n") / F.col("votes")).alias("coverage"))
    return places.unionAll(notices)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    base = F.col("phrase")
    joined = lambda c: F.concat_ws(",", F.array_sort(F.collect_set(c)))
    found = spans(docs).groupBy("doc_id", "tag").agg(
        F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("first_word"))).alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).alias("last_word"), joined(F.when(base, F.col("label"))).alias("base_labels"),
        joined(F.col("label")).alias("labels"), F.max("coverage").alias("score")) \
        .withColumnsRenamed({"doc_id": "id_", "tag": "tag_"})
    rows = _keyed(docs).select("doc_id", "tag", F.size("words").cast("long").alias("n_words"))
    none = lambda c, v: F.coalesce(F.col(c), F.lit(v)).alias(c)
    return rows.join(found, rows.doc_id.eqNullSafe(found.id_) & (rows.tag == found.tag_), "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        none("base_labels", ""), none("labels", ""), none("score", 0.0))

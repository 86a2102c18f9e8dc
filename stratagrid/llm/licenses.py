"""License scan by diagonal voting.  DataFrame functions only.

Every rolling word k-gram of every text is joined to the positions of the same k-gram in the license
templates.  A match at word ``w`` of the text and ``t`` of the template votes for the diagonal
``w - t``; votes are counted per diagonal, neighbouring diagonals are merged, and spans are verified.

The k-gram's words are compared besides its hash, so each vote is exact, and the verification of
a span needs no second look at the text.  The template side holds the k-grams of the templates that the
caller passes, a size fixed by that list and not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K = 3
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Phrases that give a label wherever their words stand consecutively.
BASE_PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
#: Longer passages of well-known public licenses, which may be matched with gaps and changes.
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in "
     "compliance with the license", "apache-2"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu "
     "general public license", "gpl"),
    ("licensed under the gnu general public license", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted "
     "provided that the following conditions are met", "bsd"),
    ("this work is licensed under a creative commons attribution noncommercial", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution sharealike", "cc-by-sa"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("all rights reserved no part of this publication may be reproduced", "all-rights-reserved"),
)


def words(text: Column) -> Column:
    """Lower-cased (A-Z only) runs of ASCII letters, digits and characters beyond ASCII."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, NOT_WORD), "")


def _template_grams(spark: SparkSession, base: tuple, templates: tuple) -> DataFrame:
    rows = []
    for n, (phrase, label) in enumerate((*base, *templates)):
        split = phrase.split(" ")
        if len(split) < K:
            raise ValueError(f"a phrase needs at least {K} words: {phrase}")
        rows += [(n, label, n < len(base), len(split), t, *split[t:t + K]) for t in range(len(split) - K + 1)]
    named = spark.createDataFrame(rows, "template int, label string, base boolean, n int, t int, " + ", ".join(
        f"t{j} string" for j in range(K)))
    return named.withColumn("gram", F.xxhash64(*[f"t{j}" for j in range(K)]))


def license_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", base: tuple = BASE_PHRASES,
                  templates: tuple = TEMPLATES, min_coverage: float = 0.6, drift: int = 2) -> DataFrame:
    """One row per input row: ``doc_id, n_words, spans, best``.

    ``spans`` lists what was found, in order of ``first_word``: structs of ``first_word`` and ``last_word`` (words
    from 0), ``label``, ``phrase`` (number among ``base`` and then ``templates``), ``base``, ``diagonal`` (word of
    the text less word of the phrase, the least of a span) and ``coverage`` (share of the phrase's words).
    A base phrase is found where all its words stand in a row, a template where one span covers at
    least ``min_coverage`` of it; diagonals at most ``drift`` words apart count as one span.  ``best`` is
    the best coverage of any phrase, found or not, 0 to 1.  A null text counts as empty; repeated rows and
    null ids each keep their own row; other columns are ignored; an empty table gives an empty result.
    """
    w = F.col("w")
    shifted = [F.slice(w, j + 1, F.size(w)).alias(f"w{j}") if j else w.alias("w0") for j in range(K)]
    # zipped to the longest: the last elements are no whole k-gram, and one more closes the document
    grams = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"),
        words(F.col(text)).alias("w"),
    ).select("row", "doc_id", F.size("w").alias("n_words"), F.posexplode(
        F.arrays_zip(F.concat(w, F.array(F.lit(None).cast("string"))).alias("w0"), *shifted[1:]))
    ).select("row", "doc_id", "n_words", "pos", *[F.col(f"col.w{j}").alias(f"w{j}") for j in range(K)]
             ).withColumn("gram", F.xxhash64(*[f"w{j}" for j in range(K)]))
    table = F.broadcast(_template_grams(docs.sparkSession, base, templates))  # as large as the caller's list
    same = " and ".join(f"w{j} = t{j}" for j in range(K))
    votes = grams.join(table, "gram", "left").filter(f"pos = n_words or (template is not null and {same})")
    # count by diagonal; the closing element of each document votes for none and keeps its row
    diagonals = votes.groupBy("row", "doc_id", "n_words", "template", "label", "base", "n", (
        F.col("pos") - F.col("t")).alias("diagonal")).agg(
        F.sort_array(F.collect_list("t")).alias("places"), F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    near = Window.partitionBy("row", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(near)
    spans = diagonals.withColumn("new", F.when(F.col("base") | gap.isNull() | (gap > drift), 1).otherwise(0))
    spans = spans.withColumn("span", F.sum("new").over(near)).groupBy(
        "row", "doc_id", "n_words", "template", "label", "base", "n", "span"
    ).agg(F.min("diagonal").alias("start"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.array_sort(
        F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"))
    # verify: the template's words under the span's k-grams; a base phrase needs all of them in a row
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        "places", lambda t: F.sequence(t, t + F.lit(K - 1))))))
    checked = spans.withColumn("coverage", F.when(F.col("template").isNotNull(), covered / F.col("n")))
    whole = F.col("base") & (F.size("places") == F.col("n") - F.lit(K - 1))
    found = whole | (~F.col("base") & (F.col("coverage") >= min_coverage))
    span = F.struct(
        F.col("lo").cast("long").alias("first_word"), (F.col("hi") + (K - 1)).cast("long").alias("last_word"), "label",
        F.col("template").alias("phrase"), "base", F.col("start").cast("long").alias("diagonal"), "coverage")
    return checked.groupBy("row", "doc_id", "n_words").agg(
        F.array_sort(F.collect_list(F.when(found, span))).alias("spans"),
        F.coalesce(F.max("coverage"), F.lit(0.0)).alias("best"),
    ).select("doc_id", F.col("n_words").cast("long").alias("n_words"), "spans", "best")


def scan_licenses(docs: DataFrame, **options) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    A digest of ``license_spans``, whose options it takes: ``n_base`` counts the places of base phrases and
    ``first_word`` / ``last_word`` are the smallest and largest word at which one starts (null without any).
    ``labels`` adds the labels of the templates found; ``score`` is ``best``.
    """
    based = F.filter("spans", lambda s: s.base)
    starts = F.transform(based, lambda s: s.first_word)
    listed = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s.label))), ",")
    return license_spans(docs, **options).select(
        "doc_id", "n_words", F.size(based).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), listed(based).alias("base_labels"),
        listed(F.col("spans")).alias("labels"), F.col("best").alias("score"))

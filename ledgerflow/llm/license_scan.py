"""License scan by diagonal voting over word bigrams (DataFrame operations only).

Templates (short license phrases and longer statements) are indexed by the
hash of every word bigram and its position.  Every rolling bigram of every
text is joined with that index; a hit votes for a diagonal, the document
position minus the template position.

- A base phrase or a short statement stands where one diagonal collects all
  its bigrams, which are then consecutive words: exact places.
- For longer statements, neighbouring diagonals (up to ``DRIFT`` words apart, so
  inserted or dropped words do not split a license text) are merged into a
  band, and its best window is verified: of all stretches of the text not much
  longer than the template, the one with the largest share of distinct
  template bigrams.  A band may run on for as long as it likes.

Words are ASCII lower-cased runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``.

Scale: bigrams are hashed inside the row and only their hashes are
exploded, next to one marker per document that keeps documents without
hits in the result, so a text is read once and never shuffled.  The
templates are a list given by the caller; it is broadcast behind a check
of its size and joined by shuffle beyond it.

Defined results: a null or blank text has no words, no places, empty
labels and score 0.  A null id is kept.  Rows that agree in id and text are
scanned once and give a row each.  Texts of any length are scanned whole.
Other columns are ignored.  An empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import alnum_words, text_or_empty

# Phrases counted by exact place, with their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Statements found with tolerance, with their labels.
STATEMENTS = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("the software is provided as is without warranty of any kind express or implied", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("unless required by applicable law or agreed to in writing software distributed under the license", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu", "gpl"),
    ("licensed under the gnu general public license version 3", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("licensed under a creative commons attribution", "cc-by"),
    ("licensed under cc by nc", "cc-by-nc"),
    ("licensed under cc by sa", "cc-by-sa"),
    ("licensed under cc by nd", "cc-by-nd"),
    ("all rights reserved", "all-rights-reserved"),
)
DRIFT = 3           # of a diagonal, and words a window may have beyond STRETCH
COVERAGE = 0.75
WHOLE_BELOW = 8   # statements of fewer bigrams must be found whole, in one place
STRETCH = 1.5
BROADCAST_GRAMS = 100_000
MARKER = -1   # template number of the marker gram


def _template_grams(spark: SparkSession, base, statements) -> DataFrame:
    rows = [(i, text, label, i < len(base)) for i, (text, label) in enumerate((*base, *statements))]
    templates = spark.createDataFrame(rows, "template int, text string, label string, base boolean")
    words = templates.select("template", "label", "base", alnum_words(F.col("text")).alias("w"))
    n_grams = F.size("w") - 1
    exact = F.col("base") | (n_grams < WHOLE_BELOW)
    grams = words.select("template", "label", "base", exact.alias("exact"), n_grams.alias("n_grams"), F.posexplode(
        F.transform(F.sequence(F.lit(0), F.size("w") - 2), lambda i: F.xxhash64(
            F.get("w", i), F.get("w", i + 1)))).alias("gram_at", "gram"))
    # At one place of a text so many bigrams of a template can stand.
    often = grams.groupBy("template", "gram").count().groupBy("template").agg(
        F.max("count").cast("int").alias("most"))
    grams = grams.join(often, "template").select("template", "label", "base", "exact", "n_grams", "most",
                                                 "gram_at", "gram")
    marker = spark.range(1).select(
        F.lit(MARKER).alias("template"), F.lit("").alias("label"), F.lit(False).alias("base"), F.lit(True).alias("exact"),
        F.lit(1).alias("n_grams"), F.lit(1).alias("most"), F.lit(-1).alias("gram_at"), _marker().alias("gram"))
    return marker.unionByName(grams)


def _marker():
    return F.xxhash64(F.lit("marker of a document"))


def _best_window(diagonals: Column, n_grams: Column, most: Column) -> Column:
    """struct(found, shorter, earlier, last) of a band's best window; diagonals are (diagonal, ats)."""
    places = F.array_sort(F.flatten(F.transform(diagonals, lambda v: F.transform(v["ats"], lambda g: F.struct(
        (v["diagonal"] + g).alias("at"), g.alias("gram"))))))
    longest = _longest(n_grams)

    def window(first: Column, i: Column) -> Column:
        held = F.filter(F.slice(places, i + 1, longest * most), lambda p: p["at"] < first["at"] + longest)
        grams = F.array_distinct(F.transform(held, lambda p: p["gram"]))
        found = F.size(grams)
        # The window ends where the last of its bigrams stands for the first time.
        last = F.array_max(F.transform(grams, lambda g: F.array_min(F.transform(
            F.filter(held, lambda p: p["gram"] == g), lambda p: p["at"]))))
        return F.struct(found.alias("found"), (first["at"] - last).alias("shorter"), (-first["at"]).alias("earlier"),
                        last.alias("last"))

    return F.array_max(F.transform(places, window))


def _longest(n_grams: Column) -> Column:
    return (F.ceil(n_grams * F.lit(STRETCH)) + DRIFT).cast("int")


def license_spans(docs: DataFrame, base=BASE, statements=STATEMENTS, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per verified span, and one marker row (template -1) per document.

    (doc_id, text_key, n_words, template, label, base, first_word,
    last_word, coverage, copies); words count from 0.  A marker's copies
    are the rows that agree in id and text.
    """
    grams = _template_grams(docs.sparkSession, base, statements)
    if sum(len(text.split()) for text, _ in (*base, *statements)) <= BROADCAST_GRAMS:
        grams = F.broadcast(grams)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_or_empty(text_col)).alias("text_key"),
                       alnum_words(F.col(text_col)).alias("w"))
    n = F.size("w")
    rolling = F.when(n > 1, F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.xxhash64(
        F.get("w", i), F.get("w", i + 1)))).otherwise(F.array().cast("array<bigint>"))
    exploded = rows.select("doc_id", "text_key", n.cast("bigint").alias("n_words"),
                           F.posexplode(F.array_prepend(rolling, _marker())).alias("at", "gram"))
    hits = (exploded.join(grams, "gram")
            .withColumn("diagonal", F.col("at") - 1 - F.col("gram_at"))
            .repartition("doc_id", "text_key"))
    votes = hits.groupBy("doc_id", "text_key", "n_words", "template", "label", "base", "exact",
                         "n_grams", "most", "diagonal").agg(
        F.collect_set("gram_at").alias("ats"), F.min("at").alias("lo"), F.max("at").alias("hi"),
        F.count("*").alias("votes"))
    # Exact phrases keep one group per diagonal; statements merge neighbours.
    along = Window.partitionBy("doc_id", "text_key", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(along)
    apart = F.col("exact") | gap.isNull() | (gap > DRIFT)
    merged = votes.withColumn("fresh", apart.cast("int")).withColumn("band", F.sum("fresh").over(along))
    spans = merged.groupBy("doc_id", "text_key", "n_words", "template", "label", "base", "exact",
                           "n_grams", "most", "band").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("found"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("votes").alias("copies"),
        F.collect_list(F.when(~F.col("exact"), F.struct("diagonal", "ats"))).alias("diagonals"))
    enough = F.col("found") >= F.col("n_grams") * F.when(F.col("exact"), F.lit(1.0)).otherwise(F.lit(COVERAGE))
    spans = spans.filter(enough).withColumn("w", F.when(~F.col("exact"), _best_window(
        F.col("diagonals"), F.col("n_grams"), F.col("most"))))
    # The first place of a window counts from 0, lo from 1 (the marker stands before the words).
    own = lambda windowed, whole: F.when(F.col("exact"), whole).otherwise(windowed)
    coverage = own(F.col("w.found"), F.col("found")) / F.col("n_grams")
    return spans.filter(F.col("exact") | (coverage >= COVERAGE)).select(
        "doc_id", "text_key", "n_words", "template", "label", "base",
        own(-F.col("w.earlier"), F.col("lo") - 1).cast("bigint").alias("first_word"),
        own(F.col("w.last") + 1, F.col("hi")).cast("bigint").alias("last_word"),
        coverage.alias("coverage"), "copies")


def license_scan(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), one row per document.

    ``score`` is the best coverage of a verified span; a base phrase counts 1.
    """
    spans = license_spans(docs, **options)
    placed = F.col("base")
    named = F.col("template") != MARKER
    joined = lambda labels: F.concat_ws(",", F.array_sort(F.collect_set(labels)))
    return spans.groupBy("doc_id", "text_key", "n_words").agg(
        F.count(F.when(placed, 1)).alias("n_base"),
        F.min(F.when(placed, F.col("first_word"))).alias("first_word"),
        F.max(F.when(placed, F.col("first_word"))).alias("last_word"),
        joined(F.when(placed, F.col("label"))).alias("base_labels"),
        joined(F.when(named, F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.when(named, F.col("coverage"))), F.lit(0.0)).alias("score"),
        F.max(F.when(~named, F.col("copies"))).alias("copies")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy")).drop("copy")

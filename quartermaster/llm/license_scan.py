"""License scans by diagonal voting (DataFrame operations only).

All rolling word 3-grams of a document are hashed and joined to the 3-grams
of license templates. A join hit votes for the diagonal ``document position
- template position``; hits of one copied passage share a diagonal, and
small edits move it a little. Votes are summed per diagonal, diagonals no
more than ``GAP`` apart are merged, and a merged span is verified: enough of
the template's 3-grams (exact words, each counted once) inside a span not
much longer than the template.

The templates are a fixed list, so their 3-grams are broadcast. A document
hits few of them, so what is shuffled is small; grouping is by document, and
no document is ever split or joined with another.

Defined results: null and empty texts have no words, no place and score 0;
repeated rows are each reported; labels are '' if there are none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ALNUM_WORD, KEY, Scratch, doc_key, lower_ascii

GRAM = 3
GAP = 4
MIN_COVER = 0.6
SHORT = 12  # templates of fewer 3-grams differ in one word: all must stand
MAX_STRETCH = 2.0

# The phrases of the contract (every word must stand).
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

# Opening sentences of public licenses, as words.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
            "and associated documentation files the software to deal in the software without restriction"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without "
            "fee is hereby granted"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except "
                 "in compliance with the license"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl-3", "licensed under the gnu affero general public license version 3"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
]


def template_grams(spark: SparkSession) -> DataFrame:
    """``(template, label, is_phrase, n_grams, t_pos, t_gram)``."""
    rows = []
    for k, (label, words) in enumerate(PHRASES + TEMPLATES):
        w = words.split()
        n = len(w) - GRAM + 1
        rows += [(k, label, k < len(PHRASES), n, i, " ".join(w[i:i + GRAM])) for i in range(n)]
    return spark.createDataFrame(rows, "template int, label string, is_phrase boolean, n_grams int, "
                                       "t_pos int, t_gram string")


def _words(text: Column) -> Column:
    """The words, each between single blanks: `` w1 w2 ... ``."""
    return F.concat(F.lit(" "), F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))),
                                                 r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "), F.lit(" "))


def hits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """3-grams that a document and a template share, one row per document
    key, template and pair of positions."""
    # The look-ahead yields the gram that starts at every word, in order.
    grams = F.regexp_extract_all(_words(F.col(text)), F.lit(r"(?<= )(?=([^ ]+ [^ ]+ [^ ]+) )"), F.lit(1))
    rolled = docs.select(*doc_key(doc_id, text), F.posexplode(grams).alias("pos", "gram"))
    wanted = template_grams(docs.sparkSession).withColumn("t_hash", F.xxhash64("t_gram"))
    return (rolled.join(F.broadcast(wanted), (F.xxhash64("gram") == F.col("t_hash"))
                        & (F.col("gram") == F.col("t_gram")))
            .select(*KEY, "template", "label", "is_phrase", "n_grams", "t_pos", "pos").distinct())


def spans(found: DataFrame) -> DataFrame:
    """Verified spans: ``(key, label, is_phrase, first, last, cover)``; first
    and last word position of the span."""
    by_diagonal = (found.withColumn("diagonal", F.col("pos") - F.col("t_pos"))
                   .groupBy(*KEY, "template", "label", "is_phrase", "n_grams", "diagonal")
                   .agg(F.collect_set("t_pos").alias("votes"), F.min("pos").alias("lo"), F.max("pos").alias("hi")))
    places = (by_diagonal.where(F.col("is_phrase") & (F.size("votes") == F.col("n_grams")))
              .select(*KEY, "label", "is_phrase", F.col("diagonal").alias("first"),
                      (F.col("hi") + GRAM - 1).alias("last"), F.lit(1.0).alias("cover")))
    order = Window.partitionBy(*KEY, "template").orderBy("diagonal")
    far = F.col("diagonal") - F.lag("diagonal").over(order) > GAP
    merged = (by_diagonal.where(~F.col("is_phrase"))
              .withColumn("cut", F.coalesce(far, F.lit(True)).cast("int"))
              .withColumn("span", F.sum("cut").over(order))
              .groupBy(*KEY, "label", "is_phrase", "n_grams", "template", "span")
              .agg(F.size(F.array_distinct(F.flatten(F.collect_list("votes")))).alias("n_votes"),
                   F.min("lo").alias("first"), (F.max("hi") + GRAM - 1).alias("last")))
    cover = F.col("n_votes") / F.col("n_grams")
    whole = merged.withColumn("cover", cover).where(
        (F.col("cover") >= F.when(F.col("n_grams") < SHORT, 1.0).otherwise(MIN_COVER))
        & (F.col("last") - F.col("first") + 1 <= MAX_STRETCH * (F.col("n_grams") + GRAM - 1)))
    return places.unionByName(whole.select(*KEY, "label", "is_phrase", "first", "last", "cover"))


def license_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with places, labels and score."""
    scratch = Scratch(docs.sparkSession, "licenses")
    found = scratch.table(spans(scratch.table(hits(docs, doc_id, text), "hits")), "spans")
    base = F.col("is_phrase")
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    per_doc = found.groupBy(*[F.col(c).alias(f"f_{c}") for c in KEY]).agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"), joined(F.col("label")).alias("labels"),
        F.max("cover").alias("score"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), *doc_key(doc_id, text), F.coalesce(
        F.regexp_count(lower_ascii(F.col(text)), F.lit(ALNUM_WORD)), F.lit(0)).cast("long").alias("n_words"))
    return scratch.result(
        rows.join(per_doc, [F.col(c) == F.col(f"f_{c}") for c in KEY], "left")
        .select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
                "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
                F.coalesce("labels", F.lit("")).alias("labels"),
                F.coalesce("score", F.lit(0.0)).alias("score")))

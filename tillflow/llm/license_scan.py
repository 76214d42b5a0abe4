"""License phrases and notices in documents by diagonal voting.

Templates are word sequences with a label.  All rolling k-gram hashes of a
document are joined to the places of the same k-gram in the templates; a match
votes for the diagonal document place less template place.  Votes are added up
per document, template and diagonal, diagonals at most ``SLACK`` apart are
merged (a word more or less shifts the rest of a notice), and the merged spans
are verified: the joined k-grams are compared word by word, a phrase needs all of
its k-grams on one diagonal, a notice ``COVER`` of its k-grams within a span
not much longer than itself.

Phrases are the base set; notices are added by this method.  The templates are
a short list in this module or a table; up to ``MOST`` k-grams are broadcast, so that the scan
runs in one code-generated stage from which only matches leave, and more are joined by shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillflow.llm.shared import ascii_lower, word_places, words_of

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SEPARATOR_CHARS = "".join(map(chr, [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
PHRASE_K, NOTICE_K = 2, 3
SLACK = 2
COVER = 0.6
MOST = 200_000

# Base phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Openings of public license notices, and short licence lines.
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this "
     "software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file "
     "except in compliance with the license", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms "
     "of the gnu general public license as published by the free software foundation", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are "
     "permitted provided that the following conditions are met", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or "
     "without fee is hereby granted", "isc"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("this work is licensed under a creative commons attribution 4 0 international license",
     "cc-by"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by nd 4 0", "cc-by-nd"),
)


def grams(spark: SparkSession, templates=PHRASES + NOTICES) -> DataFrame:
    """(template, label, phrase, size, place, gram words, hash of the first two)."""
    rows = []
    for number, (text, label) in enumerate(templates):
        words, phrase = text.split(), number < len(PHRASES)
        k = PHRASE_K if phrase else NOTICE_K
        for place in range(len(words) - k + 1):
            third = words[place + 2] if k == NOTICE_K else None
            rows.append((number, label, phrase, len(words) - k + 1, place, words[place],
                         words[place + 1], third))
    frame = spark.createDataFrame(rows, "template int, label string, phrase boolean, grams int, "
                                        "place int, one string, two string, three string")
    return frame.withColumn("gram", F.xxhash64("one", "two"))


def table_grams(notices: DataFrame) -> DataFrame:
    """The columns of ``grams`` for a table (text, label) of notices.

    Words are taken as those of documents.  Equal notices of one label count once; a notice
    of two words is one 2-gram; fewer words, a null text or a null label match nothing.
    """
    words = words_of(ascii_lower(F.col("text")), SEPARATORS, _SEPARATOR_CHARS)
    rows = notices.select(F.col("label").cast("string").alias("label"), words.alias("words"))
    rows = rows.where("label is not null and size(words) >= 2").distinct()
    k = F.least(F.size("words"), F.lit(NOTICE_K))
    rows = rows.select("label", "words", k.alias("k"), F.xxhash64("label", "words").alias("template"),
                       (F.size("words") - k + 1).alias("grams"))
    rows = rows.withColumn("place", F.explode(F.sequence(F.lit(0), F.col("grams") - 1)))
    word = lambda i: F.get("words", F.col("place") + i)
    return rows.select(
        "template", "label", F.lit(False).alias("phrase"), "grams", "place", word(0).alias("one"),
        word(1).alias("two"), F.when(F.col("k") == NOTICE_K, word(2)).alias("three"),
        F.xxhash64(word(0), word(1)).alias("gram"))


def _joined(windows: DataFrame, word, notices: DataFrame | None) -> DataFrame:
    """``windows`` with the template k-grams of their hash; ``w0`` to ``w2`` are its words."""
    spark, named = windows.sparkSession, {f"w{i}": word(i) for i in range(NOTICE_K)}
    if notices is None:  # a hint, as Spark has no size for rows made on the driver
        return windows.join(F.broadcast(grams(spark)), "gram").withColumns(named)
    own = table_grams(notices)
    every = grams(spark, PHRASES).withColumn("template", F.col("template").cast("long")).unionByName(own)
    if own.limit(MOST + 1).count() <= MOST:
        return windows.join(F.broadcast(every), "gram").withColumns(named)
    # Shuffled: each window leaves its text behind and takes its words along.
    return windows.withColumns(named).drop("words").join(every.hint("merge"), "gram")


def scan(docs: DataFrame, notices: DataFrame | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``notices``, a table (text, label), takes the place of ``NOTICES``; base phrases stay.

    One row per input row.  A null or empty text has 0 words, no places, null
    first_word and last_word, empty labels and score 0.  ``score`` is 1 with a base
    phrase, else the best share of a notice's k-grams found, if that is ``COVER`` or more.
    Rows that repeat doc_id and text get equal results; a null doc_id stays.  Other
    columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.select("doc_id", F.xxhash64("text").alias("text_hash"),
                         words_of(ascii_lower(F.col("text")), SEPARATORS, _SEPARATOR_CHARS)
                         .alias("words"))
    word = lambda i: F.get("words", F.col("at") + i)
    windows = texts.select("doc_id", "text_hash", "words",
                           word_places("words", PHRASE_K).alias("at"))
    windows = windows.withColumn("gram", F.xxhash64(word(0), word(1)))
    found = _joined(windows, word, notices).where(
        "w0 = one and w1 = two and (three is null or w2 = three)")
    votes = found.groupBy("doc_id", "text_hash", "template", "label", "phrase", "grams",
                          (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.collect_set("place").alias("places"))
    order = (Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal"))
    apart = F.col("diagonal") - F.lag("diagonal").over(order)
    starts = F.when(F.col("phrase") | apart.isNull() | (apart > SLACK), 1).otherwise(0)
    spans = votes.withColumn("fresh", starts).withColumn("span", F.sum("fresh").over(order))
    spans = spans.groupBy("doc_id", "text_hash", "template", "label", "phrase", "grams", "span").agg(
        F.min("diagonal").alias("start"), F.max("diagonal").alias("end"),
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("votes"))
    share = F.col("votes") / F.col("grams")
    spans = spans.withColumn("share", share).where(
        F.when(F.col("phrase"), F.col("votes") == F.col("grams"))
        .otherwise((F.col("share") >= COVER)
                   & (F.col("end") - F.col("start") <= F.col("grams") / 2 + SLACK)))
    base = lambda column: F.when(F.col("phrase"), F.col(column))
    names = lambda column: F.array_join(F.array_sort(F.collect_set(column)), ",")
    per_text = spans.groupBy("doc_id", "text_hash").agg(
        F.count(base("start")).alias("n_base"),
        F.min(base("start")).cast("long").alias("first_word"),
        F.max(base("start")).cast("long").alias("last_word"),
        names(base("label")).alias("base_labels"), names(F.col("label")).alias("labels"),
        F.max(F.when(F.col("phrase"), 1.0).otherwise(F.col("share"))).alias("score"))
    rows = texts.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"),
                        F.size("words").cast("long").alias("n_words"))
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("text_hash"))
    return rows.join(per_text, same, "left").select(
        F.col("_id").alias("doc_id"), "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))

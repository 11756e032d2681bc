"""License scan by diagonal voting, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from demandloom.llm.common import documents
from demandloom.session import materialize

WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# No word; stands after the last word of a text, so that a gram starts at every word.
END = "\0"
K = 2

# Base phrases and their labels.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Public license wording that the method finds by itself, each with its label.
TEMPLATES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this "
    "software and associated documentation files": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "redistribution and use in source and binary forms with or without modification are "
    "permitted provided that the following conditions are met": "bsd",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it under the terms "
    "of the gnu general public license as published by the free software foundation": "gpl",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
}
# Share of a template's words that must agree in a span, and how far apart diagonals
# may lie that count as one place: an inserted or lost word shifts the rest by one.
AGREEMENT = 0.8
DRIFT = 2

KEY = ("_doc", "_hash")
PHRASE = ("phrase", "label", "base", "words")


def words(text: Column) -> Column:
    """Runs of digits, lower-case letters and all beyond ASCII, A-Z lowered.

    ``lower`` also lowers letters beyond ASCII. That changes no border of a word, and
    no word that a phrase could hold but for the Kelvin sign, which would become a
    ``k``; it is put aside first.
    """
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u0138")))
    return F.array_remove(F.split(low, WORD_GAP), "")


def grams(ws: Column, k: int) -> Column:
    """The ``k`` words from each word on, ``END`` for those beyond the last, and from the end."""
    ended = F.concat(ws, F.array_repeat(F.lit(END), k))
    count = F.size(ws) + 1
    found = F.slice(ended, 1, count)
    for j in range(1, k):
        found = F.zip_with(found, F.slice(ended, j + 1, count), lambda a, b: F.concat(a, F.lit(" "), b))
    return found


def template_grams(spark: SparkSession, base: dict, further: dict, k: int) -> DataFrame:
    """Template positions: one row per phrase and ``k``-gram, a few hundred in all.

    The row without a phrase meets the end of every text.
    """
    phrases = [(p, label, p in base) for p, label in {**further, **base}.items()]
    short = [p for p, _, _ in phrases if len(p.split()) < k]
    if short:
        raise ValueError(f"phrases of fewer than {k} words: {short}")
    rows = [
        (phrase, label, is_base, len(phrase.split()), at, " ".join(phrase.split()[at : at + k]))
        for phrase, label, is_base in phrases
        for at in range(len(phrase.split()) - k + 1)
    ]
    rows.append((None, None, None, None, None, " ".join([END] * k)))
    listed = spark.createDataFrame(
        rows, "phrase string, label string, base boolean, words int, at int, template_gram string"
    )
    return listed.withColumn("hash", F.xxhash64("template_gram"))


def matches(docs: DataFrame, base: dict, further: dict, k: int) -> DataFrame:
    """Places where a rolling ``k``-gram of a text is that of a template, and text ends.

    All grams of all texts are joined to the template positions by their hash; the
    words are compared where the hashes agree. ``pos`` is the place in the text, in
    words; the line without a phrase, one per row of ``docs``, has the number of words.
    """
    # A parameter of the scan, not data: some hundred rows.
    positions = F.broadcast(template_grams(docs.sparkSession, base, further, k))
    return (
        docs.select(
            F.col("doc_id").alias("_doc"),
            F.xxhash64("text").alias("_hash"),
            F.posexplode(grams(words(F.col("text")), k)).alias("pos", "gram"),
        )
        .withColumn("hash", F.xxhash64("gram"))
        .join(positions, "hash")
        .where(F.col("gram") == F.col("template_gram"))
        .select(*KEY, *PHRASE, "at", "pos")
    )


def spans(met: DataFrame, k: int) -> DataFrame:
    """``(_doc, _hash, phrase, label, base, first, agreement)`` of every verified place.

    A match votes for the diagonal, position in the text minus position in the
    template. Diagonals at most ``DRIFT`` apart become one span, as an inserted or lost
    word shifts the rest. A span stands if the words of its votes, which are the very
    words of the template, cover ``AGREEMENT`` of it. The words of a base phrase stand on
    one diagonal, so there every diagonal is a span and has to be covered whole.
    """
    diagonal = (F.col("pos") - F.col("at")).alias("diagonal")
    votes = met.groupBy(*KEY, *PHRASE, diagonal).agg(F.collect_set("at").alias("met"))
    along = Window.partitionBy(*KEY, "phrase").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along)
    opens = F.when(F.col("base") | apart.isNull() | (apart > DRIFT), 1).otherwise(0)
    places = F.flatten(F.collect_list("met"))
    covered = F.flatten(F.transform(places, lambda i: F.sequence(i, i + k - 1)))
    return (
        votes.withColumn("opens", opens)
        .withColumn("span", F.sum("opens").over(along))
        .groupBy(*KEY, *PHRASE, "span")
        .agg(
            F.min("diagonal").cast("long").alias("first"),
            F.size(F.array_distinct(covered)).alias("covered"),
        )
        .withColumn("agreement", F.col("covered") / F.col("words"))
        .where(F.col("agreement") >= F.when(F.col("base"), 1.0).otherwise(AGREEMENT))
        .select(*KEY, "phrase", "label", "base", "first", "agreement")
    )


def license_scan(docs: DataFrame, base=BASE, further=TEMPLATES, k: int = K) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words`` and what ``spans`` found in its text.

    ``n_base``, ``first_word`` and ``last_word`` count base phrases only; ``labels`` adds
    those of the other templates to ``base_labels``; ``score`` is the best agreement. A
    NULL or empty text has no word, no label and score 0. Rows equal in ``doc_id`` and
    text share their result; other columns are not read.
    """
    met = materialize(matches(docs, base, further, k), "license-matches")
    is_base = F.col("base")
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    by_text = (
        spans(met.where("phrase is not null"), k)
        .groupBy(F.col("_doc").alias("_d"), F.col("_hash").alias("_h"))
        .agg(
            F.count_if(is_base).alias("n_base"),
            F.min(F.when(is_base, F.col("first"))).alias("first_word"),
            F.max(F.when(is_base, F.col("first"))).alias("last_word"),
            joined(F.when(is_base, F.col("label"))).alias("base_labels"),
            joined("label").alias("labels"),
            F.max("agreement").alias("score"),
        )
    )
    rows = met.where("phrase is null").select(*KEY, F.col("pos").cast("long").alias("n_words"))
    same = F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_hash") == F.col("_h"))
    return rows.join(by_text, same, "left").select(
        F.col("_doc").alias("doc_id"),
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op7(spark, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))

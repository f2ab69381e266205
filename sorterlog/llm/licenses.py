"""License scans by diagonal voting.

Templates are word sequences. All rolling word k-grams of all texts are joined
to the places of the same k-gram in the templates (the templates are a short
fixed list, so their side is broadcast). A match of text position p and
template position t votes for the diagonal p - t, where the template would
start. Votes are summed per text, template and diagonal. Exact templates have a
place at every diagonal that holds all their k-grams; the join compares the
words themselves, so such a place is verified. For the other templates
diagonals that lie close together (words left out or put in) are merged, and
a span counts if it covers enough of the template and is not much longer.

Texts are lower-cased; words are runs of digits, letters a-z and characters
beyond ASCII. Null texts count as empty: no words, no places, empty labels, score 0. Rows that
repeat doc_id and text have equal results. The score is the largest share of a
template's k-grams found in one span, 1 for an exact place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sorterlog.llm.shared import col, prepare
from sorterlog.sources.staging import stage

K = 3
NEAR = 4
COVER = 0.8
STRETCH = 1.3
WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"
SEPARATOR = r"[^0-9a-z\x{80}-\x{10FFFF}]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    exact: bool = False


# The phrases that name a license, and sentences of the license texts themselves.
TEMPLATES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    Template("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    Template("lgpl", "it under the terms of the gnu lesser general public license as published by the free software foundation"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
    Template("cc-by-sa", "licensed under a creative commons attribution sharealike license"),
)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATOR), "")


def template_grams(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    rows = []
    for number, t in enumerate(templates):
        words = t.text.split()
        if len(words) < K:
            raise ValueError(f"template {t.text!r} is shorter than {K} words")
        rows += [(number, t.label, t.exact, len(words), i, *words[i : i + K]) for i in range(len(words) - K + 1)]
    return spark.createDataFrame(rows, "template int, label string, exact boolean, size int, t int, t0 string, t1 string, t2 string").withColumn(
        "hash", F.xxhash64("t0", "t1", "t2"),
    )


def votes(df: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Matches of `df` (doc_id, text): doc_id, text_hash, template, label, exact, size, diagonal, and how many k-grams of the template lie on it."""
    words = df.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("w"))
    rolling = words.select(
        "doc_id", "text_hash",
        F.posexplode(F.arrays_zip(F.col("w").alias("w0"), F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))).alias("w1"), F.slice("w", 3, F.greatest(F.size("w"), F.lit(1))).alias("w2"))).alias("p", "gram"),
    ).select("doc_id", "text_hash", "p", "gram.*").withColumn("hash", F.xxhash64("w0", "w1", "w2"))
    grams = F.broadcast(template_grams(df.sparkSession, templates))  # a fixed list
    same = (rolling["hash"] == grams["hash"]) & (F.col("w0") == F.col("t0")) & (F.col("w1") == F.col("t1")) & (F.col("w2") == F.col("t2"))
    return (
        rolling.join(grams, same).withColumn("diagonal", (F.col("p") - F.col("t")).cast("long"))
        .groupBy("doc_id", "text_hash", "template", "label", "exact", "size", "diagonal").agg(F.count_distinct("t").alias("votes"), F.min("t").alias("low"), F.max("t").alias("high"))
    )


def spans(found: DataFrame) -> DataFrame:
    """Places of templates: doc_id, text_hash, label, exact, first and last word, cover, and whether the place counts."""
    exact = found.where("exact and votes = size - 2").select(
        "doc_id", "text_hash", "label", "exact", F.col("diagonal").alias("first"), (F.col("diagonal") + F.col("size") - 1).alias("last"),
        F.lit(1.0).alias("cover"), F.lit(True).alias("counts"),
    )
    line = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    loose = (
        found.where("not exact").withColumn("new", (F.col("diagonal") - F.lag("diagonal", 1, -1_000_000_000).over(line) > NEAR).cast("int"))
        .withColumn("group", F.sum("new").over(line))
        .groupBy("doc_id", "text_hash", "template", "label", "exact", "size", "group").agg(
            F.least(F.sum("votes"), F.first("size") - (K - 1)).alias("votes"),
            F.min(F.col("diagonal") + F.col("low")).alias("first"), F.max(F.col("diagonal") + F.col("high") + (K - 1)).alias("last"),
        )
        .withColumn("cover", F.col("votes") / (F.col("size") - (K - 1)))
        .withColumn("counts", (F.col("cover") >= COVER) & (F.col("last") - F.col("first") + 1 <= F.col("size") * STRETCH))
        .select("doc_id", "text_hash", "label", "exact", "first", "last", "cover", "counts")
    )
    return exact.unionByName(loose)


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row per row of `df`: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    prepare(df.sparkSession)
    docs = df.select(col(key).alias("doc_id"), col(text).alias("text"))
    found = spans(stage(votes(docs, templates), "license-votes"))
    base = F.col("exact")

    def joined(condition: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("label")))), ",")

    summed = found.groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("h")).agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("first"))).alias("first_word"), F.max(F.when(base, F.col("first"))).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("counts")).alias("labels"), F.max("cover").alias("score"),
    )
    summed = stage(summed, "license-places")
    narrow = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce(F.regexp_count(F.lower("text"), F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))
    return narrow.join(summed, same, "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )

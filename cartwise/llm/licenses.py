"""License scans by diagonal voting: rolling word k-grams joined to template positions, summed by offset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# The phrases whose places are counted, by label.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# Notices the method looks for besides, by label; a span that holds most of a notice's words in order counts.
NOTICES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
            " documentation files the software to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in"
                 " compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that"
            " the following conditions are met"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
              " public license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("all-rights-reserved", "all rights reserved"),
)
GRAM = 3
NEAR = 2  # neighbouring diagonals: so many words may be put in or left out between two that are one span
COVER = 0.8  # of a notice's words, so many stand in a span that is one
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """The words of a text with A-Z in lower case; null text has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower()), F.lit(WORD), F.lit(0))


def grams(df: DataFrame, *keep: Column) -> DataFrame:
    """``at``, ``w0``, ``w1``, ``w2``: three words from each word of ``words`` on, and a marker row of nulls ``at`` -1."""
    w = F.col("words")
    size = F.size(w)
    rolled = F.arrays_zip(w.alias("w0"), F.slice(w, 2, size).alias("w1"), F.slice(w, 3, size).alias("w2"))
    none = F.lit(None).cast("string")
    marked = F.concat(F.array(F.struct(none.alias("w0"), none.alias("w1"), none.alias("w2"))), rolled)
    return df.select(*keep, F.posexplode(marked).alias("index", "gram")).withColumn("at", F.col("index") - 1).select(
        "*", "gram.*"
    ).drop("index", "gram")


def templates(spark: SparkSession, base: tuple = BASE, notices: tuple = NOTICES) -> DataFrame:
    """``template``, ``label``, ``base``, ``words`` of each phrase; as small as the lists given."""
    listed = [F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(i < len(base)).alias("base"), words(F.lit(text)).alias("words"))
              for i, (label, text) in enumerate((*base, *notices))]
    return spark.range(1).select(F.inline(F.array(*listed)))


def scan(docs: DataFrame, base: tuple = BASE, notices: tuple = NOTICES) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score``.

    Each three words of a text are looked up among those of the templates, which are broadcast: their number is that
    of the lists given. Only hits and one marker a document leave the scan. Hits are votes for a diagonal, the offset
    between text and template; a base phrase stands where its diagonal has every vote, word for word. Diagonals of a
    template within NEAR of the one before are merged, and a span is a notice if it covers COVER of its words;
    ``score`` is the largest share covered, 0 without a vote.

    Null and empty texts have no words; null ids stay; rows equal in id and text are scanned as one and each get a
    row; an empty table gives none; other columns are not read. A phrase must have three words or more.
    """
    spark = docs.sparkSession
    known = templates(spark, base, notices)
    length = F.size("words")
    posts = grams(known.select("template", "label", "base", length.alias("length"), "words"),
                  F.col("template"), F.col("label"), F.col("base"), F.col("length"))
    posts = posts.where("w2 is not null").select(
        "template", "label", "base", "length", F.col("at").alias("place"), F.xxhash64("w0", "w1", "w2").alias("hash"),
        F.col("w0").alias("t0"), F.col("w1").alias("t1"), F.col("w2").alias("t2"),
    )
    texts = docs.select("doc_id", F.md5("text").alias("digest"), words(docs["text"]).alias("words"))
    rolled = grams(texts, F.col("doc_id"), F.col("digest"), F.size("words").alias("n_words"))
    # Joined on the hash alone, one long; the words are compared after.
    hits = rolled.join(F.broadcast(posts), F.xxhash64("w0", "w1", "w2") == F.col("hash"), "left")
    same = (F.col("w0") == F.col("t0")) & (F.col("w1") == F.col("t1")) & (F.col("w2") == F.col("t2"))
    key, about = ["doc_id", "digest", "n_words"], ["template", "label", "base", "length"]
    votes = hits.where((F.col("at") == -1) | same).groupBy(
        *key, *about, (F.col("at") - F.col("place")).alias("diagonal")
    ).agg(F.collect_set("place").alias("places"), F.count_if(F.col("at") == -1).alias("copies"))
    order = Window.partitionBy(*key, "template").orderBy("diagonal")
    fresh = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > NEAR, F.lit(False)).cast("int")
    whole = F.when(F.col("base") & (F.size("places") == F.col("length") - (GRAM - 1)), F.col("diagonal"))
    spans = votes.withColumn("fresh", fresh).withColumn("span", F.sum("fresh").over(order)).groupBy(*key, *about, "span").agg(
        F.flatten(F.collect_list("places")).alias("places"), F.sum("copies").alias("copies"), F.count(whole).alias("stands"),
        F.min(whole).alias("first"), F.max(whole).alias("last"),
    )
    held = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + GRAM - 1)))))
    share = F.coalesce(held / F.col("length"), F.lit(0.0))
    is_base = F.when(F.col("stands") > 0, F.col("label"))
    found = F.coalesce(is_base, F.when(share >= COVER, F.col("label")))
    listed = lambda label: F.array_join(F.array_sort(F.collect_set(label)), ",")
    return spans.groupBy(*key).agg(
        F.sum("copies").cast("int").alias("copies"), F.sum("stands").alias("n_base"),
        F.min("first").cast("long").alias("first_word"), F.max("last").cast("long").alias("last_word"),
        listed(is_base).alias("base_labels"), listed(found).alias("labels"), F.max(share).alias("score"),
    ).select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word", "base_labels",
        "labels", "score", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy"),
    ).drop("copy")


def oracle(base: tuple = BASE, notices: tuple = NOTICES) -> str:
    """The same result as DuckDB SQL over ``documents``, whose ids are unique there."""
    listed = ", ".join(f"({i}, '{label}', {i < len(base)}, string_split('{text}', ' '))" for i, (label, text) in enumerate((*base, *notices)))
    return f"""
WITH t(template, label, base, w) AS (VALUES {listed}),
posts AS (SELECT template, label, base, len(w) AS length, p - 1 AS place, w[p] AS t0, w[p + 1] AS t1, w[p + 2] AS t2
          FROM t, unnest(range(1, len(w) - 1)) AS r(p)),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
rolled AS (SELECT doc_id, p - 1 AS pos, w[p] AS w0, w[p + 1] AS w1, w[p + 2] AS w2 FROM d, unnest(range(1, len(w) - 1)) AS r(p)),
votes AS (SELECT doc_id, template, label, base, length, pos - place AS diagonal, list(place) AS places
          FROM rolled JOIN posts ON w0 = t0 AND w1 = t1 AND w2 = t2 GROUP BY ALL),
marked AS (SELECT *, coalesce(diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) > {NEAR}, false) AS fresh
           FROM votes),
numbered AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span,
             CASE WHEN base AND len(places) = length - 2 THEN diagonal END AS whole FROM marked),
spans AS (SELECT doc_id, template, label, length, flatten(list(places)) AS places, count(whole) AS stands,
          min(whole) AS first, max(whole) AS last FROM numbered GROUP BY doc_id, template, label, length, span),
shared AS (SELECT *, len(list_distinct(flatten(list_transform(places, lambda p: [p, p + 1, p + 2])))) / length AS share FROM spans),
found AS (SELECT doc_id, sum(stands) AS n_base, min(first) AS first_word, max(last) AS last_word,
          string_agg(DISTINCT CASE WHEN stands > 0 THEN label END, ',' ORDER BY CASE WHEN stands > 0 THEN label END) AS base_labels,
          string_agg(DISTINCT CASE WHEN stands > 0 OR share >= {COVER} THEN label END, ','
                     ORDER BY CASE WHEN stands > 0 OR share >= {COVER} THEN label END) AS labels, max(share) AS score
          FROM shared GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN found ON d.doc_id = found.doc_id"""

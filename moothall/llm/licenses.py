"""License scans by diagonal voting.

Every pair of neighbouring words of a document (its rolling 2-grams) is hashed and joined to the positions of such pairs in
the license templates; the join compares the words themselves. A hit votes for the diagonal on which the template would start:
its place in the document less its place in the template. Votes are summed by diagonal, neighbouring diagonals (words
were put in or left out) are merged into spans, and a span is verified by the share of the template's pairs it has.

Base templates are short phrases, whose spans need every pair on one diagonal, so they are exact occurrences. Notices
need ``LEAST`` of their pairs. The templates are fixed values of a few hundred words, so their table is broadcast.

Defined results: null text is empty: no words, no places, empty labels, score 0; places are word numbers from 0; every
row of the input gives one row; a very long text's words are one array in its row; only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moothall.llm.common import once, settled, words_of

#: Share of a notice's pairs that a span must have, and words between diagonals that are still neighbours.
LEAST, NEAR = 0.6, 3

# Phrases and the labels they stand for.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Well-known license notices, and the labels they stand for.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at": "apache-2.0",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache-2.0",
    "released under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software": "mit-notice",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl-notice",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4.0",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
}


def template_rows() -> list[tuple[int, str, bool, int, int, str, str]]:
    """(template, label, base, number of pairs, place, first word, second word)."""
    out = []
    texts = [(t, label, True) for t, label in PHRASES.items()] + [(t, label, False) for t, label in NOTICES.items()]
    for number, (text, label, base) in enumerate(texts):
        words = text.split(" ")
        out += [(number, label, base, len(words) - 1, i, a, b) for i, (a, b) in enumerate(zip(words, words[1:]))]
    return out


def templates(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(
        template_rows(), "template int, label string, base boolean, n_pairs int, place int, one string, two string"
    )
    return rows.withColumn("own_key", F.xxhash64("one", "two"))


def _pairs(words: Column) -> Column:
    """(place, word, next word) of all neighbours."""
    n = F.size(words)
    places = F.when(n > 1, F.sequence(F.lit(0), n - 2)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.struct(i.alias("at"), F.get(words, i).alias("a"), F.get(words, i + 1).alias("b")))


def license_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, template, label, base, start, stop, share) of each verified span, and one row for each document with null
    template and its number of words in ``n_words``."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    rows = once(rows, words=words_of(F.col("text")))
    none = F.lit(None).cast("string")
    head = F.struct((-1 - F.size("words")).alias("at"), none.alias("a"), none.alias("b"))
    rows = rows.select("row", F.inline(F.concat(F.array(head), _pairs(F.col("words")))))
    rows = rows.withColumn("key", F.when(F.col("at") >= 0, F.xxhash64("a", "b")))
    known = F.broadcast(templates(docs.sparkSession))
    same = (F.col("key") == F.col("own_key")) & (F.col("a") == F.col("one")) & (F.col("b") == F.col("two"))
    met = rows.join(known, same, "left")
    met = met.where("at < 0 OR template IS NOT NULL")
    met = met.select("row", "at", "template", "label", "base", "n_pairs", "place", (F.col("at") - F.coalesce("place", F.lit(0))).alias("diagonal"))
    # all that follows is by row: one shuffle, of head rows and hits
    votes = met.repartition("row").groupBy("row", "template", "label", "base", "n_pairs", "diagonal")
    votes = votes.agg(F.collect_set("place").alias("places"), F.min("at").alias("start"), F.max("at").alias("stop"))
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > F.when(F.col("base"), 0).otherwise(NEAR), F.lit(True))
    votes = votes.withColumn("apart", apart.cast("int")).withColumn("span", F.sum("apart").over(order))
    spans = votes.groupBy("row", "template", "label", "base", "n_pairs", "span").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("found"),
        F.min("start").alias("start"),
        F.max("stop").alias("stop"),
    )
    share = F.col("found") / F.col("n_pairs")
    spans = spans.withColumn("share", share).where(
        F.col("template").isNull() | F.when(F.col("base"), F.col("found") == F.col("n_pairs")).otherwise(F.col("share") >= LEAST)
    )
    n_words = F.when(F.col("template").isNull(), -1 - F.col("start"))
    return spans.select("row", "template", "label", "base", "start", "stop", "share", n_words.alias("n_words"))


def license_report(docs: DataFrame) -> DataFrame:
    """One row for each document: words, places of the base phrases, labels and the best span's share."""
    docs = settled(docs)
    spans = license_spans(docs.select("text"))
    base = F.col("base") & F.col("template").isNotNull()
    labels = lambda x: F.array_join(F.array_sort(F.collect_set(x)), ",")
    found = spans.groupBy("row").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        labels(F.when(base, F.col("label"))).alias("base_labels"),
        labels("label").alias("labels"),
        F.coalesce(F.max(F.when(F.col("template").isNotNull(), F.col("share"))), F.lit(0.0)).alias("score"),
    )
    names = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id")
    return names.join(found, "row").drop("row")


def _oracle() -> str:
    from moothall.llm.decontaminate import _WORDS_SQL

    rows = ", ".join(f"({t}, '{label}', {base}, {n}, {p}, '{a}', '{b}')" for t, label, base, n, p, a, b in template_rows())
    return f"""
WITH known AS (SELECT * FROM (VALUES {rows}) AS v(template, label, base, n_pairs, place, one, two)),
doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS_SQL} AS w FROM documents),
pairs AS (SELECT r, w, unnest(range(1, len(w))) AS i FROM doc WHERE len(w) > 1),
hit AS (
  SELECT r, i - 1 AS spot, template, label, base, n_pairs, place, i - 1 - place AS diagonal
  FROM (SELECT r, i, w[i] AS one, w[i + 1] AS two FROM pairs) s JOIN known USING (one, two)),
vote AS (
  SELECT *, coalesce(diagonal - lag(diagonal) OVER o > CASE WHEN base THEN 0 ELSE {NEAR} END, true) AS apart
  FROM (SELECT r, template, label, base, n_pairs, diagonal, min(spot) AS start, list(DISTINCT place) AS places
        FROM hit GROUP BY ALL)
  WINDOW o AS (PARTITION BY r, template ORDER BY diagonal)),
spanned AS (SELECT *, sum(apart::INT) OVER (PARTITION BY r, template ORDER BY diagonal) AS span FROM vote),
span AS (
  SELECT r, template, label, base, n_pairs, min(start) AS start, len(list_distinct(flatten(list(places)))) AS found
  FROM spanned GROUP BY r, template, label, base, n_pairs, span),
good AS (SELECT *, found / n_pairs AS share FROM span WHERE CASE WHEN base THEN found = n_pairs ELSE found / n_pairs >= {LEAST} END),
total AS (
  SELECT r, count(*) FILTER (base) AS n, min(start) FILTER (base) AS a, max(start) FILTER (base) AS b, max(share) AS score,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM good GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, a::BIGINT AS first_word, b::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM doc LEFT JOIN total USING (r)
"""


ORACLE = _oracle()

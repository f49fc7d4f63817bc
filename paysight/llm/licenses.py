"""License scan by diagonal voting, in DataFrame operations only.

Every rolling word 2-gram of every text is joined, by hash and then word for word, to the positions
of the templates' 2-grams. A hit votes for the diagonal (its place in the text minus its place in
the template). On one diagonal a template's words stand in the text in their order, so votes for all
of its 2-grams are a full occurrence that starts there. Words added to or missing from a notice move
the rest of it to a neighbouring diagonal; for the longer notices such diagonals are merged, and a
span is kept if one of its diagonals alone covers enough of the template, or all of them within twice its length.

The template table is a fixed list, so its broadcast is bounded. Texts are read once and never
shuffled: only hits, and one row per document that keeps its word count, leave the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, ascii_lower, table

# The contract's phrases and labels.
PHRASES = [
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
]

# Openings of well-known license notices, as lower-case words.
NOTICES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]

MERGE_GAP = 3  # diagonals so far apart still belong to one span
MIN_COVERAGE = 0.7  # of a notice's 2-grams


def template_list() -> list[tuple[int, str, bool, list[str]]]:
    """(number, label, is a contract phrase, words); at most 62 words each, for the vote masks."""
    every = [(label, True, phrase) for label, phrase in PHRASES] + [(label, False, text) for label, text in NOTICES]
    return [(k, label, base, phrase.split()) for k, (label, base, phrase) in enumerate(every)]


def template_positions(spark) -> DataFrame:
    """(template, label, base, grams, place, first, second, gram): one row per template 2-gram."""
    rows = [
        f"({k}, '{label}', {str(base).lower()}, {len(words) - 1}, {place}, '{a}', '{b}')"
        for k, label, base, words in template_list()
        for place, (a, b) in enumerate(zip(words, words[1:]))
    ]
    values = spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t(template, label, base, grams, place, first, second)")
    return values.withColumn("gram", F.xxhash64("first", "second"))


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD_PATTERN), F.lit(0))


def diagonals(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Votes per (document, template, diagonal), and one row per document with a null template.

    Documents are told apart by id and text digest; equal rows vote alike, and are counted in the
    row with the null template.
    """
    text = F.col(text_col).cast("string")
    read = docs.select(F.col(id_col).alias("id"), F.md5(text.cast("binary")).alias("digest"), words(text).alias("w"))
    # place -1 stands for the document itself
    places = read.select("*", F.size("w").alias("n_words"), F.explode(F.sequence(F.lit(-1), F.greatest(F.size("w") - 2, F.lit(-1)))).alias("pos"))
    places = places.withColumn("hash", F.when(F.col("pos") >= 0, F.xxhash64(F.get("w", F.col("pos")), F.get("w", F.col("pos") + 1))))
    t = F.broadcast(template_positions(docs.sparkSession))
    same = (F.col("hash") == t["gram"]) & (F.get("w", F.col("pos")) == t["first"]) & (F.get("w", F.col("pos") + 1) == t["second"])
    hits = places.join(t, same, "left").filter((F.col("pos") == -1) | F.col("template").isNotNull())
    keys = ["id", "digest", "n_words", "template", "label", "base", "grams"]
    return hits.groupBy(*keys, (F.col("pos") - F.col("place")).alias("diagonal")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place"))).alias("votes"),
        F.min("pos").alias("first_hit"),
        F.max("pos").alias("last_hit"),
        F.count("*").alias("copies"),
    )


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Merged and verified spans: (id, digest, n_words, template, label, base, first_word, last_word, coverage, copies).

    A document without any comes as one row with a null template, as does every document besides.
    """
    votes = diagonals(docs, id_col, text_col)
    doc = ["id", "digest", "n_words", "template"]
    by_place = Window.partitionBy(*doc).orderBy("diagonal")
    # a contract phrase is never merged: each of its diagonals is a place of its own
    apart = F.coalesce(F.col("base"), F.lit(True)) | (F.col("diagonal") - F.lag("diagonal").over(by_place) > MERGE_GAP)
    numbered = votes.withColumn("apart", F.coalesce(apart, F.lit(True)).cast("int"))
    numbered = numbered.withColumn("span", F.sum("apart").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
    merged = numbered.groupBy(*doc, "label", "base", "grams", "span").agg(
        (F.bit_count(F.bit_or("votes")) / F.col("grams")).alias("coverage"),
        F.min("first_hit").alias("first_word"),
        (F.max("last_hit") + 1).alias("last_word"),
        F.max("copies").alias("copies"),
        F.max(F.bit_count("votes") / F.col("grams")).alias("alone"),
    )
    # a diagonal by itself is never longer than its notice; the merged span is verified besides
    short = F.col("last_word") - F.col("first_word") < 2 * (F.col("grams") + 1)
    either = F.greatest("alone", F.when(short, F.col("coverage")).otherwise(0.0))
    merged = merged.withColumn("coverage", F.when(F.col("base"), F.col("coverage")).otherwise(either))
    verified = F.when(F.col("base"), F.col("coverage") == 1).otherwise(F.col("coverage") >= MIN_COVERAGE)
    return merged.filter(F.col("template").isNull() | verified).drop("span", "grams", "alone")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Null and empty texts have no words: counts 0, places null, labels empty, score 0. The score is
    the best coverage of any template found. Null and repeated ids and repeated rows keep their rows.
    """
    found = spans(docs, id_col, text_col)
    base = F.coalesce(F.col("base"), F.lit(False))
    joined = lambda labels: F.array_join(F.array_sort(F.collect_set(labels)), ",")
    per_doc = found.groupBy("id", "digest", "n_words").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).cast("long").alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"),
        joined(F.col("label")).alias("labels"),
        F.coalesce(F.max("coverage"), F.lit(0.0)).alias("score"),
        F.max(F.when(F.col("template").isNull(), F.col("copies"))).cast("int").alias("copies"),
    )
    out = per_doc.withColumn("n_words", F.col("n_words").cast("long")).withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies"))))
    return out.select(F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op3_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


_TEMPLATES = ", ".join(f"({k}, '{label}', {str(base).lower()}, '{' '.join(ws)}')" for k, label, base, ws in template_list())

OP3_SQL = f"""
WITH t(template, label, base, phrase) AS (VALUES {_TEMPLATES}),
tw AS (SELECT *, string_split(phrase, ' ') AS tw, len(string_split(phrase, ' ')) - 1 AS grams FROM t),
tg AS (SELECT template, label, base, grams, place, tw[place + 1] AS a, tw[place + 2] AS b
  FROM (SELECT *, unnest(range(grams)) AS place FROM tw)),
d AS (SELECT row_number() OVER () AS rid, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
g AS (SELECT rid, pos, w[pos + 1] AS a, w[pos + 2] AS b FROM (SELECT rid, w, unnest(range(len(w) - 1)) AS pos FROM d WHERE len(w) > 1)),
votes AS (
  SELECT rid, template, label, base, grams, pos - place AS diagonal, bit_or(CAST(1 AS BIGINT) << place) AS votes,
    min(pos) AS first_hit, max(pos) AS last_hit
  FROM g JOIN tg USING (a, b) GROUP BY ALL),
marked AS (SELECT *, CASE WHEN base OR coalesce(diagonal - lag(diagonal) OVER (PARTITION BY rid, template ORDER BY diagonal) > {MERGE_GAP}, true) THEN 1 ELSE 0 END AS apart FROM votes),
numbered AS (SELECT *, sum(apart) OVER (PARTITION BY rid, template ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS span FROM marked),
merged AS (
  SELECT rid, template, label, base, grams, span, CAST(bit_count(bit_or(votes)) AS DOUBLE) / grams AS coverage,
    min(first_hit) AS first_word, max(last_hit) + 1 AS last_word, max(CAST(bit_count(votes) AS DOUBLE) / grams) AS alone
  FROM numbered GROUP BY rid, template, label, base, grams, span),
verified AS (SELECT * REPLACE (CASE WHEN base THEN coverage ELSE greatest(alone, CASE WHEN last_word - first_word < 2 * (grams + 1) THEN coverage ELSE 0 END) END AS coverage) FROM merged),
kept AS (SELECT * FROM verified WHERE CASE WHEN base THEN coverage = 1 ELSE coverage >= {MIN_COVERAGE} END),
per_doc AS (
  SELECT rid, count(*) FILTER (base) AS n_base, min(first_word) FILTER (base) AS first_word, max(first_word) FILTER (base) AS last_word,
    coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(coverage) AS score
  FROM kept GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN per_doc USING (rid)
"""

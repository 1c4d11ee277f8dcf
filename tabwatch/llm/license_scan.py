"""License scan by diagonal voting, in DataFrame operations only.

Every rolling word 3-gram of a text is joined (by hash, then by its words) to its positions in
the templates. A hit of text position p on template position t votes for diagonal p - t.
Neighbouring diagonals of one template merge (inserted or dropped words), and the share of
template grams that the merged diagonals cover decides. A base phrase needs every gram on one
diagonal, which verifies its span word for word."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwatch.llm.common import text_or_empty, values_table
from tabwatch.llm.license_texts import TEXTS

K = 3               # words per gram
BAND = 2            # diagonals at most this far apart merge
MIN_COVERAGE = 0.75
MAX_TEMPLATE_WORDS = 100_000  # bound of what is broadcast; more raises

# Base phrases and their labels.
BASE = [("mit", "under the mit license"), ("apache-2", "apache license version 2"),
        ("cc-by-nc", "cc by nc")]
# Public license statements, as lower-case words. Whole texts and notices follow them.
STATEMENTS = [
    ("gpl-3", "gnu general public license version 3"),
    ("lgpl-3", "gnu lesser general public license version 3"),
    ("agpl-3", "gnu affero general public license version 3"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
            "software and associated documentation files the software to deal in the software "
            "without restriction"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
            "permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with "
            "or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TEMPLATES = STATEMENTS + [(label, " ".join(w for w in re.split(NO_WORD, text.lower()) if w)) for label, text in TEXTS]


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), NO_WORD), "")


def template_grams(spark: SparkSession, base=BASE, templates=TEMPLATES) -> DataFrame:
    rows = []
    for tid, (label, phrase) in enumerate([*base, *templates]):
        w = phrase.split(" ")
        if len(w) < K:
            raise ValueError(f"a template needs at least {K} words: {phrase!r}")
        rows += [(tid, label, tid < len(base), len(w) - K + 1, t, " ".join(w[t:t + K]))
                 for t in range(len(w) - K + 1)]
    if len(rows) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates hold more than {MAX_TEMPLATE_WORDS} words")
    return values_table(spark, [("tid", "int"), ("label", "string"), ("is_base", "boolean"),
                                ("n_grams", "int"), ("tpos", "int"), ("tgram", "string")], rows) \
        .withColumn("th", F.xxhash64("tgram"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  base=BASE, templates=TEMPLATES) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score.

    n_base counts every place where a base phrase stands; first_word and last_word are the
    smallest and largest start (null if none). labels adds templates covered by at least
    MIN_COVERAGE; score is 1 with a base phrase, else the best coverage. Null text: empty, so
    n_words 0, no labels (empty strings), score 0. Rows equal in id and text give equal rows;
    a null id is kept. Very long texts are scanned whole. Columns other than the two named are not
    read, whatever their names. Empty table: no rows."""
    spark = docs.sparkSession
    text = text_or_empty(text_col)
    d = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("h"),
                    words(text).alias("w"))
    gram = F.transform("w", lambda x, i: F.concat(x, F.lit(" "), F.get("w", i + 1), F.lit(" "),
                                                  F.get("w", i + 2)))
    # position 0 is a marker that stands for the row itself, so that rows without hits stay
    x = d.select("doc_id", "h", F.size("w").alias("nw"), F.posexplode(F.concat(
        F.array(F.lit("")), F.when(F.size("w") >= K, F.slice(gram, 1, F.size("w") - (K - 1)))
        .otherwise(F.array().cast("array<string>")))).alias("p", "gram"))
    hits = x.withColumn("gh", F.xxhash64("gram")).join(
        F.broadcast(template_grams(spark, base, templates)), F.col("gh") == F.col("th"), "left") \
        .where("p = 0 OR gram = tgram")
    key = ["doc_id", "h"]
    diagonal = (F.col("p") - 1 - F.col("tpos")).alias("diag")
    votes = hits.select(*key, "nw", "p", "tid", "label", "is_base", "n_grams", "tpos", diagonal) \
        .groupBy(*key, "nw", "tid", "label", "is_base", "n_grams", "diag") \
        .agg(F.collect_set("tpos").alias("ts"),
             F.sum((F.col("p") == 0).cast("long")).alias("m"))
    by_template = Window.partitionBy(*key, "tid").orderBy("diag")
    new = F.coalesce(F.col("diag") - F.lag("diag").over(by_template) > BAND, F.lit(True))
    merged = votes.withColumn("new", new.cast("int")) \
        .withColumn("run", F.sum("new").over(by_template)) \
        .groupBy(*key, "nw", "tid", "label", "is_base", "n_grams", "run") \
        .agg(F.array_distinct(F.flatten(F.collect_list("ts"))).alias("ts"),
             F.collect_list(F.when(F.size("ts") == F.col("n_grams"), F.col("diag"))).alias("whole"),
             F.sum("m").alias("m"))
    place = F.col("is_base") & (F.size("whole") > 0)
    cover = F.size("ts") / F.col("n_grams")
    found = F.when(F.col("is_base"), F.size("whole") > 0).otherwise(cover >= MIN_COVERAGE)
    out = merged.groupBy(*key, "nw").agg(
        F.coalesce(F.sum(F.when(place, F.size("whole"))), F.lit(0)).cast("long").alias("n_base"),
        F.min(F.when(place, F.array_min("whole"))).cast("long").alias("first_word"),
        F.max(F.when(place, F.array_max("whole"))).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(place, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set(F.when(found, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(place, F.lit(1.0)).when(~F.col("is_base"), cover)), F.lit(0.0))
        .alias("score"),
        F.sum("m").alias("m"))
    return out.select("doc_id", F.col("nw").cast("long").alias("n_words"), "n_base", "first_word",
                      "last_word", "base_labels", "labels", F.round("score", 6).alias("score"),
                      F.explode(F.sequence(F.lit(1).cast("long"), "m")).alias("k")).drop("k")


def oracle_sql(base=BASE, templates=TEMPLATES) -> str:
    """The same result in DuckDB SQL, by comparing words at every position."""
    t = ", ".join(f"({i}, '{lab}', {i < len(base)}, '{ph}')"
                  for i, (lab, ph) in enumerate([*base, *templates]))
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT rid, p - 1 AS p, w[p] || ' ' || w[p+1] || ' ' || w[p+2] AS gram FROM (
  SELECT rid, w, unnest(range(1, len(w) - 1)) AS p FROM d WHERE len(w) >= 3)),
t0(tid, label, is_base, phrase) AS (VALUES {t}),
t1 AS (SELECT tid, label, is_base, string_split(phrase, ' ') AS w FROM t0),
t2 AS (SELECT tid, label, is_base, len(w) - 2 AS n_grams, i - 1 AS tpos,
  w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS tgram
  FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM t1)),
hit AS (SELECT rid, tid, label, is_base, n_grams, tpos, p - tpos AS diag
  FROM g JOIN t2 ON gram = tgram),
runs AS (SELECT *, sum(new) OVER (PARTITION BY rid, tid ORDER BY diag RANGE UNBOUNDED PRECEDING) AS run
  FROM (SELECT *, CASE WHEN coalesce(diag - max(diag) OVER (PARTITION BY rid, tid ORDER BY diag
    RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > {BAND}, true)
    AND row_number() OVER (PARTITION BY rid, tid, diag ORDER BY tpos) = 1 THEN 1 ELSE 0 END AS new
    FROM hit)),
place AS (SELECT rid, tid, label, diag FROM hit WHERE is_base
  GROUP BY rid, tid, label, diag, n_grams HAVING count(DISTINCT tpos) = n_grams),
cover AS (SELECT rid, tid, label, run, count(DISTINCT tpos) * 1.0::DOUBLE / any_value(n_grams) AS c
  FROM runs WHERE NOT is_base GROUP BY rid, tid, label, run),
a AS (SELECT rid, count(*) AS n_base, min(diag) AS first_word, max(diag) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM place GROUP BY rid),
b AS (SELECT rid, max(c) AS c FROM cover GROUP BY rid),
l AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (
  SELECT rid, label FROM place UNION ALL SELECT rid, label FROM cover WHERE c >= {MIN_COVERAGE})
  GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
  first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  round(CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(c, 0.0::DOUBLE) END, 6) AS score
FROM d LEFT JOIN a USING (rid) LEFT JOIN b USING (rid) LEFT JOIN l USING (rid)"""

"""Benchmark decontamination by template canonicalisation, in DataFrame operations only.

Numbers, units and names become typed placeholders, so a question whose parameters were
changed keeps its template. Windows of five template words are joined by hash to those of the
benchmark; windows with slots are also joined by their plain lower-case words, as what looks
like a name depends on case and place. A window of placeholders only has no template: it is
joined by its plain words alone, so that tables of other numbers are no evidence. Per document, item and diagonal, a benchmark name must
always meet the same document word: windows holding a name that meets several do not count.
Equal numbers or units in several slots are parameters of their own and may change one by one.
Windows that cover at least 0.75 of an item mark a leak."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwatch.llm.common import packed, text_or_empty, unpacked

WINDOW = 5
MIN_COVERAGE = 0.75
# Benchmark windows up to this count are broadcast (a few dozen MB); beyond it both sides are
# shuffled by the window's hash. The result is the same.
BROADCAST_WINDOWS = 500_000

# Words that name a unit.
UNITS = ("km m cm mm mile miles kg g mg lb lbs pound pounds l ml litre litres liter liters hour hours "
         "minute minutes second seconds day days week weeks month months year years percent dollar "
         "dollars euro euros cent cents mph kmh usd eur").split()

NAME = "\uE002"  # private-use mark put before a word that looks like a name
# Capitalised words after a word that ends no sentence. Both patterns mean the same to the
# regular expressions of Java and RE2.
NAME_PATTERN = r"([^.!?:;\s][ \t]+)(\p{Lu}\p{Ll})"
ANY_SPACE = NAME_PATTERN.replace(r"[ \t]", r"\s")
NUMBER_JOIN = r"([0-9])[.,]([0-9])"
NO_WORD = r"[^\p{L}\p{N}" + NAME + "]+"


def template_words(text: Column) -> Column:
    """Raw words of a text; a word that looks like a name bears the NAME mark."""
    t = F.regexp_replace(text, ANY_SPACE, "$1" + NAME + "$2")
    t = F.regexp_replace(t, NUMBER_JOIN, "$1$2")
    return F.array_remove(F.split(t, NO_WORD), "")


def _kind(word: Column) -> Column:
    """Placeholder of a word, or null for an ordinary word."""
    return (F.when(word.startswith(NAME), F.lit("<name>"))
            .when((word >= "0") & (word < ":"), F.lit("<number>"))
            .when(F.lower(word).isin(UNITS), F.lit("<unit>")))


def windows(df: DataFrame, key: list[str], text: Column, out: str) -> DataFrame:
    """key, {out}_pos, wh (hash of the template window), {out}_slots (values of its slots,
    joined by spaces; null without slots), {out}_plain (false), {out}_same (wh is the hash of the
    plain words although there are slots) for every window of a text. A window of slots only has
    the hash of its plain words; any other one with slots stands there again with that hash,
    {out}_plain and {out}_same true."""
    w = df.select(*key, template_words(text).alias("w"))
    w = w.select(*key, "w", F.transform("w", _kind).alias("k"))
    slots = F.exists("k", lambda x: x.isNotNull())
    w = w.select(*key, F.transform("w", lambda x, i: F.xxhash64(F.coalesce(F.get("k", i), F.lower(x)))).alias("c"),
                 F.when(slots, F.transform("w", lambda x, i: F.when(
                     F.get("k", i).isNotNull(), F.lower(x)))).alias("s"),
                 F.when(slots, F.transform("w", lambda x: F.xxhash64(
                     F.lower(F.translate(x, NAME, ""))))).alias("l"))
    # no filter on the number of words here: pushed down, it would bring the definition of the
    # words into the functions below, once per word
    n = F.greatest(F.size("c") - (WINDOW - 1), F.lit(0))
    hashed = lambda c, i: F.xxhash64(*[F.get(c, i + k) for k in range(WINDOW)])
    row = lambda i, wh, s, plain, same: F.struct(
        i.alias("p"), wh.alias("wh"), s.alias("s"), F.lit(plain).alias("plain"), same.alias("same"))
    never, always = F.lit(False), F.lit(True)
    # values are only looked up in texts that have slots
    held = lambda i: F.coalesce(*[F.get("s", i + k) for k in range(WINDOW)]).isNotNull()
    values = lambda i: F.when(held(i), F.concat_ws(" ", *[F.get("s", i + k) for k in range(WINDOW)]))
    pure = lambda i: reduce(and_, [F.get("s", i + k).isNotNull() for k in range(WINDOW)])
    bare = F.transform("c", lambda _, i: row(i, hashed("c", i), F.lit(None).cast("string"), False, never))
    slotted = F.transform("c", lambda _, i: row(i, F.when(pure(i), hashed("l", i)).otherwise(hashed("c", i)),
                                                values(i), False, pure(i)))
    plain = F.transform("l", lambda _, i: F.when(held(i) & ~pure(i), row(i, hashed("l", i), values(i), True, always)))
    win = F.when(F.col("s").isNull(), F.slice(bare, 1, n)).otherwise(
        F.concat(F.slice(slotted, 1, n), F.array_compact(F.slice(plain, 1, n))))
    return w.select(*key, F.explode(win).alias("x")) \
        .select(*key, F.col("x.p").alias(f"{out}_pos"), F.col("x.wh").alias("wh"),
                F.col("x.s").alias(f"{out}_slots"), F.col("x.plain").alias(f"{out}_plain"),
                F.col("x.same").alias(f"{out}_same"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
               text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
               broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """One row per document (id and text hash) and item that it holds: doc_id, text_hash,
    item_id, n_matched, n_windows, coverage, first_word, verbatim.

    coverage: distinct item windows found, but for those with a name in conflict on their
    diagonal, over all item windows, at least MIN_COVERAGE. Template windows alone are counted
    if they reach it, or else both kinds; a window of numbers, units and names only is found by
    its own words and by no others. first_word: smallest word at which a matched window starts. verbatim:
    every slot has the benchmark's own value. Null and empty texts, and texts or items under
    five words, have no window and match nothing. Rows equal in id and text count once; items
    equal in id count as one item. Empty tables: no rows."""
    items = benchmark.select(F.col(item_col).alias("item_id"),
                             text_or_empty(item_text).alias("t")).distinct()
    b = windows(items, ["item_id"], F.col("t"), "b")
    n_b = b.count()
    sizes = b.groupBy("item_id").agg(F.countDistinct(
        F.when(~F.col("b_plain"), F.struct("b_pos", "wh"))).alias("n_windows"))
    d = windows(docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("t"))
                .withColumn("h", F.xxhash64("t")), ["doc_id", "h"], F.col("t"), "d")
    hits = d.join(F.broadcast(b) if n_b <= broadcast_windows else b, "wh")
    diag = (F.col("d_pos") - F.col("b_pos")).alias("diag")
    # equal plain words: each slot has the benchmark's own value
    own = F.when(F.col("b_same"), F.col("b_slots")).otherwise(F.col("d_slots"))
    pairs = F.when(F.length("b_slots") > 0, F.arrays_zip(F.split("b_slots", " ").alias("b"),
                                                         F.split(own, " ").alias("d")))
    lines = hits.groupBy("doc_id", "h", "item_id", diag).agg(
        F.collect_set(F.struct("b_pos", (F.col("b_plain") | F.col("d_plain")).alias("plain"), pairs.alias("v"))).alias("hits"))
    names = F.filter(F.array_distinct(F.flatten(F.array_compact(F.col("hits.v")))),
                     lambda x: x["b"].startswith(NAME))
    lines = lines.withColumn("names", names).withColumn("bad", F.transform(F.filter("names", lambda x: F.exists(
        "names", lambda y: (x["b"] == y["b"]) & (x["d"] != y["d"]))), lambda x: x["b"]))
    lines = lines.withColumn("kept", F.filter("hits", lambda x: F.coalesce(F.forall(
        x["v"], lambda y: ~F.array_contains("bad", y["b"])), F.lit(True))))
    lines = lines.withColumn("templates", F.filter("kept", lambda x: ~x["plain"]))

    def totals(hits: str) -> Column:
        own = F.forall(hits, lambda x: F.coalesce(F.forall(x["v"], lambda y: y["b"] == y["d"]), F.lit(True)))
        return F.struct(
            F.size(F.array_distinct(F.flatten(F.collect_list(f"{hits}.b_pos")))).cast("long").alias("n_matched"),
            F.min(F.array_min(f"{hits}.b_pos") + F.col("diag")).cast("long").alias("first_word"),
            F.every(own).alias("verbatim"))
    found = lines.where(F.size("kept") > 0).groupBy("doc_id", "h", "item_id").agg(
        totals("templates").alias("t"), totals("kept").alias("a")).join(sizes, "item_id")
    best = F.when(F.col("t.n_matched") / F.col("n_windows") >= MIN_COVERAGE, F.col("t")).otherwise(F.col("a"))
    found = found.select("doc_id", "h", "item_id", "n_windows", best.alias("x")).select("*", "x.*")
    cover = F.col("n_matched") / F.col("n_windows")
    return found.where(cover >= MIN_COVERAGE).select(
        "doc_id", F.col("h").alias("text_hash"), "item_id", "n_matched", "n_windows",
        F.round(cover, 6).alias("coverage"), "first_word", "verbatim")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""
    leaks = find_leaks(docs, benchmark, id_col, text_col).select("doc_id", "text_hash").distinct()
    rows = packed(docs, id=F.col(id_col), h=F.xxhash64(text_or_empty(text_col)))
    return unpacked(rows.join(leaks, F.col("id").eqNullSafe(F.col("doc_id"))
                              & (F.col("h") == F.col("text_hash")), "left_anti"))


def oracle_sql() -> str:
    """The same pairs in DuckDB SQL, with window strings in place of hashes."""
    units = ", ".join(f"'{u}'" for u in UNITS)

    def side(src: str, key: str, out: str) -> str:
        return f"""
{out}0 AS (SELECT {key} AS k, list_filter(string_split_regex(regexp_replace(regexp_replace(
  coalesce(text, ''), '{NAME_PATTERN}', '\\1{NAME}\\2', 'g'), '{NUMBER_JOIN}', '\\1\\2', 'g'),
  '{NO_WORD}'), lambda x: x <> '') AS w FROM {src}),
{out}1 AS (SELECT k, w, list_transform(w, lambda x: CASE WHEN x[1] = '{NAME}' THEN '<name>'
  WHEN x[1] BETWEEN '0' AND '9' THEN '<number>' WHEN lower(x) IN ({units}) THEN '<unit>'
  ELSE lower(x) END) AS c FROM {out}0),
{out}2 AS (SELECT k, unnest(range(1, len(c) - {WINDOW - 2})) AS i, w, c FROM {out}1 WHERE len(c) >= {WINDOW}),
{out} AS (SELECT DISTINCT k, i, list_aggregate(
  CASE WHEN len(list_filter(c[i:i+{WINDOW - 1}], lambda x: x[1] = '<')) = {WINDOW}
  THEN list_transform(w[i:i+{WINDOW - 1}], lambda x: lower(replace(x, '{NAME}', '')))
  ELSE c[i:i+{WINDOW - 1}] END, 'string_agg', ' ') AS win,
  w[i:i+{WINDOW - 1}] AS w, c[i:i+{WINDOW - 1}] AS c FROM {out}2)"""

    return f"""
WITH {side('benchmark', 'item_id', 'b')},{side('documents', 'doc_id', 'd')},
sizes AS (SELECT k, count(*) AS n FROM b GROUP BY k),
hit AS (SELECT d.k AS doc_id, b.k AS item_id, d.i AS di, b.i AS bi, d.i - b.i AS diag,
  b.w AS bw, d.w AS dw, d.c AS dc FROM d JOIN b USING (win)),
slot AS (SELECT doc_id, item_id, diag, lower(bw[j]) AS bv, lower(dw[j]) AS dv FROM (
  SELECT *, unnest(range(1, {WINDOW + 1})) AS j FROM hit) WHERE dc[j][1] = '<'),
bad AS (SELECT DISTINCT doc_id, item_id, diag FROM slot
  GROUP BY doc_id, item_id, diag, bv HAVING count(DISTINCT dv) > 1),
changed AS (SELECT DISTINCT doc_id, item_id FROM slot ANTI JOIN bad USING (doc_id, item_id, diag)
  WHERE bv <> dv),
found AS (SELECT doc_id, item_id, count(DISTINCT bi) AS n_matched, min(di) - 1 AS first_word
  FROM hit ANTI JOIN bad USING (doc_id, item_id, diag) GROUP BY doc_id, item_id)
SELECT f.doc_id, f.item_id, f.n_matched::BIGINT AS n_matched, sizes.n::BIGINT AS n_windows,
  round(f.n_matched::DOUBLE / sizes.n, 6) AS coverage, f.first_word::BIGINT AS first_word,
  changed.doc_id IS NULL AS verbatim
FROM found f JOIN sizes ON sizes.k = f.item_id
LEFT JOIN changed ON changed.doc_id = f.doc_id AND changed.item_id = f.item_id
WHERE f.n_matched::DOUBLE / sizes.n >= {MIN_COVERAGE}"""

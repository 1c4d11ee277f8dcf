"""Line dedup: lines that several documents hold stay in one of them.

Lines are exploded with their position and normalised, the keys are hashed, and the distinct
documents of each hash are counted with map-side combine. Hashes over the threshold meet the
exploded lines again; what returns to a document are the positions of the lines it loses, so
that texts are moved once, to meet these positions, and are put together from the runs between
them. A line that every document holds is one row of the counts and spreads over the tasks
of the join, which Spark splits where it is skewed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwatch.llm.common import finished, packed, shared_dir, stored, text_or_empty

MIN_DOCS = 2    # documents that hold a line which goes
MIN_CHARS = 10  # code points of its key, at least
STRIPPED = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(STRIPPED)), UPPER, LOWER)


def digest(text: Column) -> Column:
    """128 bits of SHA-256."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def line_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, row_hash (of the text), pos, line_hash: the lines whose keys are long enough."""
    lines = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")) \
        .select("doc_id", digest(F.col("text")).alias("row_hash"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")) \
        .select("doc_id", "row_hash", "pos", line_key(F.col("line")).alias("key"))
    return lines.where(F.length("key") >= min_chars) \
        .select("doc_id", "row_hash", "pos", digest(F.col("key")).alias("line_hash"))


def repeated_lines(index: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """line_hash, keeper: the lines that at least ``min_docs`` documents hold, and the smallest
    doc_id that holds them. Null ids are one document, larger than all others."""
    return index.groupBy("line_hash").agg(
        F.countDistinct("doc_id").alias("ids"), F.max(F.col("doc_id").isNull().cast("int")).alias("no_id"),
        F.min("doc_id").alias("keeper")) \
        .where(F.col("ids") + F.col("no_id") >= min_docs).select("line_hash", "keeper")


def lost_positions(index: DataFrame, repeated: DataFrame) -> DataFrame:
    """doc_id, row_hash, lost (sorted positions): the repeated lines of each document but those
    that it keeps. ``repeated`` is a stored table, so that Spark can split a hot line."""
    return index.join(repeated, "line_hash").where(~F.col("doc_id").eqNullSafe(F.col("keeper"))) \
        .groupBy("doc_id", "row_hash").agg(F.sort_array(F.collect_set("pos")).alias("lost"))


def _kept_lines(docs: DataFrame, folder: str, id_col: str, text_col: str, min_docs: int,
                min_chars: int) -> DataFrame:
    """row (the input row), lines, lost (never null), kept (lines that stay)."""
    index = stored(line_index(docs, id_col, text_col, min_chars), f"{folder}/lines")
    repeated = stored(repeated_lines(index, min_docs), f"{folder}/repeated")
    lost = stored(lost_positions(index, repeated), f"{folder}/lost")
    text = text_or_empty(text_col)
    rows = packed(docs, id=F.col(id_col).cast("long"), h=digest(text), text=text)
    both = rows.join(lost, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("row_hash")), "left") \
        .select("row", F.split("text", "\n", -1).alias("lines"), F.coalesce("lost", F.expr("array()")).alias("lost"))
    edges = F.concat(F.array(F.lit(-1)), "lost", F.array(F.size("lines")))
    runs = F.transform(F.sequence(F.lit(0), F.size("lost")), lambda k: F.slice(
        "lines", F.get("edges", k) + 2, F.get("edges", k + 1) - F.get("edges", k) - 1))
    return both.withColumn("edges", edges).withColumn("kept", F.flatten(runs)) \
        .select("row", "lines", "lost", "kept")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                min_chars: int = MIN_CHARS) -> DataFrame:
    """The rows with all their columns, the text without the lines that go.

    A line goes if its key (white space stripped, A-Z lowered) has ``min_chars`` code points and
    ``min_docs`` distinct doc_ids hold it, unless this row has the smallest of them. Null or empty
    text: one empty line, which stays; a null text becomes empty. Null ids together are one
    document, larger than all others. Rows with equal ids are one document: what the smallest id
    holds stays in all its rows, repeats within a row too. Texts of any length are read whole.
    Columns of other names, clashing ones too, come back as they were. Empty table: no rows."""
    rows = _kept_lines(docs, shared_dir(docs.sparkSession), id_col, text_col, min_docs, min_chars)
    return rows.select(*[F.array_join("kept", "\n").alias(c) if c == text_col else F.col("row")[c].alias(c)
                         for c in docs.columns])


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per input row: doc_id, n_lines (before), n_dropped, kept_sha256 (of the text that
    stays). Cases as in ``dedup_lines``; if no line stays, the text is empty."""
    spark = docs.sparkSession
    folder = shared_dir(spark)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = _kept_lines(slim, folder, "doc_id", "text", min_docs, min_chars)
    return finished(rows.select(F.col("row.doc_id").alias("doc_id"), F.size("lines").cast("long").alias("n_lines"),
                                F.size("lost").cast("long").alias("n_dropped"),
                                F.sha2(F.array_join("kept", "\n"), 256).alias("kept_sha256")), folder)


def oracle_sql() -> str:
    """DuckDB SQL of ``line_report`` over ``documents``."""
    white = " || ".join(f"chr({ord(c)})" for c in STRIPPED)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
s AS (SELECT doc_id, r, string_split(t, chr(10)) AS lines FROM d),
l AS (SELECT doc_id, r, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM s),
k AS (SELECT *, translate(trim(line, {white}), '{UPPER}', '{LOWER}') AS key FROM l),
g AS (SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key
  HAVING count(DISTINCT doc_id) + max((doc_id IS NULL)::INT) >= {MIN_DOCS}),
m AS (SELECT k.*, g.key IS NOT NULL AND k.doc_id IS DISTINCT FROM g.keeper AS gone FROM k LEFT JOIN g USING (key))
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count_if(gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r"""

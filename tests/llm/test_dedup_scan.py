"""Exact dedup, license scan, decontamination: edge cases and brute force."""

import re
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tabwatch.llm import decontam, exact_dedup, license_scan
from tabwatch.llm import queries as Q

SCHEMA = "doc_id long, text string, kept string, h int, __id int"
ROWS = [(1, "same text", "x", 1, 1), (2, "same text", "y", 2, 2), (3, None, "z", 3, 3), (4, "", "z", 4, 4),
        (None, "same text", "n", 5, 5), (None, "only null", "n", 6, 6), (7, "Same text", "c", 7, 7),
        (8, "twice", "t", 8, 8), (8, "twice", "t", 8, 8), (9, "long " * 40000, "l", 9, 9)]


def frame(spark, rows=ROWS, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def expected_dedup(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    out, seen = [], set()
    for r in rows:
        ids = groups[r[1] or ""]
        keep = max((i for i in ids if i is not None), default=None)
        kept = r[0] == keep and (r[1] or "") not in seen
        if kept:
            seen.add(r[1] or "")
        out.append((r[0], keep, len(ids), kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [64 << 20, 300])
def test_exact_dedup_edges(spark, limit):
    got = exact_dedup.dedup_report(frame(spark), table_bytes=limit).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got), key=repr) == expected_dedup(ROWS)
    kept = exact_dedup.dedup(frame(spark), table_bytes=limit)
    assert kept.columns == ["doc_id", "text", "kept", "h", "__id"]
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([2, 4, None, 7, 8, 9], key=repr)


def test_exact_dedup_spills_to_further_levels(spark):
    rows = [(i, f"text number {i % 500} " * 5) for i in range(2000)]
    got = exact_dedup.dedup_report(spark.createDataFrame(rows, "doc_id long, text string"), table_bytes=2000)
    assert got.count() == 2000 and got.where("kept").count() == 500
    assert got.where("group_size <> 4").count() == 0


def test_open_table_compares_whole_texts():
    t = exact_dedup.OpenTable()
    for k in range(3000):
        t.add(k % 7, "", f"t{k}", k, 1, 1)  # colliding hashes
    t.add(0, "", "t0", 99, 1, 1)
    assert len(t.entries) == 3000 and t.entries[0][3:5] == [99, 2]
    assert len(t.take(lambda h: h == 0)) + len(t.entries) == 3000


def test_empty_tables(spark):
    e = frame(spark, [])
    assert exact_dedup.dedup_report(e).count() == 0
    assert exact_dedup.dedup(e).count() == 0
    assert license_scan.scan_licenses(e).count() == 0
    b = spark.createDataFrame([], "item_id long, text string")
    assert decontam.find_leaks(frame(spark), b).count() == 0
    assert decontam.find_leaks(e, b).count() == 0
    assert decontam.drop_leaks(frame(spark), b).count() == len(ROWS)


LICENSE = [
    (1, "Released under the MIT License."), (2, "under the mit licence"), (3, None), (4, ""),
    (5, "Apache License, Version 2.0 and CC-BY/NC and cc by nc"), (6, "under the MIT\nLicense under the mit license"),
    (7, "GNU General Public License (GPL), version 3"), (8, "ünder the mit license under thé MIT license"),
    (None, "cc by nc"), (9, "cc by nc"), (9, "cc by nc"),
    (10, "Permission is hereby granted, free of charge, to any other person obtaining a copy of this software and "
         "associated documentation files (the Software), to deal in the Software without restriction"),
    (11, "x " * 60000 + "under the mit license")]


def test_license_scan_against_sql(spark):
    df = spark.createDataFrame(LICENSE, "doc_id long, text string").withColumn("label", F.lit("clash"))
    got = license_scan.scan_licenses(df)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", LICENSE)
    rel = con.execute(license_scan.oracle_sql())
    cols = [d[0] for d in rel.description]
    want = rel.fetchall()
    assert sorted(map(repr, (tuple(r) for r in got.select(*cols).collect()))) == sorted(map(repr, want))
    by = {r.doc_id: r for r in got.collect() if r.doc_id not in (None, 9)}
    assert by[6].n_base == 2 and (by[6].first_word, by[6].last_word) == (0, 4)
    assert by[5].base_labels == "apache-2,cc-by-nc" and by[5].n_base == 3
    assert by[10].labels == "mit" and by[10].base_labels == "" and by[10].score < 1
    assert by[7].labels == "" and by[3].n_words == 0 and by[11].first_word == 60000


def words_of(text):
    return re.findall(r"[a-z0-9]+", text.lower())


BENCH = [(1, "Today Alice bought 12 apples and 7 pears. How many fruits did Alice carry home after walking 3 km?"),
         (2, "short one"), (3, None), (4, "the quick brown fox jumps over the lazy dog and runs away")]


def test_decontamination_finds_reparameterised_questions(spark):
    docs = [
        (1, "intro text. " + BENCH[0][1]),
        (2, "so we said that " + BENCH[0][1].replace("Alice", "Robert").replace("12", "40").replace("7", "5")),
        (3, "x " + BENCH[0][1].replace("Alice", "Robert", 1)),   # Alice is now two people
        (4, BENCH[3][1].upper()), (5, "the quick brown fox jumps over a cat"), (6, None), (7, ""),
        (8, "short one"), (9, "word " * 30000 + BENCH[3][1]), (9, "word " * 30000 + BENCH[3][1]),
        (None, BENCH[3][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(1))
    b = spark.createDataFrame(BENCH, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = {(r.doc_id, r.item_id): r for r in decontam.find_leaks(d, b).collect()}
    assert got[1, 1].verbatim and not got[2, 1].verbatim
    assert set(got) == {(1, 1), (2, 1), (4, 4), (9, 4), (None, 4)}
    left = decontam.drop_leaks(d, b)
    assert left.columns == d.columns and sorted(r.doc_id for r in left.collect()) == [3, 5, 6, 7, 8]
    shuffled = decontam.find_leaks(d, b, broadcast_windows=0).collect()
    assert {(r.doc_id, r.item_id) for r in shuffled} == set(got)


def test_decontamination_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    docs = con.execute(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    items = con.execute(f"SELECT item_id, text FROM '{sf}/benchmark.parquet'").fetchall()
    want = set()
    for i, t in items:
        w = re.findall(r"[^\W_]+", t.lower())
        grams = {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
        for d, text in docs:
            v = re.findall(r"[^\W_]+", (text or "").lower())
            have = {tuple(v[k:k + 5]) for k in range(len(v) - 4)}
            if grams and len(grams & have) >= 0.75 * len(grams):
                want.add((d, i))
    got = {(r.doc_id, r.item_id) for r in Q.op6_decontamination(spark, sf).collect()}
    assert got == want and want


REPEATED = ("the farmer put 2 apples and 2 pears into one large basket and then walked along the river until the "
            "sun went down behind the old mill near the town")
NAMED = ("when the teacher asked Alice about the long river that runs past the old mill she said that Robert "
         "knew the answer and that Maria had seen the boat")


@pytest.mark.parametrize("item,copy", [
    (REPEATED, REPEATED.replace("2 pears", "5 pears")),
    (REPEATED, REPEATED.replace("2 apples", "3 apples").replace("2 pears", "5 pears")),
    (NAMED, NAMED.lower()), (NAMED, NAMED.replace(" Alice", "\nAlice").replace(" Robert", "\nRobert").replace(" Maria", "\nMaria")),
    ("What is the capital of France", "Question 5 What is the capital of France")])
def test_decontamination_keeps_windows_beside_a_conflict(spark, item, copy):
    d = spark.createDataFrame([(1, copy), (2, "nothing of the kind is in this text")], "doc_id long, text string")
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = decontam.find_leaks(d, b).collect()
    assert [(r.doc_id, r.n_matched) for r in got] == [(1, got[0].n_windows)]


def test_decontamination_takes_other_numbers_for_no_evidence(spark):
    """Windows of placeholders only are found by their own values."""
    table = " ".join(str(1000 + k) for k in range(80))
    worded = "Count the boxes on the shelf and add 11 22 33 44 55 66 to what the clerk wrote down last time"
    docs = [(1, " ".join(str(50_000 + 7 * k) for k in range(200))), (2, "see here: " + table + " end"),
            (3, "Now. " + worded), (4, worded.replace("11 22 33 44 55 66", "9 8 7 6 5 4")),
            (5, "11 22 33 44 55 66"), (6, " ".join(reversed(table.split()))), (7, "and Then Ann Bob Cid Dan Eve Fay came"),
            (8, "then ann bob cid dan eve fay")]
    items = [(1, table), (2, worded), (3, "we saw Ann Bob Cid Dan Eve Fay")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontam.find_leaks(d, b).collect()}
    assert {(2, 1), (3, 2)} <= set(got) and not {1, 5, 6} & {k[0] for k in got}
    assert got[2, 1].n_matched == got[2, 1].n_windows == 76 and got[2, 1].verbatim
    assert got[3, 2].n_matched == got[3, 2].n_windows and got[3, 2].verbatim
    # two windows hold numbers only: the others of a question with other numbers still count
    assert got[4, 2].n_matched == got[4, 2].n_windows - 2 and not got[4, 2].verbatim
    kept = {r.doc_id for r in decontam.drop_leaks(d, b).collect()}
    assert {1, 5, 6} <= kept and not {2, 3, 4} & kept


def test_whole_license_texts(spark):
    """Whole texts are found in comment frames, with a word changed and inside other text; halves are not."""
    from tabwatch.llm.license_texts import TEXTS

    rows, want = [], {}
    for k, (label, text) in enumerate(TEXTS):
        framed = "\n".join(f" * {line}" for line in text.split("\n"))
        rows += [(10 * k, f"Copyright 2020 Someone\n{framed}\n * end"), (10 * k + 1, "x y z " * 30 + text.upper() + " q" * 9),
                 (10 * k + 2, re.sub(r"(?i)\b(software|license)\b", "product", text, count=1)),
                 (10 * k + 3, " ".join(text.split()[:len(text.split()) // 2][-20:]))]
        want.update({10 * k: label, 10 * k + 1: label, 10 * k + 2: label})
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan_licenses(df).collect()}
    for k, label in want.items():
        assert label in got[k].labels.split(","), (k, label, got[k])
        assert k % 10 == 2 or got[k].score == 1
    assert got[10 * [x for x, _ in TEXTS].index("zlib") + 3].labels == ""
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    rel = con.execute(license_scan.oracle_sql())
    cols = [d[0] for d in rel.description]
    assert sorted(map(repr, ([r[c] for c in cols] for r in got.values()))) == sorted(repr(list(r)) for r in rel.fetchall())

"""Collocations, line dedup and centroid clustering: brute force and edge cases."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest

from tabwatch.llm import centroids, collocations, line_dedup
from tabwatch.llm.common import shared_dir

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- collocations

def brute_collocations(rows, top=2000, least=10, cover=50):
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(ASCII_LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(ws)
            for n in (1, 2, 3):
                f[lang].update(tuple(ws[i:i + n]) for i in range(len(ws) - n + 1))
    out = []
    for lang, c in f.items():
        cands = [p for p, a in c.items() if len(p) > 1 and a >= least]
        rows = []
        for p in cands:
            a = c[p]
            if any(100 * c[q] >= cover * a for q in cands if len(q) > len(p) and any(
                    q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))):
                continue
            s, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-s, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def phrase_rows(seed, n=300):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["Été", "x,y", "tab\tbed", "Big", "big"]
    out = []
    for i in range(n):
        ws = []
        while len(ws) < 30:
            ws += r.choice([["new", "York", "city"], ["alpha", "beta"], ["a", "rose", "is", "a", "rose"],
                            [r.choice(words)], [r.choice(words[:6])], [r.choice(words) + r.choice(".;!\n\r")]])
        out.append((r.choice(["en", "en", "en", "fr", None, "und", ""]), " ".join(ws)))
    return out + [("en", None), ("en", ""), (None, None), ("de", "nur ein paar"), ("en", " \t. ,\n")] + out[:40]


def found(df):
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@pytest.mark.parametrize("top, first", [(2000, 16000), (15, 5), (3, 1)])
def test_collocations_equal_brute_force(spark, top, first):
    rows = phrase_rows(top)
    d = spark.createDataFrame([(i, t, x, "n") for i, (x, t) in enumerate(rows)], "n int, text string, lang string, w1 string")
    got = collocations.collocations(d.repartition(5), top=top, first=first)
    assert found(got) == brute_collocations(rows, top)
    assert dict(got.dtypes)["rank"] == "bigint"


def test_collocations_of_a_hot_pair_and_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE", 1000)
    rows = [("en", "very common " * 5000 + "end. " + "rare pair; " * 12), ("en", "x" * 5000), ("en", "of the. " * 900)]
    d = spark.createDataFrame([(x, t) for x, t in rows], "lang string, text string")
    assert found(collocations.collocations(d)) == brute_collocations(rows)


def test_collocations_empty(spark):
    for rows in ([], [("en", None)], [("en", "few words only")]):
        assert collocations.collocations(spark.createDataFrame(rows, "lang string, text string")).collect() == []


def test_score_passes_64_bits(spark):
    a, l, r = 3 * 10**12, 4 * 10**12, 5 * 10**12
    got = spark.createDataFrame([(a, l, r)], "a long, l long, r long").select(
        collocations._ratio(["a", "a"], ["l", "r"]).alias("s")).first().s
    assert got == 1000000 * a * a // (l * r)


def test_slices_keep_whole_texts():
    text = b"one two. three four\nfive" * 50
    old, collocations.SLICE = collocations.SLICE, 64
    try:
        assert b"".join(collocations._pieces(text)) == text
        assert all(len(p) <= 64 for p in collocations._pieces(text))
    finally:
        collocations.SLICE = old


# ------------------------------------------------------------------ line dedup

LINES = [(1, "Shared line here\nown line of one\nshort\n", "a", 1), (2, "  shared LINE here\t\nshort\nshared line here", "b", 2),
         (3, None, "c", 3), (4, "", "d", 4), (5, "shared line here", "e", 5), (None, "shared line here\nwithout any id", "f", 6),
         (None, "without any id", "g", 7), (6, "without any id\nonly here twice\nonly here twice", "h", 8),
         (7, "row of seven stays\nx", "i", 9), (7, "row of seven stays\nx", "i", 9), (8, "row of seven stays", "j", 10),
         (9, "ééééééééé\nÉéééééééééé", "k", 11), (10, "ééééééééé\nÉéééééééééé\n nbsp stays ", "l", 12),
         (11, "\x0b\x0cRow Of Seven Stays\r", "m", 13), (12, "\n".join(f"line number {i % 7000}" for i in range(20000)), "n", 14),
         (13, "\n".join(f"Line Number {i}" for i in range(0, 9000, 2)), "o", 15)]
LINE_SCHEMA = "doc_id long, text string, lines string, lost int"


def brute_lines(rows, min_docs=2, min_chars=10):
    keys = lambda t: [x.strip(" \t\n\x0b\x0c\r").translate(ASCII_LOWER) for x in (t or "").split("\n")]
    holders = defaultdict(set)
    for i, t, *_ in rows:
        for k in keys(t):
            if len(k) >= min_chars:
                holders[k].add(i)
    least = {k: min(h, key=lambda i: (i is None, i)) for k, h in holders.items() if len(h) >= min_docs}
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x, k in zip(lines, keys(t)) if k not in least or least[k] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("min_docs", [2, 3])
def test_lines_equal_brute_force(spark, min_docs):
    d = spark.createDataFrame(LINES, LINE_SCHEMA).repartition(4)
    want = brute_lines(LINES, min_docs)
    got = line_dedup.line_report(d, min_docs=min_docs).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got), key=repr) == sorted(
        ((i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in want), key=repr)
    kept = line_dedup.dedup_lines(d, min_docs=min_docs)
    assert kept.columns == ["doc_id", "text", "lines", "lost"]
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == sorted(
        ((w[0], w[3], r[2], r[3]) for w, r in zip(want, LINES)), key=repr)


def test_lines_of_one_hot_line(spark):
    rows = [(i, f"the very same footer line\nunique to document {i}") for i in range(500)]
    got = line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert {r.doc_id: r.n_dropped for r in got} == {i: int(i > 0) for i in range(500)}


def test_lines_empty_table(spark):
    e = spark.createDataFrame([], LINE_SCHEMA)
    assert line_dedup.line_report(e).count() == 0
    assert line_dedup.dedup_lines(e).collect() == []


# ------------------------------------------------------------------- centroids

def brute_clusters(rows, clusters, rounds):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64
            and all(x is not None and math.isfinite(x) for x in v)]
    text = lambda i: "" if i is None else str(i)
    cs = [v for i, v in sorted(kept, key=lambda r: (hashlib.sha256(f"2:{text(r[0])}".encode()).hexdigest(), r[1]))[:clusters]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(cs))
    for _ in range(rounds):
        of = defaultdict(list)
        for _, v in kept:
            of[near(v)[1]].append(v)
        cs = [[sum(x) // len(of[k]) for x in zip(*of[k])] if k in of else c for k, c in enumerate(cs)]
    out = [(i, *near(v)[::-1]) for i, v in kept]
    by = Counter()
    for _, k, d in out:
        by[k] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return sorted(((i, k, d, by[k], sum(by.values()), sha[k]) for i, k, d in out), key=repr)


def vectors(n=300, scale=1.0, seed=3):
    r = np.random.default_rng(seed)
    rows = [(i, (r.normal(0, 0.2, 64) * scale).tolist()) for i in range(n)]
    same = rows[5][1]
    return rows + [(900 + i, same) for i in range(60)] + [(7, rows[7][1]), (None, rows[8][1]), (2000, None), (2001, []),
        (2002, [0.1] * 63), (2003, [0.1] * 65), (2004, [None] + [0.1] * 63), (2005, [math.nan] + [0.1] * 63),
        (2006, [math.inf] + [0.0] * 63), (2007, [-math.inf] + [0.0] * 63), (2008, [0.0] * 64)]


@pytest.mark.parametrize("scale", [1.0, 3000.0, 0.001])
def test_clusters_equal_brute_force(spark, scale):
    rows = vectors(scale=scale)
    d = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, cluster int")
    got = centroids.cluster_report(d.repartition(5))
    assert sorted((tuple(r) for r in got.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                                                "centroid_sha256").collect()), key=repr) == brute_clusters(rows, 40, 5)


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = vectors()[:3]
    schema = "vec_id long, embedding array<float>"
    got = centroids.cluster_report(spark.createDataFrame(rows, schema))
    assert got.count() == 3 and {r.distance for r in got.collect()} == {0}
    for empty in ([], [(1, None)], [(1, [math.nan] * 64)]):
        assert centroids.cluster_report(spark.createDataFrame(empty, schema)).collect() == []


def test_components_without_room_raise(spark):
    d = spark.createDataFrame([(1, [2.0 ** 20] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="fit"):
        centroids.cluster(d, shared_dir(spark))


def test_plane_products_are_exact():
    r = np.random.default_rng(1)
    for bits in (1, 2, 9, 28):
        v = r.integers(-(1 << bits - 1) if bits > 1 else 0, 1 << bits - 1 if bits > 1 else 1, (50, 64))
        p = centroids.to_planes(v, bits + 1)
        assert (centroids.from_planes(p) == v).all()
        assert (centroids.dots(p, p[3]) == v @ v[3]).all()
        assert (centroids.squares(p) == (v * v).sum(1)).all()


def test_oracles_agree_on_edge_cases(spark, tmp_path):
    con = duckdb.connect()
    lines = pd.DataFrame([r[:2] for r in LINES], columns=["doc_id", "text"]).astype({"doc_id": "Int64"})
    con.register("documents", lines)
    want = [(i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in brute_lines(LINES)]
    got = con.execute(line_dedup.oracle_sql()).fetchall()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    rows = phrase_rows(9)
    con.unregister("documents")
    con.register("documents", pd.DataFrame(rows, columns=["lang", "text"]))
    assert sorted(con.execute(collocations.oracle_sql()).fetchall()) == brute_collocations(rows)

"""MinHash near dedup against brute force."""

import random
import re

import numpy as np
import pytest

from tabwatch.llm import minhash
from tabwatch.plans.tables import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    n = min(5, len(w))
    return {tuple(w[k:k + 5]) for k in range(len(w) - n + 1)} if n else set()


def brute(rows):
    """[(doc_id, n_shingles, component_id)] by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                top[find(i)] = find(j)
    least = {}
    for k, (d, _) in enumerate(rows):
        if d is not None:
            least[find(k)] = min(d, least.get(find(k), d))
    return sorted(((d, len(s), least.get(find(k)) if s else d) for k, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def got(df):
    rows = minhash.near_duplicates(df).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr)


def test_whole_table_against_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    assert got(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_edges_and_chains(spark):
    r = random.Random(3)
    base = [f"w{r.randrange(10 ** 6)}" for _ in range(200)]
    rows, words = [], list(base)
    for k in range(12):  # each differs from the one before in few words, from the first in many
        rows.append((100 - k, " ".join(words)))
        words[r.randrange(200)] = f"new{k}"
        words[r.randrange(200)] = f"also{k}"
    rows += [(1, None), (2, ""), (3, " \t\n"), (4, "two words"), (5, "Two  WORDS"), (6, "ÉTÉ two"), (7, "été two"),
             (None, "two words"), (None, "alone here without id"), (8, "a b c d e"), (8, "a b c d e"), (8, "other text of id 8"),
             (9, "tick " * 30000), (10, "tick " * 20000), (11, "x" * 3_000_000), (12, "x" * 3_000_000 + "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS h", "'a' AS cid", "2 AS node")
    assert got(df) == brute(rows)
    kept = minhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    ids = [x.doc_id for x in kept.collect()]
    assert {1, 2, 3, 4, 6, 7, 8, 9, 11, 12} <= set(ids) and not {5, 10} & set(ids)
    assert got(df.limit(0)) == [] and minhash.drop_near_duplicates(df.limit(0)).count() == 0


def test_large_group_and_shared_passage(spark):
    r = random.Random(8)
    word = lambda: f"v{r.randrange(10 ** 6)}"
    base, passage = [word() for _ in range(150)], [word() for _ in range(60)]
    rows = [(k, " ".join(w if r.random() > 0.004 else word() for w in base)) for k in range(150)]
    rows += [(1000 + k, " ".join([*passage, *[word() for _ in range(r.randrange(5, 90))]])) for k in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == brute(rows)


def test_blocks_of_a_list_lose_no_pair(spark, monkeypatch):
    """Lists of many blocks, and no help from the leaders: the same components."""
    r = random.Random(21)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for k in range(60):
        w = list(base)
        for _ in range(r.randrange(1, 9)):
            w[r.randrange(120)] = f"x{r.randrange(10 ** 6)}"
        rows.append((k, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(minhash, "BLOCK", 7)
    assert got(df) == brute(rows)


def test_word_hashes_do_not_depend_on_slices(monkeypatch):
    data = (" ".join(f"word{k}" for k in range(5000)) + "  " + "z" * 9000 + " end").encode()
    whole = minhash.word_hashes(data)
    monkeypatch.setattr(minhash, "SLICE", 1000)
    parts = minhash.word_hashes(data)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all() and len(whole[0]) == 5002


def test_signatures_estimate_similarity():
    a = np.unique(np.random.default_rng(1).integers(0, 1 << 62, 4000).astype(np.uint64))
    met = (minhash.signature(a[:3000])[0] == minhash.signature(a[1000:])[0]).mean()
    assert 0.3 < met < 0.7


@pytest.mark.parametrize("n", [1, 2, 40])
def test_components_of_a_path(spark, tmp_path, n):
    e = spark.createDataFrame([(k, k + 1) for k in range(n)] + [(100, 101)], "a long, b long")
    out = {r.node: r.label for r in minhash.components(e, f"file://{tmp_path}").collect()}
    assert out == {**{k: 0 for k in range(n + 1)}, 100: 100, 101: 100}


def test_structured_words_stay_apart(spark):
    """A Thue-Morse word and its complement are equal under every polynomial modulo 2 ** 64."""
    a = "".join("ab"[bin(k).count("1") % 2] for k in range(4096))
    b = a.translate(str.maketrans("ab", "ba"))
    rows = [(1, a), (2, b), (3, a.upper())]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows) == [(1, 1, 1), (2, 1, 2), (3, 1, 1)]


def test_near_misses_of_one_base_are_confirmed_in_cells(spark, monkeypatch):
    """Many copies at similarities of 0.55 to 0.8: most pairs pass the count and are no links."""
    r = random.Random(5)
    base = [f"b{k}" for k in range(160)]
    rows = []
    for k in range(140):
        w = list(base)
        for _ in range(r.randrange(3, 9)):
            w[r.randrange(160)] = f"x{r.randrange(10 ** 6)}"
        rows.append((k, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert got(df) == want and 1 < len({c for _, _, c in want}) < 140
    monkeypatch.setattr(minhash, "HELD", 1000)  # sets dealt to many cells, rows of few shingles
    monkeypatch.setattr(minhash, "CHUNK", 50)
    assert got(df) == want


def test_forest_joins_each_component_once():
    own = lambda *x: np.array(x, np.uint64)
    bits = lambda *x: np.packbits(np.isin(np.arange(4), x)).tobytes()
    members = [(0, b"a", bits(1, 2, 3), own(1, 2, 3, 4)), (1, b"b", bits(2, 3), own(1, 2, 3, 4, 5)),
               (2, b"c", bits(3), own(2, 3, 4)), (2, b"d", bits(), own(7, 8, 9))]
    assert list(minhash._forest(members)) == [(b"a", b"b"), (b"a", b"c")]


def test_a_large_group_with_few_apart_is_sent_once(spark, monkeypatch):
    """A list of 600 classes, 560 of one component: its rows grow with the list, not with its square."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(minhash, "BLOCK", 50)
    cid = F.lpad(F.col("id").cast("string"), 4, "0").cast("binary")
    posts = spark.range(600).select(F.lit(7).cast("long").alias("token"), F.lit(0).alias("k"), cid.alias("cid"), F.lit(1).cast("long").alias("mask"))
    label = spark.range(560).select(cid.alias("node"), F.lit(b"0000").alias("label"))
    classes = posts.select("cid", F.lit(9).cast("long").alias("n_shingles"), F.array_repeat(F.lit(1), 64).alias("sig"),
                           F.lit(b"0" * 128).alias("more"))
    rows = minhash.dealt_apart(posts, label, classes)
    assert rows.count() == 600
    monkeypatch.setattr(minhash, "BLOCK", 10)  # and every pair that is apart meets in one cell
    monkeypatch.setattr(minhash, "CHAIN", 100)
    cells = {}
    for r in minhash.dealt_apart(posts, label, classes).collect():
        cells.setdefault((r.i, r.j), ([], []))[r.late].append(int(r.cid))
    met = []
    for (_, j), (block, late) in cells.items():
        met += [frozenset((a, b)) for a in block for b in late]
        met += [frozenset((a, b)) for a in block for b in block if a < b] if j == 0 else []
    assert len(met) == len(set(met)) and set(met) == {frozenset((a, b)) for a in range(560, 600) for b in range(a)}

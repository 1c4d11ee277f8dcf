"""Toxicity and the whole pipeline."""

import math
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from tabwatch.llm import toxicity as T
from tabwatch.plans.tables import table
from tests.llm.test_minhash import brute

WORDS = "the quick brown idiot fox moron jumps over lazy dogs and clever people say hello to loser friends".split()


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(4)
    docs, labels = [], []
    clean = [w for w in WORDS if w not in ("idiot", "moron", "loser")]
    for k in range(400):
        toxic = k % 4 == 0
        w = [r.choice(clean) for _ in range(40)]
        if toxic:
            w[r.randrange(40)] = r.choice(["idiot", "moron", "loser"])
        docs.append((k, " ".join(w)))
        labels.append((k, 1, int(toxic)))
    docs += [(1000, None), (1001, ""), (None, "you idiot"), (1002, "what an 1d10t you are"), (1003, "what l o s e r here"),
             (1004, "moooorooon"), (1005, "brown dogs " * 20000 + "m0r0n"), (1006, "2001 was 100% fine"), (0, docs[0][1])]
    labels += [(None, 0, 1), (5, 1, None), (6, None, 0)]
    return (spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "0 AS score", "1 AS toxic"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_scores(spark, corpus):
    docs, labels = corpus
    out = T.score_documents(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    for r in out:
        assert r.held_out == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 5 == 0)
        if r.doc_id is not None and r.doc_id < 400:
            assert r.predicted == (r.doc_id % 4 == 0)
    by = {r.doc_id: r.predicted for r in out}
    assert [by[k] for k in (1000, 1001, 1006)] == [0, 0, 0]
    assert [by[k] for k in (None, 1002, 1003, 1004, 1005)] == [1] * 5
    kept = T.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in out)


def test_without_labels_nothing_is_toxic(spark, corpus):
    docs, labels = corpus
    out = T.score_documents(docs, labels.limit(0))
    assert out.where("predicted = 1").count() == 0
    assert T.score_documents(docs.limit(0), labels).count() == 0


def test_drop_toxic_keeps_rows_as_they_were(spark, corpus):
    docs, labels = corpus
    odd = docs.selectExpr("*", "'x' AS row", "doc_id AS id", "2 AS h", "'t' AS toxic_id", "1L AS toxic_h")
    bad = {(r.doc_id, r.score) for r in T.score_documents(docs, labels).where("predicted = 1").collect()}
    kept = T.drop_toxic(odd, labels)
    assert kept.columns == odd.columns
    assert sorted(map(repr, kept.collect())) == sorted(
        repr(r) for r in odd.collect() if (r.doc_id not in {i for i, _ in bad}))
    assert T.drop_toxic(odd.limit(0), labels).collect() == []
    assert T.drop_toxic(odd, labels.limit(0)).count() == odd.count()


def test_viterbi_is_the_best_of_all_readings():
    g = np.random.default_rng(1)
    cost = g.gamma(1.0, 2.0, (T.LETTERS,) * 3)

    def readings(span, k=0):
        if k == len(span):
            yield "", 0.0
            return
        ch = span[k]
        arcs = [(x, T.SWAP) for x in T.LEET[ch]] + [(ch, T.KEEP)] if ch in T.LEET else \
            [(ch, 0.0)] if ch.isalpha() else [("", 0.0), (" ", T.KEEP_GAP)]
        if k and ch.isalpha() and span[k - 1] == ch:
            arcs = [*arcs, ("", T.DROP_REPEAT)]
        for rest, c in readings(span, k + 1):
            for x, c1 in arcs:
                yield x + rest, c + c1

    for span in ("1d10t", "a.b-c", "$tuuup1d", "ééé0", "m o r 0 n"):
        def total(out, channel):
            s = [0, 0, *map(T._class, out), 0]
            return channel + sum(float(cost[s[k], s[k + 1], s[k + 2]]) for k in range(len(s) - 2))
        best = min(total(o, c) for o, c in readings(span))
        found = T.decode_span(span, cost)
        channel = min(c for o, c in readings(span) if o == found)
        assert math.isclose(total(found, channel), best)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = table(spark, sf, "labels")
    out = T.score_documents(table(spark, sf, "documents"), labels).where("held_out") \
        .join(labels, "doc_id").select("toxic", "score").collect()
    pos, neg = [r.score for r in out if r.toxic == 1], [r.score for r in out if r.toxic == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    assert auc > 0.8 and sum(s >= 0.5 for s in neg) <= 0.02 * len(neg)


def test_pipeline_stage_by_stage(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    names, steps = [], []
    for name, f in corpus_pipeline.STAGES:
        out = f(spark, docs, sf)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        names.append(name)
        steps.append(docs)
    assert names == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "sentencepiece"]
    whole = table(spark, sf, "documents")
    for d in steps[:-1]:
        assert d.columns == whole.columns
    rows = [{r.doc_id: r.text for r in d.select("doc_id", "text").collect()} for d in steps[:-1]]
    model = T.fit(whole, table(spark, sf, "labels"))
    everything = {r.doc_id: r.text for r in whole.collect()}
    assert set(rows[0]) == {d for d, t in everything.items() if model.score(t or "") < 0.5}
    last = {}
    for d, t in sorted(rows[0].items()):
        last[t] = d
    assert set(rows[1]) == set(last.values())
    assert set(rows[2]) == {d for d, _, c in brute(list(rows[1].items())) if d == c}
    from tabwatch.llm import decontam
    leaks = {r.doc_id for r in decontam.find_leaks(steps[2], table(spark, sf, "benchmark")).collect()}
    assert set(rows[3]) == set(rows[2]) - leaks and leaks
    final = steps[-1].collect()
    assert {r.doc_id for r in final} == set(rows[3]) and all(r.lossless and r.n_pieces == len(r.ids) for r in final)
    assert corpus_pipeline.run(spark, sf).count() == len(final)


def test_short_trailing_spelled_and_doubled_forms(spark):
    r = random.Random(9)
    clean = [w for w in WORDS if w not in ("idiot", "moron", "loser")] + ["page", "good", "letter"]
    rows = []
    for k in range(400):
        w = [r.choice(clean) for _ in range(30)]
        if k % 4 == 0:
            w[r.randrange(30)] = ("hate", "scum", "idiot", "ass", "die")[k // 4 % 5]
        rows.append((k, " ".join(w)))
    forms = ["hat3", "a$$", "scum8", "idio7", "idi07", "d i e", "i d  i . o t", "idiioott", "hhate", "idiot!"]
    fine = ["page2", "good letter", "hello!", "clever 2001", "page 1 2 3", "page4"]
    rows += [(1000 + k, f"the quick brown {f} jumps over") for k, f in enumerate([*forms, *fine])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(400)], "doc_id long, quality int, toxic int")
    model = T.fit(docs, labels)
    assert [f for k, f in enumerate(forms) if model.score(rows[400 + k][1]) < 0.5] == []
    assert [t for _, t in rows[400 + len(forms):] if model.score(t) >= 0.5] == []


def test_stages_as_a_chain_on_odd_rows(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows, a null id and clashing columns through all stages."""
    sf = "/root/testdata/sf0.001"
    words = " ".join(f"w{k}x" for k in range(30000))
    odd = [(900001, None), (900002, ""), (900003, words), (900003, words), (900004, "one two"), (None, "no id but some words"),
           (900005, " "), (900006, words + " end")]
    docs = spark.createDataFrame(odd, "doc_id long, text string").selectExpr(
        "doc_id", "text", "CAST(NULL AS string) AS lang", "'s' AS source", "1L AS n_chars", "'r' AS row", "2 AS h", "3 AS id",
        "'k' AS keep_id", "'z' AS sha", "4L AS text_hash", "5 AS kept")
    empty, want = docs.limit(0), docs
    for k, (name, f) in enumerate(corpus_pipeline.STAGES):
        out = f(spark, want, sf)
        out.write.parquet(f"{tmp_path}/{name}")
        want = spark.read.parquet(f"{tmp_path}/{name}")
        assert f(spark, empty, sf).count() == 0
        if k < 4:
            assert want.columns == docs.columns
            assert {tuple(r)[2:] for r in want.collect()} == {(None, "s", 1, "r", 2, 3, "k", "z", 4, 5)}
    got = {r.doc_id: r for r in want.collect()}
    assert set(got) == {None, 900002, 900003, 900004, 900005} and want.count() == 5
    assert all(r.lossless for r in got.values()) and got[900002].n_pieces == 0

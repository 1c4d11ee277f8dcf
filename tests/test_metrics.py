import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabwatch.operators import metrics as M


def scored(spark, labels, scores, model="m", parts=None):
    df = spark.createDataFrame(pd.DataFrame({"model": model, "label": labels,
                                             "score": np.asarray(scores, dtype=float)}))
    return df.repartition(parts) if parts else df


def brute_auc(y, s):
    y, s = np.asarray(y), np.asarray(s)
    pos, neg = s[y == 1], s[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return gt / (len(pos) * len(neg))


def brute_ap(y, s):
    y, s = np.asarray(y), np.asarray(s)
    P = y.sum()
    ap = 0.0
    prev_r = 0.0
    for t in np.unique(s)[::-1]:
        pred = s >= t
        tp = (pred & (y == 1)).sum()
        fp = (pred & (y == 0)).sum()
        r = tp / P
        ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    return ap


def test_confusion_known_answers(spark):
    r = M.confusion_at(scored(spark, [0, 0, 1, 1], [.1, .6, .7, .4]), ["model"], 0.5).first()
    assert (r.tp, r.fp, r.fn, r.tn) == (1, 1, 1, 1)
    r = M.confusion_at(scored(spark, [0, 1, 0, 1], [.01, .02, .03, .04]), ["model"], 0.5).first()
    assert (r.tp, r.fp, r.fn, r.tn) == (0, 0, 2, 2)


def test_calibration_keeps_empty_bins(spark):
    rows = M.calibration_table(scored(spark, [0, 1, 0, 1], [.05, .95, .05, .95])).orderBy("bin").collect()
    assert len(rows) == 10
    assert [r["count"] for r in rows] == [2, 0, 0, 0, 0, 0, 0, 0, 0, 2]
    assert rows[4].predicted_mean is None and rows[4].observed_rate is None
    assert rows[0].bin_lower == 0.0 and rows[3].bin_lower == 0.30000000000000004
    assert rows[9].bin_upper == 1.0 and rows[9].predicted_mean == pytest.approx(0.95)


def test_calibration_last_bin_closed(spark):
    rows = M.calibration_table(scored(spark, [1, 0, 1], [1.0, 0.0, 0.5]), n_bins=2).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [1, 2]
    with pytest.raises(ValueError):
        M.calibration_table(scored(spark, [1], [0.5]), n_bins=1)


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_auc_ap_match_brute_force(spark, parts):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.uniform(size=400) * 0.6 + 0.4 * y * rng.uniform(size=400), 2)  # ties
    r = M.rank_metrics(scored(spark, y, s, parts=parts), ["model"]).first()
    assert r.roc_auc == pytest.approx(brute_auc(y, s), abs=1e-12)
    assert r.pr_auc == pytest.approx(brute_ap(y, s), abs=1e-12)


def test_perfect_and_one_class(spark):
    r = M.rank_metrics(scored(spark, [0, 0, 1, 1], [.1, .2, .8, .9]), ["model"]).first()
    assert r.roc_auc == 1.0 and r.pr_auc == 1.0
    r = M.rank_metrics(scored(spark, [0, 0], [.1, .2]), ["model"]).first()
    assert r.roc_auc is None and r.pr_auc is None


def test_metric_set_values(spark):
    y = np.array([0, 1, 1, 0, 1, 0, 1, 1])
    s = np.array([.2, .8, .6, .4, .3, .1, .9, .55])
    r = M.classification_metrics(scored(spark, y, s), ["model"]).first()
    pred = s >= 0.5
    tp, fp, fn = (pred & (y == 1)).sum(), (pred & (y == 0)).sum(), (~pred & (y == 1)).sum()
    assert r.f1 == pytest.approx(2 * tp / (2 * tp + fp + fn))
    p = np.clip(np.where(y == 1, s, 1 - s), np.finfo(float).eps, 1 - np.finfo(float).eps)
    assert r.log_loss == pytest.approx(-np.log(p).mean())
    assert r.brier == pytest.approx(((s - y) ** 2).mean())
    assert r.roc_auc == pytest.approx(brute_auc(y, s))


def test_threshold_moves_f1_only(spark):
    df = scored(spark, [0, 1, 1, 0], [.3, .6, .45, .2])
    a = M.classification_metrics(df, ["model"], threshold=0.5).first()
    b = M.classification_metrics(df, ["model"], threshold=0.4).first()
    assert a.roc_auc == b.roc_auc and a.brier == b.brier and a.f1 != b.f1


def test_threshold_sweep_matches_loop(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 300)
    s = rng.uniform(size=300)
    rows = {round(r.threshold, 6): r for r in M.threshold_sweep(scored(spark, y, s)).collect()}
    assert len(rows) == 19
    for t in np.linspace(0.05, 0.95, 19):
        r = rows[round(float(t), 6)]
        pred = s >= t
        tp, fp = (pred & (y == 1)).sum(), (pred & (y == 0)).sum()
        fn, tn = (~pred & (y == 1)).sum(), (~pred & (y == 0)).sum()
        assert (r.tp, r.fp, r.fn, r.tn) == (tp, fp, fn, tn)
        prec = tp / (tp + fp) if tp + fp else 0.0
        assert r.precision == pytest.approx(prec)


def test_compare_and_champion(spark):
    df = scored(spark, [0, 1, 0, 1], [.1, .9, .2, .8], model="a").unionByName(
        scored(spark, [0, 1, 0, 1], [.6, .4, .2, .8], model="b"))
    cmp = M.compare_models(df)
    assert cmp.count() == 2
    best = M.champion(cmp).first()
    assert best.model == "a" and best.roc_auc == 1.0


def test_null_scores_dropped(spark):
    df = spark.createDataFrame([("m", 1, 0.9), ("m", 0, 0.1), ("m", 1, None), ("m", 0, 0.4)],
                               "model string, label int, score double")
    r = M.classification_metrics(df, ["model"]).first()
    assert r.roc_auc == 1.0
    assert r.brier == pytest.approx((0.01 + 0.01 + 0.16) / 3)


# ------------------------------------------------------------------ row weights

def _weighted_rows(seed=4, n=400):
    r = np.random.default_rng(seed)
    rows = [("ab"[i % 2], int(r.random() < 0.4), float(np.round(r.random(), 2)), float(w))
            for i, w in enumerate(r.choice([0.0, 0.1, 0.25, 1.0, 3.7, 1e6], n))]
    return rows + [("a", 1, None, 2.0), ("a", 0, float("nan"), 2.0), (None, 1, 0.7, 0.5), (None, 0, 0.7, 2.0),
                   ("zero", 1, 0.9, 0.0), ("zero", 0, 0.1, 0.0)]


W_SCHEMA = "model string, label int, score double, w double"


def _brute(rows):
    """AUC over all pairs, average precision over distinct scores, point metrics; all weighted."""
    rows = [(y, s, w) for y, s, w in rows if s is not None and s == s]
    pos = [(s, w) for y, s, w in rows if y]
    neg = [(s, w) for y, s, w in rows if not y]
    wp, wn = sum(w for _, w in pos), sum(w for _, w in neg)
    pairs = sum(a * b * (1.0 if s > t else 0.5 if s == t else 0.0) for s, a in pos for t, b in neg)
    ap = 0.0
    for t in sorted({s for s, _ in pos}):
        tp, fp = sum(w for s, w in pos if s >= t), sum(w for s, w in neg if s >= t)
        if tp:
            ap += sum(w for s, w in pos if s == t) * tp / (tp + fp)
    at = lambda side, hit: sum(w for s, w in side if (s >= 0.5) == hit)
    tp, fp, fn, tn = at(pos, True), at(neg, True), at(pos, False), at(neg, False)
    total = wp + wn
    clip = lambda p: min(max(p, M.LOG_LOSS_EPS), 1 - M.LOG_LOSS_EPS)
    return {"roc_auc": pairs / (wp * wn) if wp and wn else None, "pr_auc": ap / wp if wp else None,
            "f1": 2 * tp / (2 * tp + fp + fn) if 2 * tp + fp + fn else 0.0, "tp": tp, "fp": fp, "fn": fn, "tn": tn,
            "log_loss": -sum(w * np.log(clip(s if y else 1 - s)) for y, s, w in rows) / total if total else None,
            "brier": sum(w * (s - y) ** 2 for y, s, w in rows) / total if total else None}


def _close(a, b):
    return a is None and b is None or a is not None and b is not None and abs(a - b) <= 1e-9 * max(1.0, abs(b))


def test_weighted_metrics_equal_brute_force(spark):
    rows = _weighted_rows()
    d = spark.createDataFrame(rows, W_SCHEMA)
    sets = {r.model: r for r in M.classification_metrics(d, ["model"], weight="w").collect()}
    points = {r.model: r for r in M.point_metrics(d, ["model"], weight="w").collect()}
    assert set(sets) == set(points) == {"a", "b", None, "zero"}
    for model in sets:
        want = _brute([r[1:] for r in rows if r[0] == model])
        for k in ("roc_auc", "pr_auc", "f1", "log_loss", "brier"):
            assert _close(sets[model][k], want[k]), (model, k)
        for k in ("f1", "log_loss", "brier", "tp", "fp", "fn", "tn"):
            assert _close(points[model][k], want[k]), (model, k)


def test_weighted_sweep_and_calibration_equal_brute_force(spark):
    rows = _weighted_rows(8)
    d = spark.createDataFrame(rows, W_SCHEMA)
    live = [(y, s, w) for m, y, s, w in rows if m == "a" and s is not None and s == s]
    for r in M.threshold_sweep(d, ["model"], [0.2, 0.5, 0.9], weight="w").where("model = 'a'").collect():
        tp, fp = (sum(w for y, s, w in live if s >= r.threshold and y == k) for k in (1, 0))
        fn, tn = (sum(w for y, s, w in live if s < r.threshold and y == k) for k in (1, 0))
        for got, want in ((r.tp, tp), (r.fp, fp), (r.fn, fn), (r.tn, tn), (r.precision, tp / (tp + fp)), (r.recall, tp / (tp + fn))):
            assert _close(got, want)
    bins = M.calibration_table(d, ["model"], 5, weight="w").where("model = 'a'").collect()
    assert len(bins) == 5
    for b in bins:
        own = [(y, s, w) for y, s, w in live if b.bin_lower <= s < b.bin_upper or b.bin == 4 and s == 1.0]
        total = sum(w for *_, w in own)
        assert b["count"] == len(own) and _close(b.weight_sum, total)
        assert _close(b.predicted_mean, sum(w * s for _, s, w in own) / total)
        assert _close(b.observed_rate, sum(w * y for y, _, w in own) / total)
    none = M.calibration_table(d, ["model"], 5, weight="w").where("model = 'zero' AND count > 0").collect()
    assert len(none) == 2 and all(b.predicted_mean is None and b.weight_sum == 0 for b in none)


def test_weight_one_is_no_weight_and_order_does_not_count(spark):
    d = spark.createDataFrame(_weighted_rows(5), W_SCHEMA).withColumn("one", F.lit(1))
    for f in (M.classification_metrics, M.rank_metrics, M.point_metrics, M.threshold_sweep):
        plain, same = f(d, ["model"]).collect(), f(d, ["model"], weight="one").collect()
        key = lambda r: tuple(repr(x) for x in (r.model, r["threshold"] if "threshold" in r else 0))
        for a, b in zip(sorted(plain, key=key), sorted(same, key=key)):
            assert all(a[c] == b[c] if isinstance(a[c], str) else _close(a[c], b[c]) for c in a.asDict())
    got = [sorted(map(repr, M.rank_metrics(d.repartition(n), ["model"], weight="w").select("n_pos", "n_neg").collect()))
           for n in (1, 4, 17)]
    assert got[0] == got[1] == got[2]


def test_a_group_of_null_scores_only_stays(spark):
    d = spark.createDataFrame([("a", 1, None, 1.0), ("a", 0, float("nan"), 1.0), ("b", 1, 0.5, 1.0), ("b", 0, None, 1.0)], W_SCHEMA)
    for weight in (None, "w"):
        r = {x.model: x for x in M.point_metrics(d, ["model"], weight=weight).collect()}
        assert (r["a"].tp, r["a"].fn, r["a"].log_loss, r["a"].brier, r["a"].f1) == (0, 0, None, None, 0.0)
        assert abs(r["b"].log_loss - np.log(2)) < 1e-12 and r["b"].brier == 0.25


@pytest.mark.parametrize("bad", [None, -1.0, float("nan")])
def test_bad_weights_fail(spark, bad):
    d = spark.createDataFrame([("a", 1, 0.5, 1.0), ("a", 0, 0.4, bad)], W_SCHEMA)
    with pytest.raises(Exception, match="weight"):
        M.classification_metrics(d, ["model"], weight="w").collect()


def test_weighted_metrics_of_nothing(spark):
    d = spark.createDataFrame([], W_SCHEMA)
    for f in (M.classification_metrics, M.confusion_at, M.threshold_sweep, M.calibration_table):
        assert f(d, ["model"], weight="w").collect() == []


@pytest.mark.parametrize("query", ["weighted_metric_set", "metric_set"])
def test_all_steps_of_the_metric_set_read_one_exchange_of_counts(spark, query):
    """Bounds, bucket totals, ranks and point metrics: the scored table is scanned and counted once."""
    from tabwatch.plans import catalog

    d = catalog.QUERIES[query](spark, "/root/testdata/sf0.001")
    assert len(d.collect()) == 6
    plan = d._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1


def test_weights_are_exact_to_nine_places(spark):
    """Sums equal those of decimals: near halves of the last place, tiny, large and mixed weights."""
    from decimal import ROUND_HALF_UP, Decimal

    r = np.random.default_rng(9)
    ws = [0.0, 5e-10, 4.999999999e-10, 1.5e-9, 2.5e-9, 0.1, 1 / 3, 1099.5116277765, 1099.511627776, 123456.0000000005,
          2.0 ** 53, 99999999999.5, *r.random(200), *(r.integers(0, 10 ** 10, 200) + 0.5) / 1e9, *r.random(50) * 1e10]
    want = sum(Decimal(repr(float(w))).quantize(Decimal("1e-9"), ROUND_HALF_UP) for w in ws if w < 1e11)
    rows = [("a", i % 2, 0.5, float(w)) for i, w in enumerate(ws) if w < 1e11]
    c = M.score_counts(spark.createDataFrame(rows, W_SCHEMA), ["model"], weight="w").first()
    assert Decimal(c.n_pos + c.n_neg) == want * M.WEIGHT_SCALE

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabwatch.operators import drift as D
from tabwatch.operators import prefix as PF


def np_psi(b, c, n=10):
    e = np.unique(np.quantile(b, np.linspace(0, 1, n + 1)))
    if e.size < 2:
        return 0.0
    e[0], e[-1] = -np.inf, np.inf
    bc, _ = np.histogram(b, e)
    cc, _ = np.histogram(c, e)
    bp = np.where(bc == 0, 1e-6, bc / b.size)
    cp = np.where(cc == 0, 1e-6, cc / c.size)
    return float(np.sum((cp - bp) * np.log(cp / bp)))


def np_ks(b, c):
    allv = np.concatenate([b, c])
    return float(np.max(np.abs(np.searchsorted(np.sort(b), allv, "right") / b.size
                               - np.searchsorted(np.sort(c), allv, "right") / c.size)))


def frame(spark, **cols):
    return spark.createDataFrame(pd.DataFrame(cols))


def test_identity_near_zero(spark):
    x = np.random.default_rng(0).normal(size=500)
    df = frame(spark, x=x)
    r = D.psi_numeric(df, df, ["x"]).first()
    assert r.psi < 0.01 and r.n_bins_used == 10
    k = D.ks_two_sample(df, df, ["x"]).first()
    assert k.ks_statistic == 0.0 and k.ks_pvalue == 1.0


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_psi_and_ks_match_numpy(spark, parts):
    r = np.random.default_rng(1)
    b = np.round(r.normal(50, 10, 800), 1)
    c = np.round(r.normal(53, 12, 600), 1)
    bd = frame(spark, x=b).repartition(parts)
    cd = frame(spark, x=c).repartition(parts)
    assert D.psi_numeric(bd, cd, ["x"]).first().psi == pytest.approx(np_psi(b, c), abs=1e-12)
    assert D.ks_two_sample(bd, cd, ["x"]).first().ks_statistic == pytest.approx(np_ks(b, c), abs=1e-15)


def test_psi_monotone_in_shift(spark):
    r = np.random.default_rng(2)
    b = r.normal(size=500)
    base = frame(spark, x=b)
    vals = [D.psi_numeric(base, frame(spark, x=r.normal(size=500) + s), ["x"]).first().psi
            for s in (0.0, 0.5, 1.0, 2.0)]
    assert vals == sorted(vals)


def test_constant_baseline_is_zero(spark):
    r = D.psi_numeric(frame(spark, x=np.ones(100)), frame(spark, x=np.ones(100) * 5), ["x"]).first()
    assert r.psi == 0.0 and r.n_bins_used == 0


def test_binary_column_single_bin(spark):
    b = np.array([0] * 84 + [1] * 16, dtype=float)
    c = np.array([0] * 20 + [1] * 80, dtype=float)
    r = D.psi_numeric(frame(spark, x=b), frame(spark, x=c), ["x"]).first()
    assert r.n_bins_used == 1 and r.psi == 0.0
    b2 = np.array([0] * 80 + [1] * 20, dtype=float)
    r2 = D.psi_numeric(frame(spark, x=b2), frame(spark, x=c), ["x"]).first()
    assert r2.n_bins_used == 2 and r2.psi == pytest.approx(np_psi(b2, c))


def test_empty_side_gives_null(spark):
    b = frame(spark, x=np.arange(10.0))
    r = D.psi_numeric(b, b.limit(0), ["x"]).first()
    assert r.psi is None


def test_categorical_new_category(spark):
    b = frame(spark, g=["a"] * 100 + ["b"] * 100)
    c = frame(spark, g=["a"] * 100 + ["b"] * 80 + ["c"] * 20)
    r = D.psi_categorical(b, c, ["g"]).first()
    pb = np.array([.5, .5, 1e-6])
    pc = np.array([.5, .4, .1])
    assert r.psi == pytest.approx(float(np.sum((pc - pb) * np.log(pc / pb))))


def test_score_drift_large(spark):
    r = np.random.default_rng(4)
    b, c = r.beta(2, 8, 2000), r.beta(8, 2, 2000)
    p = D.prediction_drift(frame(spark, score=b), frame(spark, score=c)).first()
    assert p.psi > 1.0
    assert p.baseline_std == pytest.approx(b.std()) and p.current_mean == pytest.approx(c.mean())


def test_feature_table_order_alerts_summary(spark):
    r = np.random.default_rng(5)
    n = 500
    tenure = r.integers(0, 72, n)
    base = frame(spark, tenure=tenure, MonthlyCharges=r.uniform(20, 100, n),
                 gender=r.choice(["Female", "Male"], n), Contract=r.choice(["a", "b"], n),
                 ignored=np.zeros(n))
    cur = frame(spark, tenure=tenure[::-1].copy(), MonthlyCharges=r.uniform(20, 100, n) * 1.6,
                gender=r.choice(["Female", "Male"], n, p=[.9, .1]), Contract=r.choice(["a", "b"], n),
                ignored=np.ones(n))
    t = D.detect_drift(base, cur, ["tenure", "MonthlyCharges"], ["gender", "Contract"])
    rows = t.collect()
    assert [x.feature for x in rows][:2] == ["MonthlyCharges", "gender"]
    assert {x.feature for x in rows} == {"tenure", "MonthlyCharges", "gender", "Contract"}
    psis = [x.psi for x in rows]
    assert psis == sorted(psis, reverse=True)
    g = [x for x in rows if x.feature == "gender"][0]
    assert g.ks_statistic is None and g.ks_alert is False and g.psi_alert is True
    m = [x for x in rows if x.feature == "MonthlyCharges"][0]
    assert m.ks_alert is True and m.psi_alert is True
    s = D.drift_summary(t).first()
    assert s.n_features == 4 and s.n_psi_alerts == 2 and s.n_ks_alerts == 1
    assert s.n_total_alerts == 3 and s.prediction_drift_alert is False
    assert s.max_psi == pytest.approx(max(psis))


def test_exact_quantiles_match_numpy(spark):
    r = np.random.default_rng(6)
    x = np.round(r.exponential(3, 1000), 1)
    counts = frame(spark, k=["a"] * len(x), v=x).groupBy("k", "v").count()
    rt = PF.running_totals(counts, ["k"], "v", ["count"], n_buckets=16, key_bound=1)
    probs = [0.0, 0.1, 0.25, 0.30000000000000004, 0.5, 0.9, 1.0]
    got = {r.q_idx: r.q_value for r in PF.exact_quantiles(rt, "count", probs).collect()}
    want = np.quantile(x, probs)
    for i, w in enumerate(want):
        assert got[i] == pytest.approx(w, abs=1e-12)


@pytest.mark.parametrize("buckets", [1, 3, 64, 1024])
def test_running_totals_match_cumsum(spark, buckets):
    r = np.random.default_rng(7)
    pdf = pd.DataFrame({"k": r.choice(["a", "b", "c"], 300), "v": r.normal(size=300),
                        "w": r.integers(1, 5, 300)})
    pdf = pdf.groupby(["k", "v"], as_index=False)["w"].sum()
    rt = PF.running_totals(spark.createDataFrame(pdf).repartition(5), ["k"], "v", ["w"],
                           n_buckets=buckets)
    got = rt.rows.toPandas().sort_values(["k", "v"])
    want = pdf.sort_values(["k", "v"]).groupby("k")["w"].cumsum()
    assert list(got["cum_w"]) == list(want)


def test_null_policy(spark):
    b = spark.createDataFrame([(float(i), "a") for i in range(50)] + [(None, None)] * 10,
                              "x double, g string")
    c = spark.createDataFrame([(float(i), "a") for i in range(50)] + [(None, "a")] * 5,
                              "x double, g string")
    r = D.psi_numeric(b, c, ["x"]).first()
    assert r.n_b == 50 and r.n_c == 50 and r.psi == pytest.approx(0.0, abs=1e-12)
    k = D.ks_two_sample(b, c, ["x"]).first()
    assert k.ks_statistic == 0.0
    cat = D.psi_categorical(b, c, ["g"]).first()   # NULL is a category of its own
    assert cat.n_b == 60 and cat.psi > 0.1


def test_approx_edges_close_to_exact(spark):
    r = np.random.default_rng(8)
    b, c = r.normal(size=3000), r.normal(size=3000) + 0.3
    bd, cd = frame(spark, x=b), frame(spark, x=c)
    exact = D.psi_numeric(bd, cd, ["x"]).first().psi
    approx = D.psi_numeric(bd, cd, ["x"], approx=True).first().psi
    assert approx == pytest.approx(exact, rel=0.05)
    # with accuracy >= n the sketch is exact up to interpolation between neighbours
    assert D.psi_numeric(bd, cd, ["x"], approx=True, accuracy=100000).first().n_bins_used == 10


def test_empty_side_ks_and_score_drift(spark):
    b = frame(spark, x=np.arange(10.0))
    k = D.ks_two_sample(b, b.limit(0), ["x"]).first()
    assert k.ks_statistic is None and k.ks_pvalue is None and k.n_c == 0
    t = D.detect_drift(b, b.limit(0), ["x"], []).first()
    assert t.psi is None and t.psi_alert is False and t.ks_alert is False


def test_exact_ks_pvalue_counts_permutations():
    from itertools import combinations
    from math import comb

    for n1, n2 in ((1, 1), (3, 4), (5, 5), (2, 9), (6, 4)):
        ds = []
        for side in combinations(range(n1 + n2), n1):
            i = far = 0
            for k in range(n1 + n2):
                i += k in side
                far = max(far, abs(i * n2 - (k + 1 - i) * n1))
            ds.append(far)
        for far in sorted(set(ds)):
            want = sum(x >= far for x in ds) / comb(n1 + n2, n1)
            assert D.ks_pvalue_exact(far / (n1 * n2), n1, n2) == pytest.approx(want, rel=1e-12)
            assert D.ks_pvalue_exact(far / (n1 * n2), n2, n1) == pytest.approx(want, rel=1e-12)
    assert D.ks_pvalue_exact(0.0, 3, 3) == 1.0
    assert D.ks_pvalue_exact(1.0, 200, 200) == pytest.approx(2 / comb(400, 200), rel=1e-9)


def test_exact_limit(spark):
    b = spark.range(50).selectExpr("cast(id AS double) AS x", "cast(NULL AS double) AS e")
    c = spark.range(40).selectExpr("cast(id + 12 AS double) AS x", "1.0D AS e")
    exact = {r.feature: r for r in D.ks_two_sample(b, c, ["x", "e"], exact_limit=50).collect()}
    rough = {r.feature: r for r in D.ks_two_sample(b, c, ["x", "e"], exact_limit=49).collect()}
    assert exact["x"].ks_statistic == rough["x"].ks_statistic and exact["e"].ks_pvalue is None
    assert exact["x"].ks_pvalue == D.ks_pvalue_exact(exact["x"].ks_statistic, 50, 40) != rough["x"].ks_pvalue
    assert exact["x"].ks_pvalue == pytest.approx(rough["x"].ks_pvalue, rel=0.3)
    t = D.detect_drift(b, c, ["x"], [], exact_limit=10_000).first()
    assert t.ks_pvalue == exact["x"].ks_pvalue


def _two_scores(spark):
    r = np.random.default_rng(3)
    pdf = pd.DataFrame({"base": r.random(900) < 0.6, "s_a": r.beta(2, 5, 900), "s_b": np.round(r.random(900), 1)})
    odd = spark.createDataFrame([(None, 0.9, 0.9), (True, None, float("nan")), (False, float("nan"), None)],
                                "base boolean, s_a double, s_b double")
    return spark.createDataFrame(pdf).unionByName(odd)


def test_score_drift_within_one_table_equals_two_sides(spark):
    d = _two_scores(spark)
    got = D.prediction_drift_within(d, F.col("base"), ["s_b", "s_a"]).collect()
    assert [r.feature for r in got] == ["s_b", "s_a"]
    for r in got:
        x = d.select("base", F.col(r.feature).alias("score"))
        want = D.prediction_drift(x.where("base"), x.where("NOT base")).first()
        assert all(abs(r[c] - want[c]) < 1e-12 for c in want.asDict())


def test_score_drift_reads_the_table_once_a_scan_and_refines_edges_only(spark, monkeypatch):
    """Equal sides: KS would refine every bucket, PSI needs those that hold its 11 quantiles."""
    from tabwatch.plans import catalog

    seen, refine = [], D._NumericDrift._refine

    def spy(self, wanted, upto, targets):
        seen.append((self.rows._jdf.queryExecution().executedPlan().toString().count("FileScan parquet"),
                     max(int(w.sum()) for w in wanted), self.cols))
        return refine(self, wanted, upto, targets)

    monkeypatch.setattr(D._NumericDrift, "_refine", spy)
    assert len(catalog.QUERIES["score_drift"](spark, "/root/testdata/sf0.001").collect()) == 2
    (scans, buckets, cols), = seen
    assert scans == 1 and buckets <= 22 and cols == ["s_price", "s_qty"]


@pytest.mark.parametrize("case,scans", [("spread", 2), ("ties", 2), ("crowded", 3), ("few", None)])
def test_psi_alone_counts_and_groups_in_one_scan(spark, case, scans):
    """A sketch, then one scan for counts and values; a current side crowded around a baseline quantile
    is counted before its values are grouped. Few rows: the sketch names no more than their neighbours."""
    r = np.random.default_rng(11)
    b, c = r.uniform(0, 1e6, 6000), r.uniform(-2e5, 9e5, 4000)
    if case == "ties":
        b, c = np.floor(b / 2e4), np.floor(c / 2e4)
    elif case == "crowded":
        c = np.median(b) + r.uniform(-50, 50, 4000)
    elif case == "few":
        b, c = b[:37], c[:5]
    read = spark.sparkContext.accumulator(0)

    def see(x):
        read.add(1)
        return x

    d = spark.createDataFrame(pd.DataFrame({"base": [True] * len(b) + [False] * len(c), "x": np.concatenate([b, c])}))
    d = d.repartition(5).withColumn("s", F.udf(see, "double")("x"))
    got = D.prediction_drift_within(d, F.col("base"), ["s"]).first()
    assert got.psi == pytest.approx(np_psi(b, c), abs=1e-9)
    assert scans is None or read.value == scans * (len(b) + len(c))

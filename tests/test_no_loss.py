"""Nothing is lost or accepted without a word: NULL groups, empty features, bad input."""

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabwatch.functions.hashing import uniform_hash
from tabwatch.operators import contracts as C
from tabwatch.operators import drift as D
from tabwatch.operators import features as FE
from tabwatch.operators import metrics as M
from tabwatch.operators import models as MD
from tabwatch.operators import split as S
from tabwatch.sources import io as IO
from tabwatch.sources import telco as T
from tabwatch.streaming import baseline as SB
from tests.conftest import telco_rows
from tests.test_drift import np_ks, np_psi


def test_more_than_fifty_broken_rules_are_all_listed(spark):
    n = 60
    df = spark.createDataFrame([tuple([-1] * n)], ", ".join(f"c{i} int" for i in range(n)))
    contract = C.Contract("wide", tuple(C.ColumnSpec(f"c{i}", "int", ge=0) for i in range(n)))
    with pytest.raises(C.ContractError) as e:
        C.validate(df, contract)
    assert len(e.value.problems) == n


def test_missing_columns_never_pass(spark):
    df = spark.createDataFrame([(1,)], "a int")
    contract = C.Contract("two", (C.ColumnSpec("a", "int"), C.ColumnSpec("b", "int")), key=("a",))
    for f in (C.with_violations, C.violation_summary, C.split_valid, C.violation_table, C.validate):
        with pytest.raises(C.ContractError):
            f(df, contract)
    assert [r.problem for r in C.schema_report(df, contract).collect()] == ["missing column b"]


def test_composite_unique_and_sample_keys(spark):
    rows = [(1, 1, "a"), (1, 2, "a"), (1, 2, "b"), (2, 1, "a"), (None, 1, "a"), (None, 1, "b")] + [(9, 9, "z")] * 4
    df = spark.createDataFrame(rows, "o int, l int, v string")
    contract = C.Contract("lines", (C.ColumnSpec("o", "int", nullable=True), C.ColumnSpec("l", "int", le=8),
                                    C.ColumnSpec("v", "string")), key=("o", "l", "v"), unique=(("o", "l"),))
    s = {r.rule: r for r in C.violation_summary(df, contract, sample_keys=2).collect()}
    assert s["o,l:unique"].n_violations == 6 and s["l:le"].n_violations == 4
    assert [json.loads(k)["v"] for k in s["o,l:unique"].sample_keys] == ["a", "b"]
    assert s["v:not_null"].n_violations == 0 and s["v:not_null"].sample_keys is None
    assert C.violation_table(df, contract).where("rule = 'o,l:unique'").count() == 6


def test_load_raw_and_preprocess_validate(spark, tmp_dir):
    for col, value in (("gender", "Other"), ("tenure", "abc"), ("TotalCharges", "abc")):
        pdf = telco_rows(20).astype({"tenure": str, "TotalCharges": str})
        pdf.loc[0, col] = value
        pdf.to_csv(f"{tmp_dir}/{col}.csv", index=False)
        with pytest.raises(C.ContractError, match=col):
            T.load_raw(spark, f"{tmp_dir}/{col}.csv")
    bad = telco_rows(20)
    bad.loc[3, "gender"] = "Other"
    with pytest.raises(C.ContractError):
        T.preprocess(spark.createDataFrame(bad))


def test_null_strata_are_kept(spark):
    df = spark.range(200).withColumn("s", F.when(F.col("id") % 10 != 0, (F.col("id") % 2).cast("string")))
    out = S.stratified_split(df, "id", "s")
    assert out.count() == 200 and out.where("s IS NULL").count() == 20
    assert {r.split: r["count"] for r in out.where("s IS NULL").groupBy("split").count().collect()}["test"] == 4
    folds = S.stratified_folds(df, "id", "s", 5)
    assert folds.count() == 200
    assert {r["count"] for r in folds.where("s IS NULL").groupBy("fold").count().collect()} == {4}
    with pytest.raises(ValueError):
        S.stratified_split(df.withColumn("id", F.when(F.col("id") > 3, F.col("id"))), "id", "s")
    with pytest.raises(ValueError):
        S.stratified_split(df, "id", "id", max_strata=10)


def test_split_plan_has_no_union_and_no_shuffle_of_rows(spark):
    df = spark.range(2000).withColumn("s", (F.col("id") % 2).cast("int"))
    plan = S.stratified_split(df, "id", "s")._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and "Exchange hashpartitioning" not in plan


def test_null_groups_of_metrics(spark):
    rows = [(k, y, s) for k in ("a", None) for y, s in ((1, .9), (0, .2), (1, .4), (0, .6))]
    df = spark.createDataFrame(rows, "model string, label int, score double")
    for bound in (None, 2):
        got = {r.model: r for r in M.classification_metrics(df, ["model"], key_bound=bound).collect()}
        assert set(got) == {"a", None} and got[None].roc_auc == got["a"].roc_auc == 0.75
    assert M.threshold_sweep(df, ["model"], np.array([0.5])).count() == 2
    assert M.calibration_table(df, ["model"]).count() == 20
    with pytest.raises(ValueError):
        M.threshold_sweep(df, ["model"], [])


def test_labels_other_than_zero_and_one_fail(spark):
    for bad in (2, None):
        df = spark.createDataFrame([("m", 1, .5), ("m", bad, .5)], "model string, label int, score double")
        with pytest.raises(Exception, match="label must be 0 or 1"):
            M.classification_metrics(df, ["model"]).collect()
        with pytest.raises(ValueError):
            MD.with_class_weights(df, "label")
    with pytest.raises(ValueError):
        M.compare_models(df.limit(0), strict=True)


def test_every_listed_feature_has_a_row_and_nan_is_null(spark):
    r = np.random.default_rng(3)
    b, c = r.normal(size=300), r.normal(size=200) + 0.2
    frame = lambda v: spark.createDataFrame(pd.DataFrame({"x": v, "n": np.where(np.arange(len(v)) % 3 == 0, np.nan, v)})) \
        .withColumn("none", F.lit(None).cast("double")).withColumn("g", F.lit(None).cast("string"))
    t = {x.feature: x for x in D.detect_drift(frame(b), frame(c), ["x", "none", "n"], ["g"]).collect()}
    assert set(t) == {"x", "none", "n", "g"} and t["none"].psi is None and t["none"].ks_statistic is None
    kb, kc = b[np.arange(300) % 3 != 0], c[np.arange(200) % 3 != 0]
    assert t["n"].psi == pytest.approx(np_psi(kb, kc)) and t["n"].ks_statistic == pytest.approx(np_ks(kb, kc))
    assert D.drift_summary(D.detect_drift(frame(b), frame(c), ["x", "none"], [])).first().n_features == 2
    with pytest.raises(ValueError):
        D.detect_drift(frame(b), frame(c), ["none"], [], strict=True)


@pytest.mark.parametrize("buckets", [2, 7, 3000])
def test_drift_does_not_depend_on_the_bucket_count(spark, buckets):
    r = np.random.default_rng(12)
    b, c = np.round(r.exponential(3, 900), 2), np.round(r.exponential(3.2, 700), 2)
    x = lambda v: spark.createDataFrame(pd.DataFrame({"x": v}))
    t = D._NumericDrift(x(b), x(c), ["x"], buckets).table().first()
    assert t.psi == pytest.approx(np_psi(b, c), abs=1e-12) and t.ks_statistic == pytest.approx(np_ks(b, c), abs=1e-15)


def test_fingerprint_identifies_content(spark):
    f = lambda rows, schema: tuple(IO.fingerprint(spark.createDataFrame(rows, schema)).first())
    s = "a string, b string"
    assert f([("a|b", "c")], s) != f([("a", "b|c")], s) and f([("1:x", None)], s) != f([(None, "1:x")], s)
    assert f([(1.0,)], "x double") != f([(1.0 + 1e-9,)], "x double") != f([(1e-300,)], "x double")
    assert f([([1.0, 2.0],)], "x array<float>") != f([([2.0, 1.0],)], "x array<float>")
    h = lambda *k: spark.range(1).select(uniform_hash(1, *[F.lit(x).cast("string") for x in k])).first()[0]
    assert h("a:b", "c") != h("a", "b:c") and h(None, "a") != h("a", None) and h("\\N") != h(None)


def test_unbounded_categories_are_refused(spark, monkeypatch):
    monkeypatch.setattr(FE, "MAX_CATEGORIES", 50)
    df = spark.range(500).select(F.col("id").cast("double").alias("x"), F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="categories"):
        FE.build_feature_pipeline(["x"], None, ["c"]).fit(df)


@pytest.fixture(scope="module")
def folds(spark):
    df = T.preprocess(spark.createDataFrame(telco_rows(240))).withColumn("id", F.monotonically_increasing_id())
    return S.stratified_folds(df, "id", "churn", k=2).persist()


PIPE = lambda: FE.build_feature_pipeline(["tenure", "MonthlyCharges"], "tenure", ["Contract", "gender"])


def test_unbalanced_trial_is_an_unweighted_fit_per_fold(folds, monkeypatch):
    spec = MD.REGISTRY["logreg"]
    fixed = MD.ModelSpec("logreg", spec.build, "linear", spec.defaults, lambda r: {"C": 0.5, "balanced": False})
    monkeypatch.setitem(MD.REGISTRY, "logreg", fixed)
    table, _ = MD.tune("logreg", folds, PIPE(), "churn", "fold", n_trials=1)
    aucs = []
    for k in (0, 1):
        rest, held = folds.where(F.col("fold") != k), folds.where(F.col("fold") == k)
        fm = PIPE().fit(rest)
        m = MD.fit_model("logreg", fm.transform(rest), "churn", {"C": 0.5, "balanced": False})
        assert m.params["sum_w"] == rest.count() and "weight_col" not in m.params
        s = m.score(fm.transform(held), ["churn"]).withColumn("model", F.lit("m"))
        aucs.append(M.rank_metrics(s, ["model"], "churn").first().roc_auc)
    assert table.first().mean_roc_auc == pytest.approx(np.mean(aucs), abs=1e-9)


def test_network_survives_a_category_missing_from_a_fold(folds, monkeypatch):
    spec = MD.REGISTRY["mlp"]
    tiny = MD.ModelSpec("mlp", spec.build, None, spec.defaults, lambda r: {"hidden": [4], "max_iter": 5})
    monkeypatch.setitem(MD.REGISTRY, "mlp", tiny)
    odd = folds.withColumn("Contract", F.when((F.col("fold") == 1) & (F.col("id") % 5 == 0), "Rare").otherwise(F.col("Contract")))
    table, _ = MD.tune("mlp", odd, PIPE(), "churn", "fold", n_trials=1)
    assert 0 <= table.first().mean_roc_auc <= 1


def test_logreg_is_at_its_optimum(folds):
    fm = PIPE().fit(folds)
    enc = fm.transform(folds)
    m = MD.fit_model("logreg", enc, "churn", {"balanced": False, "C": 1.0})
    x = np.array([r[0].toArray() for r in enc.select(FE.FEATURES).collect()])
    y = np.array([r[0] for r in enc.select("churn").collect()], float)
    p = 1 / (1 + np.exp(-(x @ m.model.coefficients.toArray() + m.model.intercept)))
    grad = x.T @ (p - y) + m.model.coefficients.toArray()  # C = 1
    assert np.abs(grad).max() < 1e-2 * len(y) ** 0.5


@pytest.mark.parametrize("name,params", [("logreg", None), ("gbt", {"n_estimators": 3}), ("mlp", {"max_iter": 5})])
def test_model_round_trip(spark, folds, tmp_dir, name, params):
    fm = PIPE().fit(folds)
    m = MD.fit_model(name, fm.transform(folds), "churn", params, threshold=0.4)
    m.save(f"{tmp_dir}/m", fm)
    back, features = MD.FittedModel.load(f"{tmp_dir}/m")
    assert back.threshold == 0.4 and back.name == name
    a, b = (k.score(f.transform(folds), ["id"]).orderBy("id").collect() for k, f in ((m, fm), (back, features)))
    assert a == b
    with pytest.raises(TypeError):
        MD.FittedModel.load(f"{tmp_dir}/none")


def test_baseline_is_frozen_and_reloads(spark, tmp_dir):
    r = np.random.default_rng(5)
    src = f"{tmp_dir}/base"
    spark.createDataFrame(pd.DataFrame({"value": r.normal(size=300), "g": r.choice(["a", "b"], 300)})).write.parquet(src)
    base = SB.fit_baseline(spark.read.parquet(src), ["value"], ["g"], path=f"{tmp_dir}/frozen")
    before = sorted(map(tuple, base.props.collect()))
    spark.createDataFrame([(1e9, "z")], "value double, g string").write.mode("overwrite").parquet(src)
    again = SB.load_baseline(spark, f"{tmp_dir}/frozen")
    assert sorted(map(tuple, again.props.collect())) == before and again.edges == base.edges
    with pytest.raises(TypeError):
        SB.load_baseline(spark, src)

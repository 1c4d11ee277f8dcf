"""Fits from packed blocks: the same trees as Spark's own, any cut into blocks, bounds, searches."""

import json

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tabwatch.operators import blocks as B
from tabwatch.operators import features as FE
from tabwatch.operators import models as M

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def data(spark):
    r = np.random.default_rng(11)
    rows = []
    for i in range(600):
        x, z, t = float(r.normal()), float(r.integers(0, 9)), int(r.integers(0, 60))
        rows.append((i, x, z, t, "abcd"[int(r.integers(0, 4))], "uv"[i % 2], int(x + 0.1 * z + 0.02 * t + r.normal(0, 0.7) > 1.0)))
    return spark.createDataFrame(rows, "id long, x double, z double, tenure int, kind string, side string, churn int").persist()


@pytest.fixture(scope="module")
def pipe():
    return FE.build_feature_pipeline(["x", "z"], "tenure", ["kind", "side"])


@pytest.fixture(scope="module")
def encoded(data, pipe):
    return pipe.fit(data).transform(data).select("id", "churn", FE.FEATURES).coalesce(1).persist()


def scores(model, df):
    return {r.id: r.score for r in model.score(df, ["id"]).collect()}


def by_estimator(monkeypatch, name, *args):
    with monkeypatch.context() as m:
        m.setattr(M.REGISTRY[name], "learner", None)
        return M.fit_model(name, *args)


def test_trees_are_those_of_spark(encoded, monkeypatch):
    p = {"n_estimators": 12, "max_depth": 4, "subsample": 1.0, "colsample": 1.0}  # nothing is drawn
    own, spark_own = M.fit_model("gbt", encoded, "churn", p), by_estimator(monkeypatch, "gbt", encoded, "churn", p)
    assert type(own.model) is type(spark_own.model) and own.model.getNumTrees == 12
    a, b = scores(own, encoded), scores(spark_own, encoded)
    assert max(abs(a[i] - b[i]) for i in a) < 1e-9
    assert np.allclose(own.model.treeWeights, spark_own.model.treeWeights)


def test_drawn_rows_and_features_fit_as_well_as_spark(encoded, monkeypatch):
    p = {"n_estimators": 30, "max_depth": 3}
    auc = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="churn", numBins=0)
    own, spark_own = M.fit_model("gbt", encoded, "churn", p), by_estimator(monkeypatch, "gbt", encoded, "churn", p)
    assert abs(auc.evaluate(own.score(encoded, ["churn"])) - auc.evaluate(spark_own.score(encoded, ["churn"]))) < 0.02


def test_any_cut_into_blocks_is_the_same_table(spark, encoded):
    """A column that holds other values than 0 and 1 in one block only is no bit there alone."""
    odd = encoded.repartitionByRange(7, "id").select("churn", F.when(F.col("id") < 20, 0.0).otherwise(1.0).alias("a"),
                                                     (F.col("id") / 3).alias("b"), "id", FE.FEATURES)
    from pyspark.ml.feature import VectorAssembler
    wide = VectorAssembler(inputCols=["a", "b", FE.FEATURES], outputCol="all").transform(odd) \
        .withColumn("b2", F.when(F.col("id") < 500, F.col("id") % 2).otherwise(0.25)).drop(FE.FEATURES)
    wide = VectorAssembler(inputCols=["all", "b2"], outputCol=FE.FEATURES).transform(wide)
    blocks = [(r.id, bytes(r.block)) for r in B.pack(wide, "churn", F.col("id") % 5 == 0).collect()]
    assert len(blocks) == 7
    rows = B._Rows(list(blocks))
    want = np.array([r[0].toArray() for r in wide.orderBy("id").select(FE.FEATURES).collect()])
    order = np.argsort(rows.column(1))
    assert all(np.array_equal(rows.column(j)[order].astype(float), want[:, j]) for j in range(want.shape[1]))
    assert rows.bit[0] and not rows.bit[-1] and rows.held.sum() == 120
    x = np.concatenate([B.dense(b)[0] for _, b in sorted(blocks)])
    assert np.array_equal(x[order], want)


def test_roc_auc_is_that_of_spark(spark):
    r = np.random.default_rng(2)
    y, s = r.random(400) < 0.3, np.round(r.random(400), 2)  # many ties
    d = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, s)], "label double, score double")
    auc = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert B.roc_auc(y, s) == pytest.approx(auc.evaluate(d), abs=1e-12)
    assert B.roc_auc(np.ones(5, bool), s[:5]) == 1.0 and B.roc_auc(np.zeros(5, bool), s[:5]) == 0.0


def test_larger_tables_are_fitted_by_spark(encoded, data, pipe, monkeypatch):
    monkeypatch.setattr(B, "FIT_BYTES", 1000)
    asked = []
    monkeypatch.setattr(B, "fit_in_one_task", lambda *a: asked.append(1))
    fm = M.fit_model("gbt", encoded, "churn", {"n_estimators": 2})
    assert len(scores(fm, encoded)) == 600 and not asked
    from tabwatch.operators import split as S
    table, _ = M.tune("gbt", S.stratified_folds(data, "id", "churn", 2), pipe, "churn", "fold",
                      trials=[{"n_estimators": 2, "max_depth": 2}])
    assert 0.5 < table.first().mean_roc_auc <= 1.0


def test_a_search_fits_many_models_a_task(spark, data, pipe, monkeypatch):
    """No Spark fit for each trial and fold: the jobs of a search do not grow with its trials."""
    from tabwatch.operators import split as S
    folds = S.stratified_folds(data, "id", "churn", 3).persist()
    monkeypatch.setattr(M, "fit_model", None)
    trials = [{"n_estimators": 5 + i, "max_depth": 2 + i % 3} for i in range(8)]
    table, best = M.tune("gbt", folds, pipe, "churn", "fold", trials=trials)
    rows = sorted(table.collect())
    assert [json.loads(r.params) for r in rows] == trials and all(0.6 < r.mean_roc_auc <= 1.0 for r in rows)
    assert best == trials[max(range(8), key=lambda i: rows[i].mean_roc_auc)]
    folds.unpersist()


def test_tuning_refuses_other_labels(data, pipe):
    odd = data.withColumn("fold", F.col("id") % 2).withColumn("churn", F.when(F.col("id") == 3, 2).otherwise(F.col("churn")))
    with pytest.raises(Exception, match="0 nor 1|must be 0 or 1"):
        M.tune("gbt", odd, pipe, "churn", "fold", trials=[{"n_estimators": 1}])


def test_the_registered_search_has_all_its_trials(spark):
    from tabwatch.plans import catalog
    rows = catalog.QUERIES["tuning_gbt"](spark, SF).collect()
    assert sorted(r.trial for r in rows) == list(range(30)) and all(0.0 <= r.mean_roc_auc <= 1.0 for r in rows)

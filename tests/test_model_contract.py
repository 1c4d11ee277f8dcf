"""Every registered model, a user's own too, keeps one contract: fitting, scores, threshold, saving."""

import numpy as np
import pytest
from pyspark.ml.classification import NaiveBayes, RandomForestClassifier
from pyspark.sql import functions as F

from tabwatch.operators import features as FE
from tabwatch.operators import models as M

FAST = {"logreg": {"max_iter": 20}, "gbt": {"n_estimators": 3, "max_depth": 2}, "mlp": {"hidden": [5], "max_iter": 20},
        "forest": {}, "bayes": {}}


def _forest(p, n):
    return RandomForestClassifier(featuresCol=FE.FEATURES, labelCol="label", numTrees=p["trees"], maxDepth=3,
                                  seed=p["seed"], **M._weight(p))


def _bayes(p, n):
    return NaiveBayes(featuresCol=FE.FEATURES, labelCol="label", modelType="gaussian", **M._weight(p))


@pytest.fixture(scope="module", autouse=True)
def own_models():
    M.register_model(M.ModelSpec("forest", _forest, "trees", {"trees": 5, "seed": 3}, lambda r: {"trees": r.randint(2, 6)}))
    M.register_model(M.ModelSpec("bayes", _bayes, "linear"))
    yield
    M.unregister_model("forest")
    M.unregister_model("bayes")


@pytest.fixture(scope="module")
def data(spark):
    r = np.random.default_rng(5)
    rows = [(i, float(x), int(x * 10) % 50, "abc"[i % 3], int(x + r.normal(0, 0.5) > 0.7))
            for i, x in enumerate(r.normal(0, 1, 240))]
    return spark.createDataFrame(rows, "id long, x double, tenure int, kind string, churn int").persist()


@pytest.fixture(scope="module")
def encoded(data):
    fm = FE.build_feature_pipeline(["x"], "tenure", ["kind"]).fit(data)
    return fm, fm.transform(data).select("id", "churn", FE.FEATURES).coalesce(1).persist()


@pytest.fixture(scope="module", params=sorted(FAST))
def fitted(request, encoded):
    return request.param, M.fit_model(request.param, encoded[1], "churn", FAST[request.param])


def scores(model, df, **kw):
    return {r.id: (r.score, r.prediction) for r in model.score(df, ["id"], **kw).collect()}


def test_one_score_for_each_row_between_0_and_1(fitted, encoded):
    got = scores(fitted[1], encoded[1])
    assert sorted(got) == list(range(240)) and all(0.0 <= s <= 1.0 for s, _ in got.values())


def test_prediction_is_score_at_least_threshold(fitted, encoded):
    model = fitted[1]
    cut = sorted(s for s, _ in scores(model, encoded[1]).values())[120]
    at = M.FittedModel(model.name, model.model, model.params, cut)
    got = scores(at, encoded[1])
    assert all(p == int(s >= cut) for s, p in got.values()) and any(s == cut and p == 1 for s, p in got.values())
    assert {i: s for i, (s, _) in got.items()} == {i: s for i, (s, _) in scores(model, encoded[1]).items()}


def test_it_learns_something(fitted, encoded):
    from tabwatch.operators.metrics import rank_metrics
    auc = rank_metrics(fitted[1].score(encoded[1], ["churn"]), [], "churn").first().roc_auc
    assert auc > 0.6


def test_fitting_again_gives_the_same(fitted, encoded):
    name, model = fitted
    again = M.fit_model(name, encoded[1], "churn", FAST[name])
    a, b = scores(model, encoded[1]), scores(again, encoded[1])
    assert max(abs(a[i][0] - b[i][0]) for i in a) < 1e-9


def test_columns_of_the_input_are_kept_unless_told(fitted, encoded):
    assert fitted[1].score(encoded[1]).columns == [*encoded[1].columns, "score", "prediction"]
    assert fitted[1].score(encoded[1], []).columns == ["score", "prediction"]


def test_no_rows_give_no_scores(fitted, encoded):
    assert fitted[1].score(encoded[1].limit(0)).count() == 0


def test_an_unseen_category_is_scored(fitted, encoded, data):
    odd = encoded[0].transform(data.withColumn("kind", F.lit("new")))
    assert len(scores(fitted[1], odd)) == 240


def test_saved_and_loaded_it_scores_the_same(fitted, encoded, tmp_dir):
    name, model = fitted
    back, features = M.FittedModel.load(model.save(f"{tmp_dir}/{name}", encoded[0]))
    assert (back.name, back.threshold, back.params) == (name, model.threshold, model.params)
    assert type(back.model) is type(model.model) and scores(back, encoded[1]) == scores(model, encoded[1])
    assert features.stages[0].output_cols() == encoded[0].stages[0].output_cols()


def test_labels_other_than_0_and_1_raise(fitted, encoded):
    name, _ = fitted
    if M.REGISTRY[name].weights:
        with pytest.raises(ValueError, match="neither"):
            M.fit_model(name, encoded[1].withColumn("churn", F.lit(2)), "churn", FAST[name])


def test_own_model_is_tuned_and_trained_by_name(data):
    from tabwatch.operators import split as S
    pipe = FE.build_feature_pipeline(["x"], "tenure", ["kind"])
    table, best = M.tune("forest", S.stratified_folds(data, "id", "churn", 2), pipe, "churn", "fold", n_trials=2)
    assert table.count() == 2 and set(best) == {"trees"}
    _, models, metrics = M.train_all(S.stratified_split(data, "id", "churn"), pipe, "churn", ["forest", "bayes"], key="id")
    assert set(models) == {"forest", "bayes"} and metrics.count() == 4


def test_names_are_taken_once(own_models):
    with pytest.raises(ValueError, match="already"):
        M.register_model(M.ModelSpec("forest", _forest, None))
    with pytest.raises(ValueError, match="weight kind"):
        M.register_model(M.ModelSpec("odd", _forest, "sideways"))
    old = M.REGISTRY["forest"]
    assert M.register_model(old, replace=True) is old
    M.unregister_model("not there")


def test_other_folders_are_refused(spark, tmp_dir):
    spark.range(3).write.parquet(f"{tmp_dir}/x")
    with pytest.raises(TypeError, match="not a saved"):
        M.load_stage(f"{tmp_dir}/x")
    with pytest.raises(TypeError, match="not a saved"):
        M.FittedModel.load(f"{tmp_dir}/x")

"""Networks fitted from packed blocks: gradient, steps, saved weights, the registered search."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from tabwatch.operators import blocks as B
from tabwatch.operators import features as FE
from tabwatch.operators import models as M
from tabwatch.operators import split as S
from tests.test_blocks import SF, data, encoded, pipe, scores  # noqa: F401


def test_network_gets_as_far_as_spark_in_as_many_steps(encoded):  # noqa: F811
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    n = M._n_features(encoded)
    p = {"hidden": [6, 3], "max_iter": 30, "seed": 5}
    x, y, _ = B.dense(bytes(B.pack(encoded, "churn").first().block))
    start = B.first_weights(shape := B.layers(p, n), 5)
    theirs = MultilayerPerceptronClassifier(featuresCol=FE.FEATURES, labelCol="churn", layers=shape, maxIter=30,
                                            initialWeights=Vectors.dense(start)).fit(encoded).weights.toArray()
    own = B.minimise(lambda t: (lambda s: (float(s[0]), s[1:]))(B.loss_and_gradient(t, shape, x, y) / len(y)), start, 30)
    a, b, first = (B.loss_and_gradient(t, shape, x, y)[0] / len(y) for t in (own, theirs, start))
    assert a < b + 0.05 * (first - b)


def test_gradient_is_that_of_the_loss():
    r = np.random.default_rng(0)
    shape, x, y = [3, 4, 2], r.normal(size=(50, 3)), r.random(50) < 0.4
    t = B.first_weights(shape, 1)
    g = B.loss_and_gradient(t, shape, x, y)[1:]
    for i in range(0, len(t), 3):
        e = np.zeros(len(t))
        e[i] = 1e-5
        slope = (B.loss_and_gradient(t + e, shape, x, y)[0] - B.loss_and_gradient(t - e, shape, x, y)[0]) / 2e-5
        assert slope == pytest.approx(g[i], abs=1e-5)


def test_saved_network_scores_as_it_was_fitted(encoded):  # noqa: F811
    fm = M.fit_model("mlp", encoded, "churn", {"hidden": [5], "max_iter": 10})
    x, _, _ = B.dense(bytes(B.pack(encoded, "churn").first().block))
    want = B._forward(x, B._unpacked(fm.model.weights.toArray(), [x.shape[1], 5, 2]))[-1][:, 1]
    got = scores(fm, encoded)
    assert np.allclose([got[r.id] for r in encoded.select("id").collect()], want)


def test_networks_by_steps_are_those_of_one_task(encoded, monkeypatch):  # noqa: F811
    p = {"hidden": [5], "max_iter": 8}
    one = M.fit_model("mlp", encoded, "churn", p).model.weights.toArray()
    monkeypatch.setattr(B, "ONE_TASK_BYTES", 0)
    monkeypatch.setattr(B, "FIT_BYTES", 0)  # steps need no bound
    steps = M.fit_model("mlp", encoded.repartition(3), "churn", p).model.weights.toArray()
    assert np.allclose(one, steps, atol=1e-6)


def test_a_search_fits_many_networks_a_task(spark, data, pipe, monkeypatch):  # noqa: F811
    folds = S.stratified_folds(data, "id", "churn", 3).persist()
    monkeypatch.setattr(M, "fit_model", None)
    trials = [{"hidden": [3 + i], "max_iter": 10} for i in range(8)]
    table, best = M.tune("mlp", folds, pipe, "churn", "fold", trials=trials)
    rows = sorted(table.collect())
    assert len(rows) == 8 and all(0.6 < r.mean_roc_auc <= 1.0 for r in rows)
    assert best == trials[max(range(8), key=lambda i: rows[i].mean_roc_auc)]
    folds.unpersist()


def test_registered_search_of_networks_has_all_its_trials(spark):
    from tabwatch.plans import catalog
    rows = catalog.QUERIES["tuning_mlp"](spark, SF).collect()
    assert sorted(r.trial for r in rows) == list(range(30)) and all(0.0 <= r.mean_roc_auc <= 1.0 for r in rows)

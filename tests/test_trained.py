"""Training of all models: fits without a Spark job a tree or step, scores made once."""

import pytest
from pyspark.ml.classification import GBTClassifier, MultilayerPerceptronClassifier
from pyspark.sql import functions as F

from tabwatch.operators import features as FE
from tabwatch.operators import models as M
from tabwatch.sources import telco as T
from tests.conftest import telco_rows


@pytest.fixture(scope="module")
def data(spark):
    rows = T.preprocess(spark.createDataFrame(telco_rows(300)))
    return rows.withColumn("split", F.expr("element_at(array('train', 'val', 'test'), 1 + (tenure % 3))"))


def test_trees_and_networks_take_no_spark_fit_and_scores_are_stored(spark, data, monkeypatch):
    def refuse(*args, **options):
        raise AssertionError("a job for each level or step")

    monkeypatch.setattr(GBTClassifier, "fit", refuse)
    monkeypatch.setattr(MultilayerPerceptronClassifier, "fit", refuse)
    seen, metrics_of = [], M.classification_metrics

    def recorded(scored, *args, **options):
        seen.append((scored.is_cached, scored.count()))
        return metrics_of(scored, *args, **options)

    monkeypatch.setattr(M, "classification_metrics", recorded)
    pipe = FE.build_feature_pipeline(T.NUMERICAL, "tenure", T.CATEGORICAL)
    _, fitted, metrics = M.train_all(data, pipe, "churn", ["logreg", "gbt", "mlp"],
                                     params={"gbt": {"n_estimators": 5}, "mlp": {"max_iter": 10}})
    n = data.where("split <> 'train'").count()
    assert seen == [(True, 3 * n)] and list(fitted) == ["logreg", "gbt", "mlp"]
    rows = {(r.model, r.split): r for r in metrics.collect()}
    assert set(rows) == {(m, s) for m in fitted for s in ("val", "test")}


def test_the_gate_reads_stored_scores(spark, monkeypatch):
    from tabwatch.plans import catalog

    sf = "/root/testdata/sf0.001"
    rows = catalog._split(spark, sf)
    monkeypatch.setattr(catalog, "_trained", lambda *a: (catalog._identity(), {"linear": catalog.LINEAR}, None, rows))
    want = catalog.QUERIES["linear_quality_gate"](spark, sf).collect()
    plans, gate = [], catalog.BH.quality_gate
    monkeypatch.setattr(catalog.BH, "quality_gate", lambda s, *a, **k: plans.append(
        s._jdf.queryExecution().optimizedPlan().toString()) or gate(s, *a, **k))
    assert catalog.QUERIES["quality_gate"](spark, sf).collect() == want
    assert plans[0].startswith("LogicalRDD") and len(plans[0].strip().splitlines()) == 1

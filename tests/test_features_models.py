import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwatch.operators import behavior as B
from tabwatch.operators import features as FE
from tabwatch.operators import models as M
from tabwatch.sources import telco as T
from tests.conftest import telco_rows


@pytest.fixture(scope="module")
def processed(spark):
    return T.preprocess(spark.createDataFrame(telco_rows(300)))


@pytest.fixture(scope="module")
def fitted(processed):
    return FE.build_feature_pipeline(T.NUMERICAL, "tenure", T.CATEGORICAL).fit(processed)


def test_population_scaler(spark):
    df = spark.createDataFrame([(0.0,), (12.0,), (24.0,), (48.0,)], "x double")
    m = FE.PopulationScaler(inputCols=["x"]).fit(df)
    assert m.getOrDefault("stds")[0] == pytest.approx(np.std([0, 12, 24, 48]))
    out = [r.numerical__x for r in m.transform(df).collect()]
    assert np.mean(out) == pytest.approx(0.0) and np.std(out) == pytest.approx(1.0)
    const = FE.PopulationScaler(inputCols=["x"]).fit(spark.createDataFrame([(3.0,), (3.0,)], "x double"))
    assert const.getOrDefault("stds") == [1.0]


def test_width_and_names(fitted, processed):
    names = FE.feature_names(fitted)
    n_cat = sum(len(T._DOMAINS[c]) for c in T.CATEGORICAL)
    assert len(names) == 4 + 4 + n_cat
    assert names[:4] == [f"numerical__{c}" for c in T.NUMERICAL]
    assert "tenure_bucket__tenure_bucket_0" in names and "categorical__gender_Female" in names
    v = fitted.transform(processed).select(FE.FEATURES).first()[0]
    assert len(v) == len(names)


def test_unseen_category_all_zeros(spark, fitted, processed):
    row = processed.limit(1).withColumn("gender", F.lit("Other"))
    v = fitted.transform(row).select(FE.FEATURES).first()[0].toArray()
    names = FE.feature_names(fitted)
    g = [i for i, n in enumerate(names) if n.startswith("categorical__gender_")]
    assert all(v[i] == 0.0 for i in g)


def test_wide_encode_matches_vector(fitted, processed):
    wide = FE.wide_encode(processed, fitted).first()
    vec = fitted.transform(processed).select(FE.FEATURES).first()[0].toArray()
    names = FE.feature_names(fitted)
    assert np.allclose([wide[n] for n in names], vec)


def test_save_load_round_trip(spark, fitted, processed, tmp_dir):
    path = f"{tmp_dir}/fp"
    FE.save_pipeline(fitted, path)
    back = FE.load_pipeline(path)
    a = fitted.transform(processed).select(FE.FEATURES).collect()
    b = back.transform(processed).select(FE.FEATURES).collect()
    assert a == b
    with pytest.raises(TypeError):
        FE.load_pipeline(f"{tmp_dir}/nothing_here")


def test_class_weights(spark):
    df = spark.createDataFrame([(1,)] * 25 + [(0,)] * 75, "y int")
    t = {r.y: r for r in M.class_weight_table(df, "y").collect()}
    assert t[1].weight_linear == pytest.approx(100 / 50) and t[0].weight_linear == pytest.approx(100 / 150)
    assert t[1].weight_trees == pytest.approx(3.0) and t[0].weight_trees == 1.0
    w = M.with_class_weights(spark.createDataFrame([(0,)] * 4, "y int"), "y", "trees")
    assert {r.weight for r in w.collect()} == {1.0}


@pytest.mark.parametrize("name,params", [("logreg", None), ("mlp", {"max_iter": 20}),
                                         ("gbt", {"n_estimators": 5})])
def test_model_contract(spark, fitted, processed, name, params):
    enc = fitted.transform(processed)
    fm = M.fit_model(name, enc, "churn", params)
    out = fm.score(enc, keep=["churn"]).collect()
    assert len(out) == processed.count()
    assert all(0.0 <= r.score <= 1.0 for r in out)
    assert all(r.prediction == int(r.score >= 0.5) for r in out)
    fm.threshold = 0.0
    assert all(r.prediction == 1 for r in fm.score(enc, keep=["churn"]).collect())


def test_registry_and_quality_gate(spark, fitted, processed):
    assert set(M.REGISTRY) >= {"logreg", "gbt", "mlp"}
    enc = fitted.transform(processed)
    fm = M.fit_model("logreg", enc, "churn")
    scored = fm.score(enc, keep=["churn"]).withColumn("model", F.lit("logreg"))
    g = B.quality_gate(scored, label="churn").first()
    assert g.roc_auc > 0.6 and g.score_std > 0.05
    inv = B.invariance(processed, fitted, fm, "gender", "Female", "Male").first()
    assert inv.n == processed.count() and inv.max_abs_change >= inv.mean_abs_change
    d = B.directional(processed, fitted, fm, F.col("tenure") >= 48, "TotalCharges", 1.5).first()
    assert d.n_cohort == processed.where("tenure >= 48").count()


def test_train_all_and_batch_scoring(spark, processed):
    from tabwatch.operators import contracts as C
    from tabwatch.operators import scoring as SC
    from tabwatch.operators import split as S
    data = S.stratified_split(processed.withColumn("id", F.monotonically_increasing_id()),
                              "id", "churn")
    pipe = FE.build_feature_pipeline(T.NUMERICAL, "tenure", T.CATEGORICAL)
    fm, fitted, metrics = M.train_all(data, pipe, "churn", ["logreg"], key="id")
    rows = {(r.model, r.split): r for r in metrics.collect()}
    assert set(rows) == {("logreg", "val"), ("logreg", "test")}
    assert all(0.0 <= r.brier <= 1.0 and r.roc_auc is not None for r in rows.values())
    raw = data.drop("churn", "split").withColumn(
        "tenure", F.when(F.col("id") == F.lit(0), F.lit(150)).otherwise(F.col("tenure")))
    scored, bad = SC.score_batch(raw, T.SCORING_CONTRACT, T.preprocess_scoring, fm,
                                 fitted["logreg"], ["id"])
    assert scored.count() + bad.count() == raw.count()
    assert bad.count() == raw.where("tenure > 100").count()
    r = scored.first()
    assert r.prediction == int(r.probability >= 0.5) and r.threshold == 0.5


def test_tuning_trials(spark, processed):
    from tabwatch.operators import split as S
    folds = S.stratified_folds(processed.withColumn("id", F.monotonically_increasing_id()),
                               "id", "churn", k=2)
    pipe = FE.build_feature_pipeline(T.NUMERICAL, "tenure", T.CATEGORICAL)
    table, best = M.tune("logreg", folds, pipe, "churn", "fold", n_trials=2, seed=1)
    rows = table.collect()
    assert len(rows) == 2 and all(0.0 <= r.mean_roc_auc <= 1.0 for r in rows)
    assert set(best) == {"C", "balanced"}
    again, _ = M.tune("logreg", folds, pipe, "churn", "fold", n_trials=2, seed=1)
    assert [r.params for r in again.collect()] == [r.params for r in rows]


def test_tuning_fits_every_model(spark, processed):
    """Real fits of all three models: each trial's mean is that of its folds fitted one by one."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    from tabwatch.operators import split as S
    folds = S.stratified_folds(processed.withColumn("id", F.monotonically_increasing_id()),
                               "id", "churn", k=2).persist()
    pipe = FE.build_feature_pipeline(T.NUMERICAL, "tenure", T.CATEGORICAL)
    given = {"logreg": [{"C": 0.01, "balanced": False}, {"C": 1.0, "balanced": True}],
             "gbt": [{"n_estimators": 2, "max_depth": 2}, {"n_estimators": 4, "max_depth": 3}],
             "mlp": [{"hidden": [4], "max_iter": 3}, {"hidden": [6, 3], "max_iter": 20}]}
    auc = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    for name, trials in given.items():
        table, best = M.tune(name, folds, pipe, "churn", "fold", trials=trials)
        rows = sorted(table.collect())
        assert [json.loads(r.params) for r in rows] == trials and best in trials
        assert best == trials[max((0, 1), key=lambda i: rows[i].mean_roc_auc)]
        k, want = 1, 0.0
        for f in (0, 1):
            rest = folds.where(F.col("fold") != f).withColumn("label", F.col("churn").cast("double"))
            fm = pipe.fit(rest)
            enc = fm.transform(rest).select("label", FE.FEATURES).coalesce(1)
            held = fm.transform(folds.where(F.col("fold") == f)).withColumn("label", F.col("churn").cast("double"))
            want += auc.evaluate(M.fit_model(name, enc, "label", trials[k]).score(held, ["label"])) / 2
        assert abs(rows[k].mean_roc_auc - want) < 0.02
    folds.unpersist()


def test_small_folds_are_one_task_and_large_ones_many(spark):
    d = spark.range(0, 1000, 1, 7).select(F.col("id").cast("double").alias("label"))
    assert M.compact(d, 10).rdd.getNumPartitions() == 1
    assert M.compact(d, 10, task_bytes=20_000).rdd.getNumPartitions() == 5
    assert M.compact(d, 10, task_bytes=10).rdd.getNumPartitions() == 7
    assert M.compact(d.limit(0), 10).count() == 0


def test_train_all_fits_on_few_partitions(spark, processed, monkeypatch):
    """A fit is hundreds of jobs: each has the tasks that its bytes ask for, not a task per shuffle partition."""
    data = processed.withColumn("split", F.expr("element_at(array('train', 'val', 'test'), 1 + (tenure % 3))")) \
        .repartition(40)
    seen, fit = [], M.fit_model

    def recorded(name, train, *args, **options):
        seen.append((name, train.rdd.getNumPartitions(), train.count()))
        return fit(name, train, *args, **options)

    monkeypatch.setattr(M, "fit_model", recorded)
    pipe = FE.build_feature_pipeline(T.NUMERICAL, "tenure", T.CATEGORICAL)
    _, fitted, metrics = M.train_all(data, pipe, "churn", ["logreg", "gbt"], params={"gbt": {"n_estimators": 2}})
    n = data.where("split = 'train'").count()
    assert sorted(seen) == [("gbt", 1, n), ("logreg", 1, n)]
    assert list(fitted) == ["logreg", "gbt"] and metrics.count() == 4


def test_tuning_counts_the_labels_once_a_fold(spark, processed, monkeypatch):
    from tabwatch.operators import split as S
    folds = S.stratified_folds(processed.withColumn("id", F.monotonically_increasing_id()), "id", "churn", k=2)
    pipe = FE.build_feature_pipeline(T.NUMERICAL, "tenure", T.CATEGORICAL)
    trials = [{"C": 1.0, "balanced": True}, {"C": 0.1, "balanced": False}, {"C": 0.01, "balanced": True}]
    asked, count = [], M.label_counts
    monkeypatch.setattr(M, "label_counts", lambda *a: asked.append(1) or count(*a))
    table, _ = M.tune("logreg", folds, pipe, "churn", "fold", trials=trials)
    assert len(asked) == 2 and table.count() == 3


def test_sum_of_weights_is_that_of_the_rows(spark):
    d = spark.createDataFrame([(1.0,)] * 3 + [(0.0,)] * 7, "y double")
    c = M.label_counts(d, "y")
    for kind in ("linear", "trees"):
        one, zero = c.weights(kind)
        rows = M.with_class_weights(d, "y", kind).agg(F.sum(M.WEIGHT)).first()[0]
        assert one * c.pos + zero * c.neg == pytest.approx(rows, rel=1e-14)


def test_compact_uses_idle_cores(spark):
    d = spark.range(0, 1000, 1, 7).select(F.col("id").cast("double").alias("label"))
    wide = 1_500  # 12 MB as the frame's bytes are counted
    assert M.compact(d, wide).rdd.getNumPartitions() == 1
    assert M.compact(d, wide, cores=2).rdd.getNumPartitions() == 2
    assert M.compact(d, wide, cores=12).rdd.getNumPartitions() == 3


def test_saved_models_belong_to_the_application(spark, monkeypatch, tmp_path):
    from pyspark.errors import AnalysisException

    from tabwatch.plans import catalog

    state = catalog._source_state(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr("tabwatch.session.ensure_checkpoint_dir", lambda s: f"file://{tmp_path}")
    spark.range(1).write.parquet(f"file://{tmp_path}/tabwatch-models-{state}/metrics")  # another session's
    asked = []

    def train(*args, **options):
        asked.append(1)
        raise AnalysisException("trains")

    monkeypatch.setattr(catalog.MD, "train_all", train)
    with pytest.raises(AnalysisException, match="trains"):
        catalog._trained(spark, "/root/testdata/sf0.001")
    assert asked


def test_checks_read_the_rows_kept_with_the_models(spark, monkeypatch):
    from tabwatch.plans import catalog

    sf = "/root/testdata/sf0.001"
    rows = catalog._split(spark, sf)
    want = catalog.QUERIES["linear_directional"](spark, sf).collect()
    monkeypatch.setattr(catalog, "_trained", lambda *a: (catalog._identity(), {"logreg": catalog.LINEAR}, None, rows))
    monkeypatch.setattr(catalog, "_split", None)  # the orders are not aggregated and split again
    got = catalog.QUERIES["directional_check"](spark, sf).drop("model").collect()
    assert got == want and got[0].n_cohort > 0

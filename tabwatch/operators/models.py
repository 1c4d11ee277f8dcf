"""Model registry, class weights, training of all models, cross-validated tuning.

Estimators are Spark ML; the contract of a fitted model is a ``score`` column (probability of
the positive class) and ``prediction = score >= threshold`` (Spark's own ``thresholds`` uses
>, so it is not used).
"""

from __future__ import annotations

import importlib
import json
import math
import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwatch.operators import blocks as B
from tabwatch.operators.features import FEATURES, load_pipeline, save_pipeline
from tabwatch.operators.metrics import classification_metrics
from tabwatch.session import ensure_checkpoint_dir

WEIGHT = "weight"


@dataclass(frozen=True)
class LabelCounts:
    """Rows of a frame by label; ``n`` counts labels other than 0 and 1 too."""
    pos: int
    neg: int
    n: int

    def weights(self, kind: str) -> tuple[float, float]:
        """Weights of a positive and of a negative row; a label other than 0 and 1 raises."""
        if kind not in ("linear", "trees"):
            raise ValueError(f"unknown weight kind {kind!r}")
        if self.pos + self.neg != self.n:
            raise ValueError(f"{self.n - self.pos - self.neg} label(s) are neither 0 nor 1")
        if kind == "linear":
            return tuple(float(self.n / (2.0 * c) if c else 1.0) for c in (self.pos, self.neg))
        return float(self.neg / self.pos if self.pos else 1.0), 1.0


def label_counts(df: DataFrame, label: str) -> LabelCounts:
    """One aggregate."""
    y = F.col(label)
    return LabelCounts(*df.agg(F.count_if(y == 1), F.count_if(y == 0), F.count(F.lit(1))).first())


def with_class_weights(df: DataFrame, label: str, kind: str = "linear",
                       out: str = WEIGHT, counts: LabelCounts | None = None) -> DataFrame:
    """F1. linear: n / (2 n_c) per class ('balanced'); trees: n_neg / n_pos on positives and
    1.0 on negatives (1.0 everywhere when there are no positives). One aggregate counts the
    classes unless their ``counts`` are given; the weights are literals. A label other than 0 and
    1 raises."""
    one, zero = (counts or label_counts(df, label)).weights(kind)
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(one)).otherwise(F.lit(zero)))


def _class_counts(df: DataFrame, label: str) -> DataFrame:
    """label, n, _n, _pos, _neg: class counts (one row per label value; more than two raise when
    the table is computed) with totals from a window over that tiny table."""
    every = Window.partitionBy()
    y = F.when(F.col(label).isin(0, 1), F.col(label)).otherwise(
        F.raise_error(F.lit("a label must be 0 or 1")).cast(df.schema[label].dataType))
    counts = df.select(y.alias(label)).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        label, "n", F.sum("n").over(every).alias("_n"),
        F.coalesce(F.sum(F.when(F.col(label) == 1, F.col("n"))).over(every), F.lit(0)).alias("_pos"),
        F.coalesce(F.sum(F.when(F.col(label) == 0, F.col("n"))).over(every), F.lit(0)).alias("_neg"))


def class_weight_table(df: DataFrame, label: str) -> DataFrame:
    """label, n, weight_linear, weight_trees."""
    return _class_counts(df, label).select(
        label, "n", (F.col("_n") / (F.lit(2.0) * F.col("n"))).alias("weight_linear"),
        F.when((F.col(label) == 1) & (F.col("_pos") > 0), F.col("_neg") / F.col("_pos"))
        .otherwise(F.lit(1.0)).alias("weight_trees"))


@dataclass
class ModelSpec:
    """Registry entry: how to build the estimator and which class weights it uses. ``learner``: what
    fits it from packed blocks (``blocks.Trees``, ``blocks.Networks``); without one the estimator does."""
    name: str
    build: Callable[[dict, int], object]        # (params, n_features) -> Spark estimator
    weights: str | None                          # 'linear' | 'trees' | None
    defaults: dict = field(default_factory=dict)
    space: Callable[[random.Random], dict] | None = None
    learner: type | None = None


def _weight(p: dict) -> dict:
    return {"weightCol": p["weight_col"]} if p.get("weight_col") else {}


def _logreg(p: dict, n_features: int):
    # sklearn minimises C * sum(w loss) + 0.5 ||b||^2; Spark averages the weighted loss, so
    # regParam = 1 / (C * sum(w)). ``sum_w`` is filled in by ``fit_model``.
    return LogisticRegression(featuresCol=FEATURES, labelCol="label", **_weight(p),
                              maxIter=p["max_iter"], elasticNetParam=0.0, standardization=False,
                              regParam=1.0 / (p["C"] * p["sum_w"]))


def _gbt(p: dict, n_features: int):
    return GBTClassifier(featuresCol=FEATURES, labelCol="label", **_weight(p),
                         maxIter=p["n_estimators"], stepSize=p["learning_rate"],
                         maxDepth=p["max_depth"], subsamplingRate=p["subsample"],
                         featureSubsetStrategy=str(p["colsample"]), seed=p["seed"], maxBins=64)


def _mlp(p: dict, n_features: int):
    return MultilayerPerceptronClassifier(
        featuresCol=FEATURES, labelCol="label", layers=[n_features, *p["hidden"], 2],
        maxIter=p["max_iter"], blockSize=p["batch_size"], stepSize=p["lr"], seed=p["seed"])


def _logreg_space(r: random.Random) -> dict:
    return {"C": 10 ** r.uniform(-3, 1), "balanced": r.choice([False, True])}


def _gbt_space(r: random.Random) -> dict:
    return {"n_estimators": r.randrange(100, 501, 50), "learning_rate": 10 ** r.uniform(-2, math.log10(0.3)),
            "max_depth": r.randint(3, 8), "subsample": r.uniform(0.7, 1.0),
            "colsample": round(r.uniform(0.7, 1.0), 3)}


def _mlp_space(r: random.Random) -> dict:
    return {"hidden": r.choice([[32, 16], [64, 32], [128, 64]]), "lr": 10 ** r.uniform(-4, -2),
            "max_iter": r.randrange(10, 51, 5) * 5, "batch_size": r.choice([128, 256, 512])}


# Search ranges above and defaults below.
# Registry: name -> spec. Defaults mirror the reference's settings where Spark has the knob
# (no L2 on leaves for Spark GBT, sigmoid hidden units and no dropout for Spark's MLP).
REGISTRY: dict[str, ModelSpec] = {
    "logreg": ModelSpec("logreg", _logreg, "linear", {"C": 1.0, "max_iter": 1000, "balanced": True},
                        _logreg_space),
    "gbt": ModelSpec("gbt", _gbt, "trees", {"n_estimators": 300, "learning_rate": 0.05,
                                            "max_depth": 4, "subsample": 0.9, "colsample": 0.9,
                                            "seed": 42}, _gbt_space, B.Trees),
    "mlp": ModelSpec("mlp", _mlp, None, {"hidden": [64, 32], "max_iter": 150, "batch_size": 256,
                                         "lr": 0.03, "seed": 42}, _mlp_space, B.Networks),
}


def register_model(spec: ModelSpec, replace: bool = False) -> ModelSpec:
    """Add a model to the registry: fit_model, train_all and tune then know it by name, and it is
    saved and loaded like the others. The estimator must give a ``probability`` vector of two
    classes. A name that is taken raises unless ``replace``; so does an unknown weight kind."""
    if spec.name in REGISTRY and not replace:
        raise ValueError(f"a model named {spec.name!r} is registered already")
    if spec.weights not in (None, "linear", "trees"):
        raise ValueError(f"unknown weight kind {spec.weights!r}")
    REGISTRY[spec.name] = spec
    return spec


def unregister_model(name: str) -> None:
    """Take a model out of the registry; saved models of that name can still be loaded."""
    REGISTRY.pop(name, None)


MODEL_VERSION = 1
_TAG = "tabwatch.FittedModel"


def load_stage(path: str):
    """A saved Spark ML stage, of the class that its own metadata name: Spark's classes by
    their Java name, a user's Python stages by module and class. Refuses other folders."""
    try:
        meta = json.loads(SparkSession.getActiveSession().read.text(f"{path}/metadata").first()[0])
        module, _, name = meta["class"].rpartition(".")
    except Exception as e:  # noqa: BLE001
        raise TypeError(f"{path} is not a saved stage: {e}") from e
    module = module.replace("org.apache.spark.ml", "pyspark.ml", 1)
    kind = getattr(importlib.import_module(module), name, None)
    if kind is None or not hasattr(kind, "load"):
        raise TypeError(f"{path} holds {meta['class']}, which has no loader")
    return kind.load(path)


@dataclass
class FittedModel:
    name: str
    model: object
    params: dict
    threshold: float = 0.5

    def score(self, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
        """Input columns (or ``keep``) + score + prediction (score >= threshold)."""
        cols = list(keep) if keep is not None else [c for c in df.columns]
        out = self.model.transform(df)
        return out.select(*cols, vector_to_array("probability")[1].alias("score")) \
            .withColumn("prediction", (F.col("score") >= F.lit(self.threshold)).cast("int"))

    def save(self, path: str, features: PipelineModel) -> str:
        """the model with the features it was fitted on, its threshold and a version, so that
        another process scores as this one does."""
        path = path.rstrip("/")
        save_pipeline(features, f"{path}/features")
        self.model.write().overwrite().save(f"{path}/model")
        meta = json.dumps({"class": _TAG, "version": MODEL_VERSION, "name": self.name,
                           "model_class": type(self.model).__name__, "params": self.params,
                           "threshold": self.threshold})
        SparkSession.getActiveSession().createDataFrame([(meta,)], "value string").coalesce(1) \
            .write.mode("overwrite").text(f"{path}/meta")
        return path

    @staticmethod
    def load(path: str) -> "tuple[FittedModel, PipelineModel]":
        """(model, features); refuses folders that are no saved model of this version."""
        path = path.rstrip("/")
        try:
            meta = json.loads(SparkSession.getActiveSession().read.text(f"{path}/meta").first()[0])
        except Exception as e:  # noqa: BLE001
            raise TypeError(f"{path} is not a saved model: {e}") from e
        if meta.get("class") != _TAG or meta.get("version") != MODEL_VERSION:
            raise TypeError(f"{path} holds {meta.get('class')} version {meta.get('version')}, "
                            f"expected {_TAG} version {MODEL_VERSION}")
        model = load_stage(f"{path}/model")
        return (FittedModel(meta["name"], model, meta["params"], meta["threshold"]),
                load_pipeline(f"{path}/features"))


@dataclass
class LinearModel(FittedModel):
    """Logistic scores from given coefficients of plain numeric columns and offsets of category
    values: a model that SQL can state, scored by the same code paths as fitted ones."""
    bias: float = 0.0
    weights: dict[str, float] = field(default_factory=dict)
    offsets: dict[str, dict[str, float]] = field(default_factory=dict)

    def score(self, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
        z = F.lit(float(self.bias))
        for c, w in self.weights.items():
            z = z + F.lit(float(w)) * F.col(c).cast("double")
        for c, values in self.offsets.items():
            for v, w in values.items():
                z = z + F.when(F.col(c) == v, F.lit(float(w))).otherwise(F.lit(0.0))
        cols = list(keep) if keep is not None else df.columns
        return df.select(*cols, (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).alias("score")) \
            .withColumn("prediction", (F.col("score") >= F.lit(self.threshold)).cast("int"))


def _n_features(df: DataFrame) -> int:
    meta = df.schema[FEATURES].metadata.get("ml_attr", {})
    if "num_attrs" in meta:
        return int(meta["num_attrs"])
    return len(df.select(FEATURES).first()[0])


def fit_model(name: str, train: DataFrame, label: str = "label", params: dict | None = None,
              threshold: float = 0.5, counts: LabelCounts | None = None) -> FittedModel:
    """Fit one registry model on a frame holding ``features`` and the label. ``counts``: those of
    the label, if they are known."""
    spec = REGISTRY[name]
    p = {**spec.defaults, **(params or {})}
    d = train.withColumn("label", F.col(label).cast("double"))
    kind = spec.weights if p.get("balanced", True) else None
    counts = counts or label_counts(d, "label")
    p["sum_w"] = float(counts.n)
    if kind:
        d = with_class_weights(d, "label", kind, counts=counts)
        p["weight_col"] = WEIGHT
        one, zero = counts.weights(kind)
        p["sum_w"] = one * counts.pos + zero * counts.neg
    n_features = _n_features(d)
    est = spec.build(p, n_features)
    fitted = _fit_blocks(spec, est, d, p, counts, n_features) if spec.learner and counts.n else None
    return FittedModel(name, est.fit(d) if fitted is None else fitted, p, threshold)


def _fit_blocks(spec: ModelSpec, est, d: DataFrame, p: dict, counts: LabelCounts, n_features: int):
    """The model fitted from packed blocks; None if it is for its estimator to fit. Trees take one task
    and so a bounded table; a network's steps are jobs over the blocks of a table of any size."""
    weights = counts.weights(spec.weights if p.get("weight_col") else "linear")  # raises for other labels
    weights = weights if p.get("weight_col") else (1.0, 1.0)
    steps = spec.learner is B.Networks and counts.n * 8 * n_features > B.ONE_TASK_BYTES
    if not steps and not B.fits_one_task(counts.n * B.ROW_BYTES):
        return None
    packed = B.pack(d, "label").persist()
    try:
        if steps:
            got = B.fit_network_by_steps(packed, p, n_features, counts.n)
        elif B.fits_one_task(packed.agg(F.sum("bytes")).first()[0]):
            got = B.fit_in_one_task(spec.learner, packed, p, weights)
        else:
            return None
    finally:
        packed.unpersist()
    return spec.learner.model(d.sparkSession, est, got, n_features)


def train_all(data: DataFrame, feature_pipeline: Pipeline, label: str, models: Sequence[str],
              split_col: str = "split", key: str | None = None,
              params: dict[str, dict] | None = None) -> tuple[PipelineModel, dict, DataFrame]:
    """one feature fit on the train rows, the transformed table stored once, in few large
    partitions, and shared by every model; the models are fitted side by side (a fit is hundreds of
    jobs that follow each other); val and test scored by each model, once, and stored, since the
    metrics read the scores several times; metrics for all (model, split) from them. Returns (feature model, fitted models, metric table of a row per group)."""
    train = data.where(F.col(split_col) == "train")
    fmodel = feature_pipeline.fit(train)
    keep = [c for c in [key, label, split_col] if c]
    enc = fmodel.transform(data).select(*keep, FEATURES)
    enc = compact(enc, _n_features(enc), cores=data.sparkSession.sparkContext.defaultParallelism).persist()
    fit_on, scored = enc.where(F.col(split_col) == "train"), None
    try:
        with ThreadPool(max(1, len(models))) as pool:
            fitted = dict(zip(models, pool.map(
                lambda m: fit_model(m, fit_on, label, (params or {}).get(m)), models, chunksize=1)))
        for m, fm in fitted.items():
            s = fm.score(enc.where(F.col(split_col).isin("val", "test")), [label, split_col]) \
                .select(F.lit(m).alias("model"), split_col, F.col(label).alias("label"), "score")
            scored = s if scored is None else scored.unionByName(s)
        scored = scored.persist()
        metrics = classification_metrics(scored, ["model", split_col], key_bound=3 * len(models))
        rows = metrics.collect()  # a row per model and split
    finally:
        enc.unpersist()
        if scored is not None:
            scored.unpersist()
    return fmodel, fitted, data.sparkSession.createDataFrame(rows, metrics.schema)


#: Encoded rows that one task of a fit reads, about. Small frames are one task, whose overhead
#: would otherwise be most of a fit of hundreds of short jobs.
TASK_BYTES = 32 << 20
#: Where cores would idle, a task may have as little as this.
MIN_TASK_BYTES = 4 << 20


def compact(encoded: DataFrame, n_features: int, task_bytes: int = TASK_BYTES, cores: int = 1) -> DataFrame:
    """The frame stored by ``checkpoint()`` (its files outlive executors and cut the lineage that
    every job would carry along), in as many partitions as its bytes ask for. ``cores``: in as many
    as that if each still has MIN_TASK_BYTES."""
    ensure_checkpoint_dir(encoded.sparkSession)
    encoded = encoded.checkpoint()
    bytes_ = encoded.count() * 8 * (n_features + 2)
    return encoded.coalesce(max(1, math.ceil(bytes_ / task_bytes),
                                min(cores, math.ceil(bytes_ / MIN_TASK_BYTES))))


def tune(name: str, data: DataFrame, feature_pipeline: Pipeline, label: str, fold_col: str,
         n_trials: int = 30, seed: int = 42, parallelism: int | None = None,
         trials: Sequence[dict] | None = None) -> tuple[DataFrame, dict]:
    """F8: seeded random search over the model's space (or the given ``trials``), each trial scored
    by its mean exact ROC-AUC over the folds in ``fold_col``. Give it the train rows only.

    Features, class weights, the sum of weights and the input width are fitted on each fold's
    training rows, so nothing of the held-out fold leaks and a category that one fold lacks
    changes only that fold's width. A model with a ``learner`` is fitted from packed blocks, many fits to
    a task, while a fold fits in one (``blocks.FIT_BYTES``). Else each fold is encoded, stored and its labels counted once; then
    the fits of all folds and trials run side by side, ``parallelism`` at a time (8, or as many as
    it takes to use every core if a fit has few tasks), in a scheduler pool of the model's name
    (fair where ``spark.scheduler.mode`` is FAIR). A trial with ``balanced: false`` is
    fitted unweighted. Returns (trial table, best params); ties go to the first trial."""
    spec = REGISTRY[name]
    if trials is None:
        r = random.Random(seed)
        trials = [spec.space(r) for _ in range(n_trials)]
    data = data.withColumn("label", F.col(label).cast("double"))
    folds = sorted(x[0] for x in data.select(fold_col).distinct().collect())
    if len(folds) < 2:
        raise ValueError("tuning needs at least two folds")

    def encode(fold) -> tuple[DataFrame, DataFrame, LabelCounts]:
        rest, held = data.where(F.col(fold_col) != fold), data.where(F.col(fold_col) == fold)
        features = feature_pipeline.fit(rest)
        frames = [features.transform(d).select("label", FEATURES) for d in (rest, held)]
        n = _n_features(frames[0])
        train, valid = (compact(d, n).persist() for d in frames)
        return train, valid, label_counts(train, "label")

    auc = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    sc = data.sparkSession.sparkContext
    if spec.learner and (values := _tune_blocks(spec, data, feature_pipeline, fold_col, folds, trials)):
        return _trial_table(data, trials, folds, values)
    encoded = [encode(f) for f in folds]
    todo = [(t, f) for t in range(len(trials)) for f in range(len(folds))]

    def one(job: tuple[int, int]) -> float:
        train, valid, counts = encoded[job[1]]
        sc.setLocalProperty("spark.scheduler.pool", f"tune-{name}")
        return float(auc.evaluate(fit_model(name, train, "label", trials[job[0]], counts=counts).score(valid, ["label"])))

    if parallelism is None:
        parallelism = max(8, sc.defaultParallelism // encoded[0][0].rdd.getNumPartitions())
    try:
        with ThreadPool(max(1, min(parallelism, len(todo)))) as pool:
            values = pool.map(one, todo, chunksize=1)
    finally:
        for train, valid, _ in encoded:
            train.unpersist()
            valid.unpersist()
    return _trial_table(data, trials, folds, values)


def _tune_blocks(spec: ModelSpec, data: DataFrame, feature_pipeline: Pipeline, fold_col: str, folds: list,
                 trials: Sequence[dict]) -> list[float] | None:
    """ROC-AUC of the held rows by trial and fold, fitted from packed blocks, many fits to a task; None if
    a fold is too large for one."""
    cores = data.sparkSession.sparkContext.defaultParallelism
    data = data.where(F.col(fold_col).isNotNull())

    def encode(fold) -> tuple[DataFrame, int]:
        features = feature_pipeline.fit(data.where(F.col(fold_col) != fold))
        rows = features.transform(data).select("label", F.col(fold_col), FEATURES)
        return B.pack(rows, "label", F.col(fold_col) == fold).persist(), _n_features(rows)

    with ThreadPool(len(folds)) as pool:
        encoded = pool.map(encode, folds, chunksize=1)
    try:
        sizes = [e.agg(F.sum("pos"), F.sum("neg"), F.sum("n"), F.sum("bytes")).first() for e, _ in encoded]
        if not B.fits_one_task(max(s[3] for s in sizes)):
            return None
        counts = [LabelCounts(*s[:3]) for s in sizes]
        weights = [c.weights(spec.weights or "linear") for c in counts]  # raises for other labels
        packed = None
        for i, (e, _) in enumerate(encoded):
            e = e.withColumn("fold", F.lit(i))
            packed = e if packed is None else packed.unionByName(e)
        got = {}
        full = [{**spec.defaults, **t} for t in trials]
        for plain in {not t.get("balanced", True) or not spec.weights for t in full}:
            own = [i for i, t in enumerate(full) if (not t.get("balanced", True) or not spec.weights) == plain]
            aucs = B.held_aucs(spec.learner, packed, [full[i] for i in own], [(1.0, 1.0)] * len(folds) if plain else weights,
                               [n for _, n in encoded], max(s[3] for s in sizes), cores)
            got |= {(own[t], f): a for (t, f), a in aucs.items()}
    finally:
        for e, _ in encoded:
            e.unpersist()
    return [got[t, f] for t in range(len(trials)) for f in range(len(folds))]


def _trial_table(data: DataFrame, trials: Sequence[dict], folds: list, values: list[float]) -> tuple[DataFrame, dict]:
    means = [sum(values[t * len(folds):(t + 1) * len(folds)]) / len(folds) for t in range(len(trials))]
    rows = [(i, json.dumps(t, sort_keys=True), m) for i, (t, m) in enumerate(zip(trials, means))]
    table = data.sparkSession.createDataFrame(rows, "trial int, params string, mean_roc_auc double")
    return table, trials[max(range(len(trials)), key=lambda i: means[i])]

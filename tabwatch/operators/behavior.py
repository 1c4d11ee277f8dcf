"""Model-behaviour checks as table jobs: invariance, direction on a cohort, quality gate.

Both scores of a row come from transforming the same rows twice in one plan (the first
score is carried as a column), so no join on a key is needed."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwatch.functions.columns import swap_values
from tabwatch.operators.metrics import rank_metrics
from tabwatch.operators.models import FittedModel
from tabwatch.operators.prefix import join_null_safe

# Fixed values of the checks.
INVARIANCE_MEAN_MAX = 0.05
INVARIANCE_ABS_MAX = 0.10
DIRECTION_TOLERANCE = 1e-3
MIN_COHORT = 5
AUC_FLOOR = 0.80
AUC_CHANCE = 0.60
MIN_SCORE_STD = 0.05


def _score_twice(df: DataFrame, features: PipelineModel, model: FittedModel,
                 change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    cols = df.columns
    first = model.score(features.transform(df), keep=cols).withColumnRenamed("score", "_s0") \
        .drop("prediction")
    second = model.score(features.transform(change(first)), keep=[*cols, "_s0"])
    return second.select("_s0", F.col("score").alias("_s1"))


def invariance(df: DataFrame, features: PipelineModel, model: FittedModel, col: str,
               a: str, b: str) -> DataFrame:
    """One row: n, mean_abs_change, max_abs_change, passed (mean <= 0.05, max <= 0.10)
    after exchanging values a and b of ``col``."""
    s = _score_twice(df, features, model, lambda d: d.withColumn(col, swap_values(col, {a: b, b: a})))
    d = F.abs(F.col("_s1") - F.col("_s0"))
    return s.agg(F.count(F.lit(1)).alias("n"), F.avg(d).alias("mean_abs_change"),
                 F.max(d).alias("max_abs_change")).withColumn(
        "passed", (F.col("mean_abs_change") <= INVARIANCE_MEAN_MAX)
        & (F.col("max_abs_change") <= INVARIANCE_ABS_MAX))


def directional(df: DataFrame, features: PipelineModel, model: FittedModel, cohort: Column,
                col: str, factor: float) -> DataFrame:
    """On the cohort rows, scale ``col`` by ``factor``; one row: n_cohort, mean_before,
    mean_after, passed (mean must not rise by more than 1e-3; at least 5 rows)."""
    c = df.where(cohort)
    s = _score_twice(c, features, model,
                     lambda d: d.withColumn(col, F.col(col) * F.lit(float(factor))))
    return s.agg(F.count(F.lit(1)).alias("n_cohort"), F.avg("_s0").alias("mean_before"),
                 F.avg("_s1").alias("mean_after")).withColumn(
        "passed", (F.col("n_cohort") >= MIN_COHORT)
        & (F.col("mean_after") - F.col("mean_before") <= DIRECTION_TOLERANCE))


def quality_gate(scored: DataFrame, keys: Sequence[str] = ("model",), label: str = "label",
                 score: str = "score") -> DataFrame:
    """Per group: roc_auc, score_std (population), above_floor (>= 0.80),
    above_chance (> 0.60), not_constant (std > 0.05), passed."""
    keys = list(keys)
    auc = rank_metrics(scored, keys, label, score).select(*keys, "roc_auc")
    std = scored.groupBy(*keys).agg(F.stddev_pop(score).alias("score_std"))
    return join_null_safe(auc, std, keys).select(
        *keys, "roc_auc", "score_std",
        F.coalesce(F.col("roc_auc") >= AUC_FLOOR, F.lit(False)).alias("above_floor"),
        F.coalesce(F.col("roc_auc") > AUC_CHANCE, F.lit(False)).alias("above_chance"),
        F.coalesce(F.col("score_std") > MIN_SCORE_STD, F.lit(False)).alias("not_constant"),
    ).withColumn("passed", F.col("above_floor") & F.col("above_chance") & F.col("not_constant"))

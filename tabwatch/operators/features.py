"""Fitted feature pipeline as Spark ML stages.

Branches, concatenated by a VectorAssembler in this order (names carry the branch prefix):
  numerical__<col>             (x - mean) / population std, fitted on the training rows
  tenure_bucket__<col>_bucket_<k>  one-hot of the bucket index, buckets seen at fit
  categorical__<col>_<value>   one-hot, categories seen at fit, sorted; unseen -> all zeros
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwatch.functions.columns import bucketize

FEATURE_PIPELINE_VERSION = "v1"
FEATURES = "features"


def population_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """feature, mean, std (population) of every column from one aggregate."""
    agg = df.agg(*[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c)
                   for c in cols])
    return agg.unpivot([], list(cols), "feature", "s").select(
        "feature", F.col("s.mean").alias("mean"), F.col("s.std").alias("std"))


class _ScalerParams(HasInputCols):
    outputPrefix = Param(Params._dummy(), "outputPrefix", "prefix of the output columns",
                         typeConverter=TypeConverters.toString)


class PopulationScaler(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Standardise with the population std (ml.feature.StandardScaler uses the sample std).
    One aggregate job computes mean and std of every input column; a zero or undefined std
    divides by 1."""

    @keyword_only
    def __init__(self, inputCols: list[str] | None = None, outputPrefix: str = "numerical__"):
        super().__init__()
        self._setDefault(outputPrefix="numerical__")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "PopulationScalerModel":
        cols = self.getInputCols()
        got = {r["feature"]: r for r in population_stats(df, cols).collect()}
        means = [float(got[c]["mean"]) if got[c]["mean"] is not None else 0.0 for c in cols]
        stds = [float(got[c]["std"]) if got[c]["std"] else 1.0 for c in cols]
        m = PopulationScalerModel(inputCols=cols, outputPrefix=self.getOrDefault("outputPrefix"),
                                  means=means, stds=stds)
        return self._copyValues(m)


class PopulationScalerModel(Model, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    means = Param(Params._dummy(), "means", "fitted means", typeConverter=TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "fitted population stds",
                 typeConverter=TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, inputCols: list[str] | None = None, outputPrefix: str = "numerical__",
                 means: list[float] | None = None, stds: list[float] | None = None):
        super().__init__()
        self._setDefault(outputPrefix="numerical__")
        self._set(**self._input_kwargs)

    def output_cols(self) -> list[str]:
        p = self.getOrDefault("outputPrefix")
        return [p + c for c in self.getInputCols()]

    def _transform(self, df: DataFrame) -> DataFrame:
        cols, means, stds = self.getInputCols(), self.getOrDefault("means"), self.getOrDefault("stds")
        return df.withColumns({o: (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
                               for o, c, m, s in zip(self.output_cols(), cols, means, stds)})


#: Categories become driver-side lists and columns; a column with more values is refused.
MAX_CATEGORIES = 1000


class FeaturePipeline(Pipeline):
    """A Pipeline that checks, before anything is learned, how many values each categorical
    column has (one aggregate, about 5 % off), and raises beyond MAX_CATEGORIES."""

    def _fit(self, df: DataFrame) -> PipelineModel:
        cols = [c for s in self.getStages() if isinstance(s, StringIndexer)
                for c in s.getInputCols() if c in df.columns]
        if cols:
            r = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]).first()
            if large := {c: r[c] for c in cols if r[c] > MAX_CATEGORIES}:
                raise ValueError(f"more than {MAX_CATEGORIES} categories: {large}")
        return super()._fit(df)


def build_feature_pipeline(numerical: Sequence[str], bucket_col: str | None,
                           categorical: Sequence[str], bins: Sequence[float] = (12, 24, 48),
                           output_col: str = FEATURES) -> Pipeline:
    """Unfitted pipeline; ``.fit(train)`` learns scaler statistics and category lists."""
    stages = [PopulationScaler(inputCols=list(numerical), outputPrefix="numerical__")]
    index_in, index_out = [], []
    if bucket_col:
        stages.append(Bucketizer(splits=[float("-inf"), *map(float, bins), float("inf")],
                                 inputCol=bucket_col, outputCol=f"_{bucket_col}_bucket",
                                 handleInvalid="keep"))
        index_in.append(f"_{bucket_col}_bucket")
        index_out.append(f"_{bucket_col}_bucket_idx")
    index_in += list(categorical)
    index_out += [f"_{c}_idx" for c in categorical]
    vec_out = [f"{c}_vec" for c in index_out]
    if index_in:
        stages.append(StringIndexer(inputCols=index_in, outputCols=index_out, handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=index_out, outputCols=vec_out, dropLast=True))
    stages.append(VectorAssembler(inputCols=[f"numerical__{c}" for c in numerical] + vec_out,
                                  outputCol=output_col))
    return FeaturePipeline(stages=stages)


def _indexer(model: PipelineModel):
    from pyspark.ml.feature import StringIndexerModel
    for s in model.stages:
        if isinstance(s, StringIndexerModel):
            return s
    return None


def feature_names(model: PipelineModel) -> list[str]:
    """Output names in vector order."""
    scaler = model.stages[0]
    names = list(scaler.output_cols())
    idx = _indexer(model)
    if idx is not None:
        for col, labels in zip(idx.getInputCols(), idx.labelsArray):
            if col.startswith("_") and col.endswith("_bucket"):
                base = col[1:]
                names += [f"tenure_bucket__{base}_{int(float(v))}" for v in labels]
            else:
                names += [f"categorical__{col}_{v}" for v in labels]
    return names


def fitted_categories(model: PipelineModel) -> dict[str, list[str]]:
    idx = _indexer(model)
    return {} if idx is None else {c: list(l) for c, l in zip(idx.getInputCols(), idx.labelsArray)}


def wide_encode(df: DataFrame, model: PipelineModel, keep: Sequence[str] = (),
                bins: Sequence[float] = (12, 24, 48)) -> DataFrame:
    """The same encoding as plain columns for SQL use -- a generated select list with the
    fitted statistics and categories as literals."""
    scaler = model.stages[0]
    cols = [F.col(k) for k in keep]
    for o, c, m, s in zip(scaler.output_cols(), scaler.getInputCols(),
                          scaler.getOrDefault("means"), scaler.getOrDefault("stds")):
        cols.append(((F.col(c).cast("double") - F.lit(m)) / F.lit(s)).alias(o))
    for col, labels in fitted_categories(model).items():
        if col.startswith("_") and col.endswith("_bucket"):
            src = col[1:-len("_bucket")]
            b = bucketize(src, bins)
            cols += [F.when(b == int(float(v)), 1.0).otherwise(0.0)
                     .alias(f"tenure_bucket__{src}_bucket_{int(float(v))}") for v in labels]
        else:
            cols += [F.when(F.col(col) == v, 1.0).otherwise(0.0).alias(f"categorical__{col}_{v}")
                     for v in labels]
    return df.select(*cols)


def save_pipeline(model: PipelineModel, path: str) -> str:
    """E5: Spark ML persistence plus a small tag (class, version) written next to it."""
    model.write().overwrite().save(path)
    spark = SparkSession.getActiveSession()
    tag = json.dumps({"class": "tabwatch.FeaturePipeline", "version": FEATURE_PIPELINE_VERSION})
    spark.createDataFrame([(tag,)], "tag string").coalesce(1).write.mode("overwrite").text(
        path.rstrip("/") + "_tag")
    return path


def load_pipeline(path: str) -> PipelineModel:
    """E5: typed load; rejects folders that are not a tagged feature pipeline."""
    spark = SparkSession.getActiveSession()
    try:
        rows = spark.read.text(path.rstrip("/") + "_tag").collect()
        tag = json.loads(rows[0][0])
    except Exception as e:  # noqa: BLE001
        raise TypeError(f"{path} is not a saved feature pipeline: {e}") from e
    if tag.get("class") != "tabwatch.FeaturePipeline":
        raise TypeError(f"{path} holds {tag.get('class')}, not a feature pipeline")
    if tag.get("version") != FEATURE_PIPELINE_VERSION:
        raise TypeError(f"{path} has version {tag.get('version')}, expected "
                        f"{FEATURE_PIPELINE_VERSION}")
    return PipelineModel.load(path)

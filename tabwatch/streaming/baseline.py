"""Frozen drift baselines and PSI from binned counts, shared by the streaming job and its
batch twin.

A baseline is computed once (exact quantile edges per numeric feature, category shares), kept
as a small table and as literal edges: the streaming job bins every row with literal arrays
(no join), counts per (window, feature, bin), and turns counts into PSI with

  PSI(window) = K_f + sum over bins seen in the window of
                [t(p_c, p_b or eps) - (t(eps, p_b) if the bin is in the baseline else 0)]

with t(c, b) = (c - b) ln(c / b) and K_f = sum over baseline bins of t(eps, p_b). That is the
full PSI over the union of bins without materialising windows x bins.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwatch.operators.drift import EMPTY_BIN_PROPORTION, _NumericDrift
from tabwatch.operators.prefix import count_below_expr, hint_small
from tabwatch.session import ensure_checkpoint_dir

EPS = EMPTY_BIN_PROPORTION
BASELINE_VERSION = 2  # 2: a NULL category has a bin of its own


@dataclass
class Baseline:
    edges: dict[str, list[float]]     # numeric feature -> sorted distinct edges (frozen)
    numeric: list[str]
    categorical: list[str]
    props: DataFrame                  # feature, bin (string), pb  (pb > 0 only)

    def bin_columns(self) -> list[Column]:
        """One struct(feature, bin) per feature, for ``explode``; NULL numeric values are
        skipped; a category v is the bin '=v', a NULL category the bin 'N'."""
        out = []
        for f in self.numeric:
            e = self.edges[f]
            inner = F.array(*[F.lit(float(x)) for x in e[1:-1]]) if len(e) >= 2 else F.array().cast("array<double>")
            v = F.nanvl(F.col(f).cast("double") + F.lit(0.0), F.lit(None).cast("double"))
            b = F.when(v.isNotNull(), count_below_expr(inner, v, max(len(e) - 2, 0), True)
                       .cast("string"))
            out.append(F.struct(F.lit(f).alias("feature"), b.alias("bin")))
        for f in self.categorical:
            out.append(F.struct(F.lit(f).alias("feature"),
                                F.coalesce(F.concat(F.lit("="), F.col(f).cast("string")), F.lit("N")).alias("bin")))
        return out


def _term(c: Column, b: Column) -> Column:
    return (c - b) * F.ln(c / b)


def binned(df: DataFrame, baseline: Baseline, keep: Sequence[str] = ()) -> DataFrame:
    """keep..., feature, bin: one row per (row, feature) with a non-NULL bin."""
    return df.select(*keep, F.explode(F.array(*baseline.bin_columns())).alias("_fb")) \
        .select(*keep, "_fb.feature", "_fb.bin").where(F.col("bin").isNotNull())


def fit_baseline(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                 n_bins: int = 10, path: str | None = None) -> Baseline:
    """Exact baseline edges (collected: features x (n_bins + 1) values) and bin shares. The
    baseline is frozen: both are written to ``path`` (by default a new folder below the shared
    checkpoint folder), and the shares are read from there ever after."""
    spark = df.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/tabwatch-baseline-{uuid.uuid4().hex}"
    edges: dict[str, list[float]] = {}
    if numeric:
        edges = _NumericDrift(df, df.limit(0), list(numeric)).edges(n_bins)
    b = Baseline(edges, list(numeric), list(categorical), None)  # type: ignore[arg-type]
    counts = binned(df, b).groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"))
    tot = counts.groupBy("feature").agg(F.sum("n").alias("_n"))
    props = counts.join(hint_small(tot, len(numeric) + len(categorical)), "feature").select(
        "feature", "bin", (F.col("n") / F.col("_n")).alias("pb"))
    props.write.mode("overwrite").parquet(f"{path}/props")
    meta = json.dumps({"version": BASELINE_VERSION, "edges": edges, "numeric": list(numeric),
                       "categorical": list(categorical)})
    spark.createDataFrame([(meta,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")
    return load_baseline(spark, path)


def load_baseline(spark: SparkSession, path: str) -> Baseline:
    """A stored baseline; refuses other folders and versions."""
    try:
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    except Exception as e:  # noqa: BLE001
        raise TypeError(f"{path} is not a saved baseline: {e}") from e
    if meta.get("version") != BASELINE_VERSION:
        raise TypeError(f"{path} has version {meta.get('version')}, expected {BASELINE_VERSION}")
    props = spark.read.schema("feature string, bin string, pb double").parquet(f"{path}/props")
    return Baseline(meta["edges"], meta["numeric"], meta["categorical"], props)


def psi_from_counts(counts: DataFrame, baseline: Baseline, keys: Sequence[str]) -> DataFrame:
    """counts: keys..., feature, bin, n  ->  keys..., feature, psi, n (rows in the group)."""
    keys = list(keys)
    props = baseline.props
    const = props.groupBy("feature").agg(F.sum(_term(F.lit(EPS), F.col("pb"))).alias("_k"))
    tot = counts.groupBy(*keys, "feature").agg(F.sum("n").alias("_n"))
    j = counts.join(tot, [*keys, "feature"]).join(props, ["feature", "bin"], "left")
    pc = F.col("n") / F.col("_n")
    pb = F.coalesce(F.col("pb"), F.lit(EPS))
    adj = _term(pc, pb) - F.when(F.col("pb").isNotNull(), _term(F.lit(EPS), F.col("pb"))) \
        .otherwise(F.lit(0.0))
    s = j.groupBy(*keys, "feature").agg(F.sum(adj).alias("_s"), F.max("_n").alias("n"))
    return s.join(const, "feature", "left").select(
        *keys, "feature", (F.col("_s") + F.coalesce(F.col("_k"), F.lit(0.0))).alias("psi"),
        F.col("n").cast("long").alias("n"))


def windowed_psi_batch(df: DataFrame, baseline: Baseline, ts_col: str,
                       window: str = "1 day") -> DataFrame:
    """Batch twin of the streaming job: window_start, feature, psi, n."""
    w = F.window(ts_col, window).start.alias("window_start")
    counts = binned(df.select(w, *baseline.numeric, *baseline.categorical), baseline,
                    ["window_start"]).groupBy("window_start", "feature", "bin") \
        .agg(F.count(F.lit(1)).alias("n"))
    return psi_from_counts(counts, baseline, ["window_start"])

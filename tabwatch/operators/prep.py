"""Deterministic preprocessing and perturbation (Column expressions only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.functions.columns import bucketize, swap_values
from tabwatch.functions.hashing import unit_hash


def fill_and_label(df: DataFrame, fill: dict[str, float], label_src: str | None = None,
                   positive: str = "Yes", label: str = "churn",
                   drop: Sequence[str] = ()) -> DataFrame:
    """Shared by training (C1) and scoring (C2) so both sides cannot diverge: NULL -> fill
    value per column; optional label = (label_src == positive) as int, label_src dropped;
    ``drop`` columns removed."""
    out = df
    for c, v in fill.items():
        out = out.withColumn(c, F.coalesce(F.col(c).cast("double"), F.lit(float(v))))
    if label_src is not None:
        # names are case-insensitive ("Churn" vs "churn"): build under a temporary name
        out = out.withColumn("__label", (F.col(label_src) == F.lit(positive)).cast("int")) \
            .drop(label_src).withColumnRenamed("__label", label)
    return out.drop(*drop)


def with_bucket(df: DataFrame, col: str, bins: Sequence[float] = (12, 24, 48),
                out: str | None = None) -> DataFrame:
    """Left-closed bucket index of a numeric column."""
    return df.withColumn(out or f"{col}_bucket", bucketize(col, bins))


def weighted_resample(df: DataFrame, col: str, values: Sequence[str], probs: Sequence[float],
                      seed: int, key: str | Sequence[str]) -> DataFrame:
    """Replace ``col`` by a draw from ``values`` with probabilities ``probs``.

    u = md5-hash(seed, column name, key) / 2^32 is compared with the cumulative
    probabilities in a ``when`` chain. Same seed and key give the same draw on any
    partitioning (``rand(seed)`` would not); the input frame is not changed."""
    if len(values) != len(probs) or not values:
        raise ValueError("values and probs must have the same non-zero length")
    total = float(sum(probs))
    keys = [key] if isinstance(key, str) else list(key)
    u = unit_hash(seed, *keys, salt=col)
    expr = F.lit(values[-1])
    cum = []
    acc = 0.0
    for p in probs[:-1]:
        acc += float(p) / total
        cum.append(acc)
    for v, c in reversed(list(zip(values[:-1], cum))):
        expr = F.when(u < F.lit(c), F.lit(v)).otherwise(expr)
    return df.withColumn(col, expr)


def inject_drift(df: DataFrame, scale_col: str, factor: float,
                 resample: dict[str, tuple[Sequence[str], Sequence[float]]], seed: int,
                 key: str | Sequence[str]) -> DataFrame:
    """C4 + C5: scale one numeric column and resample categorical columns."""
    out = df.withColumn(scale_col, F.col(scale_col) * F.lit(float(factor)))
    for col, (values, probs) in resample.items():
        out = weighted_resample(out, col, values, probs, seed, key)
    return out


def swap_category(df: DataFrame, col: str, a: str, b: str) -> DataFrame:
    """Counterfactual copy with values a and b exchanged."""
    return df.withColumn(col, swap_values(col, {a: b, b: a}))

"""Scalar Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_div(num: str | Column, den: str | Column, default: float | None = 0.0) -> Column:
    """num / den, ``default`` when den is 0 or NULL (zero-division rule of the metrics)."""
    den_c = _c(den)
    val = _c(num).cast("double") / den_c.cast("double")
    return F.when(den_c.isNull() | (den_c == 0), F.lit(default).cast("double")).otherwise(val)


def clip(x: str | Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(_c(x), F.lit(lo)), F.lit(hi))


def bucketize(x: str | Column, bins: Sequence[float] = (12, 24, 48)) -> Column:
    """Left-closed buckets: x < bins[0] -> 0, bins[0] <= x < bins[1] -> 1, ... ,
    x >= bins[-1] -> len(bins). NULL stays NULL. Same edges as
    ``pyspark.ml.feature.Bucketizer(splits=[-inf, *bins, inf])``."""
    if list(bins) != sorted(bins):
        raise ValueError(f"bins must be increasing; got {bins}")
    col = _c(x)
    expr = F.lit(len(bins))
    for i in range(len(bins) - 1, -1, -1):
        expr = F.when(col < F.lit(bins[i]), F.lit(i)).otherwise(expr)
    return F.when(col.isNull(), F.lit(None).cast("int")).otherwise(expr.cast("int"))


def swap_values(x: str | Column, mapping: dict[str, str]) -> Column:
    """Replace values by ``mapping`` (e.g. Female <-> Male); others unchanged."""
    col = _c(x)
    m = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    return F.coalesce(F.element_at(m, col), col) if mapping else col


def ks_pvalue(d: str | Column, n1: str | Column, n2: str | Column, terms: int = 100) -> Column:
    """Asymptotic two-sided p-value of the two-sample KS statistic.

    lambda = D * (sqrt(m) + 0.12 + 0.11 / sqrt(m)), m = n1 n2 / (n1 + n2),
    p = 2 sum_{k=1..terms} (-1)^(k-1) exp(-2 k^2 lambda^2), clipped to [0, 1];
    p = 1 when lambda < 0.2 (the series has not converged there and the true value is 1
    to ten digits). Small samples differ slightly from an exact small-sample p-value.
    """
    m = (_c(n1).cast("double") * _c(n2).cast("double")) / (_c(n1) + _c(n2)).cast("double")
    sq = F.sqrt(m)
    lam = _c(d) * (sq + F.lit(0.12) + F.lit(0.11) / sq)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0).cast("double"),
        lambda acc, k: acc + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        * F.exp(F.lit(-2.0) * (k * k).cast("double") * lam * lam),
    )
    p = F.least(F.greatest(F.lit(2.0) * series, F.lit(0.0)), F.lit(1.0))
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(p)

"""Classification metrics over a scored table (keys..., label, score).

Scale rules: rank metrics first aggregate to distinct (keys, score) with positive / negative
counts (map-side combined), then run bucketed prefix sums; sweeps and calibration map each
row to a small bin index and count -- no row x threshold expansion, no window over a whole
group.

Every function takes ``weight``, the name of a column of row weights; counts then are sums of
weights. Weights are read to 9 decimal places and summed as integers of 38 digits, so that no
sum depends on the order of the rows; a weight that is NULL, NaN or negative fails the job. Such
an integer is three columns of long, so that rows and running sums never touch a wide decimal.
Rows of weight 0 count for nothing but are rows of their group and bin.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwatch.functions.columns import safe_div
from tabwatch.operators.prefix import count_below, hint_small, join_null_safe, running_totals

# float64 machine epsilon used to clip probabilities in the log loss, the
# default decision threshold and the default sweep grid.
LOG_LOSS_EPS = float(np.finfo(np.float64).eps)
DEFAULT_THRESHOLD = 0.5


#: Weights become integers: this many parts of one.
WEIGHT_SCALE = 1_000_000_000
#: Such an integer (below 2^67) is held in limbs of so many bits; a long sums those of 2^39 rows.
LIMB_BITS, LIMBS = 24, 3
#: Below this product a double finds the integer, unless it is as near as this to a half.
_SURE_BELOW, _NEAR_HALF = 2.0 ** 40, 2.0 ** -10


def default_thresholds() -> list[float]:
    return [float(x) for x in np.linspace(0.05, 0.95, 19)]


def _prep(scored: DataFrame, label: str, score: str, weight: str | None = None) -> DataFrame:
    """_y, _s. A label other than 0 or 1 (NULL too) fails the job instead of dropping out; a
    NaN score counts as NULL. With ``weight`` also its limbs."""
    y = F.col(label)
    bad = F.raise_error(F.concat(F.lit("a label must be 0 or 1; got "),
                                 F.coalesce(y.cast("string"), F.lit("NULL"))))
    d = scored.withColumn("_y", F.when(y.isin(0, 1), y.cast("int")).otherwise(bad.cast("int"))) \
        .withColumn("_s", F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double")))
    return d if weight is None else _with_weight(d, weight)


def _limbs(name: str, weight: str | None) -> list[str]:
    """The columns that hold a count."""
    return [name] if weight is None else [f"{name}_{k}" for k in range(LIMBS)]


def _with_weight(df: DataFrame, weight: str) -> DataFrame:
    """_w_0, _w_1, _w_2: the limbs, lowest first, of the weight in WEIGHT_SCALE parts.

    The integer is the weight's decimal text rounded half up. A product of doubles is at most
    2^-12 from it below 2^40, so it decides unless it is near a half; decimals do the rest."""
    w = F.col(weight).cast("double")
    bad = F.raise_error(F.concat(F.lit("a weight must be a number of at least 0; got "),
                                 F.coalesce(F.col(weight).cast("string"), F.lit("NULL"))))
    parts = F.round(F.col(weight).cast("decimal(20, 9)") * F.lit(WEIGHT_SCALE)).cast("decimal(20, 0)")
    slow = F.when((w >= 0) & ~F.isnan(w), parts).otherwise(bad.cast("decimal(20, 0)"))
    p, n, one = F.col("_p"), F.col("_n"), 1 << LIMB_BITS
    sure = (p >= 0) & (p < _SURE_BELOW) & (F.abs(p - F.floor(p) - 0.5) > _NEAR_HALF)
    d = df.withColumn("_p", w * F.lit(float(WEIGHT_SCALE))).withColumn("_n", F.when(sure, F.floor(p + 0.5))) \
        .withColumn("_d", F.when(n.isNull(), slow)) \
        .withColumn("_h", F.coalesce(F.shiftright(n, LIMB_BITS), F.expr(f"_d div {one}")))
    return d.withColumns({
        "_w_0": F.coalesce(n.bitwiseAND(F.lit(one - 1)), (F.col("_d") % F.lit(one)).cast("long")),
        "_w_1": F.col("_h").bitwiseAND(F.lit(one - 1)), "_w_2": F.shiftright("_h", LIMB_BITS)}) \
        .drop("_p", "_n", "_d", "_h")


def _amount(name: str, weight: str | None, of=F.col) -> Column:
    """The number in a count's columns, each read by ``of``; of weights, a double."""
    if weight is None:
        return of(name)
    parts = [of(c).cast("double") * F.lit(2.0 ** (LIMB_BITS * k)) for k, c in enumerate(_limbs(name, weight))]
    return parts[2] + parts[1] + parts[0]


def _exact(name: str, weight: str | None, of=F.col) -> Column:
    """The same as an integer of 38 digits."""
    if weight is None:
        return of(name)
    parts = [of(c).cast("decimal(20, 0)") * F.lit(1 << (LIMB_BITS * k)).cast("decimal(16, 0)")
             for k, c in enumerate(_limbs(name, weight))]
    return (parts[2] + parts[1] + parts[0]).cast("decimal(38, 0)")


def _total(cond: Column, weight: str | None) -> Column:
    """Rows, or weight, where the condition holds."""
    if weight is None:
        return F.count_if(cond)
    return _exact("_w", weight, lambda c: F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0)))


def _class_counts(weight: str | None) -> list[Column]:
    """Aggregates of prepared rows: the columns of n_pos and n_neg."""
    if weight is None:
        return [F.count_if(F.col("_y") == y).alias(n) for n, y in (("n_pos", 1), ("n_neg", 0))]
    return [F.sum(F.when(F.col("_y") == y, F.col(w)).otherwise(0)).alias(c) for n, y in (("n_pos", 1), ("n_neg", 0))
            for c, w in zip(_limbs(n, weight), _limbs("_w", weight))]


def _doubles(df: DataFrame, cols: Sequence[str], weight: str | None) -> DataFrame:
    """Exact sums of weights, as doubles for the formulas on them."""
    return df if weight is None else df.withColumns({c: F.col(c).cast("double") for c in cols})


def _shown(col: str, weight: str | None) -> Column:
    """A count as it is shown: a weight in its own unit."""
    return (F.col(col) if weight is None else F.col(col) / F.lit(float(WEIGHT_SCALE))).alias(col)


def score_counts(scored: DataFrame, keys: Sequence[str], label: str = "label",
                 score: str = "score", weight: str | None = None) -> DataFrame:
    """keys, score, n_pos, n_neg: one row per distinct score (NULL scores dropped). With
    ``weight``: sums in WEIGHT_SCALE parts."""
    return _score_counts(scored, keys, label, score, weight).select(
        *keys, "score", *[_exact(n, weight).alias(n) for n in ("n_pos", "n_neg")])


def _score_counts(scored: DataFrame, keys: Sequence[str], label: str, score: str, weight: str | None) -> DataFrame:
    """The same, with the columns that hold the counts."""
    return _prep(scored, label, score, weight).where(F.col("_s").isNotNull()) \
        .groupBy(*keys, F.col("_s").alias("score")).agg(*_class_counts(weight))


def rank_metrics(scored: DataFrame, keys: Sequence[str], label: str = "label",
                 score: str = "score", key_bound: int | None = None, weight: str | None = None) -> DataFrame:
    """keys, roc_auc, pr_auc, n_pos, n_neg per group (a NULL key is a group). ``key_bound``: a
    bound on the number of groups, which lets the per-group tables be broadcast. Weighted: ties
    count half the product of their weights, n_pos and n_neg are sums of weights (doubles)."""
    return _from_counts(_score_counts(scored, keys, label, score, weight), keys, key_bound, weight) \
        .select(*keys, "roc_auc", "pr_auc", "n_pos", "n_neg")


def _from_counts(counts: DataFrame, keys: Sequence[str], key_bound: int | None = None,
                 weight: str | None = None, more: Sequence[Column] = ()) -> DataFrame:
    """keys, roc_auc, pr_auc, n_pos, n_neg, and the aggregates ``more`` over the rows of ``counts``.
    The counts are shuffled once; bounds, bucket totals and rows all read that exchange.

    roc_auc: ties count one half; NULL unless both classes are present.
    pr_auc: average precision, sum over distinct scores (descending) of
    (R_k - R_{k-1}) * P_k (step-wise, not trapezoidal); NULL without positives.
    """
    keys = list(keys)
    cols = [*_limbs("n_pos", weight), *_limbs("n_neg", weight)]
    rt = running_totals(counts, keys, "score", cols, key_bound=key_bound)
    tot = rt.key_totals()
    # positives / negatives with score >= this score, and negatives below it with half of its own
    above = lambda c: F.col(f"total_{c}") - (F.col(f"cum_{c}") - F.col(c))
    tp, fp = _amount("n_pos", weight, above), _amount("n_neg", weight, above)
    below = _amount("n_neg", weight, lambda c: F.col(f"cum_{c}")) - _amount("n_neg", weight) / 2.0
    pos = _amount("n_pos", weight)
    parts = (
        join_null_safe(rt.rows, hint_small(tot, key_bound), keys)
        .groupBy(*keys)
        .agg(F.sum(pos * below).alias("_auc"),
             F.sum(F.when(pos > 0, pos * (tp / (tp + fp)))).alias("_ap"), *more)
    )
    whole = lambda n: _exact(n, weight, lambda c: F.col(f"total_{c}"))
    tot = _doubles(tot.select(*keys, whole("n_pos").alias("P"), whole("n_neg").alias("N")), ["P", "N"], weight)
    out = join_null_safe(tot, hint_small(parts, key_bound), keys, "left")
    return out.select(
        *keys,
        F.when((F.col("P") > 0) & (F.col("N") > 0),
               F.col("_auc") / (F.col("P").cast("double") * F.col("N"))).alias("roc_auc"),
        F.when(F.col("P") > 0, F.coalesce(F.col("_ap"), F.lit(0.0)) / F.col("P"))
        .alias("pr_auc"),
        _shown("P", weight).alias("n_pos"), _shown("N", weight).alias("n_neg"),
        *[c for c in parts.columns if c not in (*keys, "_auc", "_ap")],
    )


def point_metrics(scored: DataFrame, keys: Sequence[str], threshold: float = DEFAULT_THRESHOLD,
                  label: str = "label", score: str = "score", weight: str | None = None) -> DataFrame:
    """keys, f1 (at score >= threshold, 0.0 on zero division), log_loss (natural log,
    probabilities clipped to [eps, 1 - eps]), brier, tp, fp, fn, tn -- one aggregate. Weighted:
    means are weighted (NULL where all weights are 0), tp to tn are sums of weights (doubles)."""
    if weight is not None:
        own = lambda y, c: F.when((F.col("_y") == y) & F.col("_s").isNotNull(), F.col(c)).otherwise(0)
        d = _prep(scored, label, score, weight).withColumn("score", F.col("_s")).withColumns({
            c: own(y, w) for n, y in (("n_pos", 1), ("n_neg", 0)) for c, w in zip(_limbs(n, weight), _limbs("_w", weight))})
        return _point_columns(d.groupBy(*keys).agg(*_point_aggs(threshold, weight)), keys, weight)
    d = _prep(scored, label, score)
    pred = F.col("_s") >= F.lit(float(threshold))
    pos = F.col("_y") == 1
    p_label = F.when(pos, F.col("_s")).otherwise(F.lit(1.0) - F.col("_s"))
    clipped = F.when(F.col("_s").isNotNull(),  # greatest() would skip a NULL score
                     F.least(F.greatest(p_label, F.lit(LOG_LOSS_EPS)), F.lit(1.0 - LOG_LOSS_EPS)))
    agg = d.groupBy(*keys).agg(
        F.count_if(pred & pos).alias("tp"), F.count_if(pred & ~pos).alias("fp"),
        F.count_if(~pred & pos).alias("fn"), F.count_if(~pred & ~pos).alias("tn"),
        (-F.avg(F.ln(clipped))).alias("log_loss"),
        F.avg(F.pow(F.col("_s") - F.col("_y"), 2)).alias("brier"),
    )
    return agg.select(
        *keys,
        safe_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
        "log_loss", "brier", "tp", "fp", "fn", "tn")


def _point_aggs(threshold: float, weight: str | None = None) -> list[Column]:
    """Sums that the point metrics need, over rows of score, n_pos and n_neg."""
    s = F.col("score")
    pred = s >= F.lit(float(threshold))
    lo, hi = F.lit(LOG_LOSS_EPS), F.lit(1.0 - LOG_LOSS_EPS)
    pos, neg = _amount("n_pos", weight), _amount("n_neg", weight)
    hit = lambda n: _exact(n, weight, lambda c: F.sum(F.when(pred, F.col(c)).otherwise(0)))
    return [
        hit("n_pos").alias("tp"), hit("n_neg").alias("fp"),
        _exact("n_pos", weight, F.sum).alias("_P"), _exact("n_neg", weight, F.sum).alias("_N"),
        F.sum(pos * F.ln(F.least(F.greatest(s, lo), hi))
              + neg * F.ln(F.least(F.greatest(F.lit(1.0) - s, lo), hi))).alias("_ll"),
        F.sum(pos * F.pow(s - 1.0, 2) + neg * F.pow(s, 2)).alias("_sq"),
    ]


def _point_columns(agg: DataFrame, keys: Sequence[str], weight: str | None = None, more: Sequence[str] = ()) -> DataFrame:
    """keys, the columns ``more``, and the point metrics from their sums."""
    agg = _doubles(agg, ["tp", "fp", "_P", "_N"], weight)
    n = F.nullif(F.col("_P") + F.col("_N"), F.lit(0)).cast("double")
    fn = F.col("_P") - F.col("tp")
    return agg.select(
        *keys, *more, safe_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + fn).alias("f1"),
        (-F.col("_ll") / n).alias("log_loss"), (F.col("_sq") / n).alias("brier"),
        "tp", "fp", fn.alias("fn"), (F.col("_N") - F.col("fp")).alias("tn")).select(
        *keys, *more, "f1", "log_loss", "brier", *[_shown(c, weight) for c in ("tp", "fp", "fn", "tn")])


def classification_metrics(scored: DataFrame, keys: Sequence[str] = ("model", "split"),
                           threshold: float = DEFAULT_THRESHOLD, label: str = "label",
                           score: str = "score", key_bound: int | None = None,
                           weight: str | None = None) -> DataFrame:
    """The five-metric set per group: keys, roc_auc, pr_auc, f1, log_loss, brier. One scan:
    rank and point metrics both come from the distinct-score counts, in one aggregate."""
    keys = list(keys)
    counts = _score_counts(scored, keys, label, score, weight)
    r = _from_counts(counts, keys, key_bound, weight, _point_aggs(threshold, weight))
    return _point_columns(r, keys, weight, ["roc_auc", "pr_auc"]) \
        .select(*keys, "roc_auc", "pr_auc", "f1", "log_loss", "brier")


def compare_models(scored: DataFrame, model_col: str = "model",
                   threshold: float = DEFAULT_THRESHOLD, strict: bool = False, **kw) -> DataFrame:
    """One row per model: model, roc_auc, pr_auc, f1, log_loss, brier. ``strict``: raise if
    there is no scored row, hence no model to compare."""
    if strict and scored.isEmpty():
        raise ValueError("no scored rows: there is no model to compare")
    return classification_metrics(scored, [model_col], threshold, **kw)


def champion(metric_table: DataFrame, metric: str = "roc_auc", model_col: str = "model",
             higher_is_better: bool = True) -> DataFrame:
    """One row: the model with the best ``metric``; ties go to the smallest model name."""
    rank_key = F.struct(-F.col(metric) if higher_is_better else F.col(metric), F.col(model_col))
    best = F.max(metric) if higher_is_better else F.min(metric)
    return metric_table.where(F.col(metric).isNotNull()).agg(
        F.min_by(F.col(model_col), rank_key).alias(model_col), best.alias(metric))


def confusion_at(scored: DataFrame, keys: Sequence[str] = ("model",),
                 threshold: float = DEFAULT_THRESHOLD, label: str = "label",
                 score: str = "score", weight: str | None = None) -> DataFrame:
    """keys, tp, fp, fn, tn at ``score >= threshold``; an absent class gives 0."""
    return point_metrics(scored, keys, threshold, label, score, weight).select(
        *keys, "tp", "fp", "fn", "tn")


def _spine(agg: DataFrame, keys: list[str], n: int, name: str) -> DataFrame:
    """keys x {0..n-1} from the (small) aggregated table, so empty bins are kept."""
    return agg.select(*keys).distinct().select(
        *keys, F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name))


def threshold_sweep(scored: DataFrame, keys: Sequence[str] = ("model",),
                    thresholds: Sequence[float] | None = None, label: str = "label",
                    score: str = "score", weight: str | None = None) -> DataFrame:
    """keys, threshold, precision, recall, f1, tp, fp, fn, tn for each threshold
    (``score >= t``; 0.0 on zero division). One pass: each row gets k = number of
    thresholds <= score, counts per k, then suffix sums over <= len(thresholds)+1 rows per
    key. Thresholds are de-duplicated and sorted."""
    keys = list(keys)
    thr = sorted({float(t) for t in (default_thresholds() if thresholds is None else thresholds)})
    if not thr:
        raise ValueError("no thresholds given")
    arr = F.array(*[F.lit(t) for t in thr])
    d = count_below(_prep(scored, label, score, weight).where(F.col("_s").isNotNull())
                    .withColumn("_thr", arr), "_thr", "_s", len(thr), "k", inclusive=True)
    agg = d.groupBy(*keys, "k").agg(_total(F.col("_y") == 1, weight).alias("pos"),
                                    _total(F.col("_y") == 0, weight).alias("neg"))
    full = join_null_safe(_spine(agg, keys, len(thr) + 1, "k"), agg, [*keys, "k"], "left") \
        .fillna(0, subset=["pos", "neg"])
    suffix = Window.partitionBy(*keys).orderBy(F.desc("k")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*keys)
    s = _doubles(full.select(
        *keys, "k",
        F.sum("pos").over(suffix).alias("tp"), F.sum("neg").over(suffix).alias("fp"),
        F.sum("pos").over(whole).alias("P"), F.sum("neg").over(whole).alias("N"),
    ).where(F.col("k") >= 1), ["tp", "fp", "P", "N"], weight)
    shown = (lambda c: c.cast("long")) if weight is None else (lambda c: c / F.lit(float(WEIGHT_SCALE)))
    precision = safe_div("tp", F.col("tp") + F.col("fp"))
    recall = safe_div("tp", "P")
    return s.select(
        *keys, F.element_at(arr, F.col("k")).alias("threshold"),
        precision.alias("precision"), recall.alias("recall"),
        safe_div(2 * precision * recall, precision + recall).alias("f1"),
        shown(F.col("tp")).alias("tp"), shown(F.col("fp")).alias("fp"),
        shown(F.col("P") - F.col("tp")).alias("fn"),
        shown(F.col("N") - F.col("fp")).alias("tn"),
    )


def calibration_table(scored: DataFrame, keys: Sequence[str] = ("model",), n_bins: int = 10,
                      label: str = "label", score: str = "score", weight: str | None = None) -> DataFrame:
    """keys, bin, bin_lower, bin_upper, predicted_mean, observed_rate, count; weighted: the means
    are weighted (NULL where all weights of a bin are 0), ``weight_sum`` comes after count.

    ``n_bins`` equal-width bins on [0, 1], left-closed, the last one closed; empty bins kept
    with NULL means and count 0. Edges are linspace(0, 1, n + 1) values computed on the
    driver (so 0.30000000000000004 is an edge, as in NumPy)."""
    if n_bins < 2:
        raise ValueError(f"n_bins must be >= 2; got {n_bins}")
    keys = list(keys)
    edges = [float(x) for x in np.linspace(0.0, 1.0, n_bins + 1)]
    earr = F.array(*[F.lit(e) for e in edges])
    inner = F.array(*[F.lit(e) for e in edges[1:-1]])
    d = _prep(scored, label, score, weight).where((F.col("_s") >= 0.0) & (F.col("_s") <= 1.0))
    d = count_below(d.withColumn("_in", inner), "_in", "_s", n_bins - 1, "bin", inclusive=True)
    if weight is None:
        means = [F.avg("_s").alias("predicted_mean"), F.avg(F.col("_y").cast("double")).alias("observed_rate")]
    else:
        w, all_w = _amount("_w", weight), _total(F.lit(True), weight).cast("double")
        total = F.nullif(all_w, F.lit(0.0))
        means = [(F.sum(w * F.col("_s")) / total).alias("predicted_mean"),
                 (_total(F.col("_y") == 1, weight).cast("double") / total).alias("observed_rate"),
                 (all_w / WEIGHT_SCALE).alias("weight_sum")]
    agg = d.groupBy(*keys, "bin").agg(*means, F.count(F.lit(1)).alias("count"))
    return join_null_safe(_spine(agg, keys, n_bins, "bin"), agg, [*keys, "bin"], "left").select(
        *keys, F.col("bin").cast("int").alias("bin"),
        F.element_at(earr, F.col("bin") + 1).alias("bin_lower"),
        F.element_at(earr, F.col("bin") + 2).alias("bin_upper"),
        "predicted_mean", "observed_rate",
        F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"),
        *([] if weight is None else [F.coalesce("weight_sum", F.lit(0.0)).alias("weight_sum")]),
    )

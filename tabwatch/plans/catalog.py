"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the driver's
tables; ``ORACLE`` holds the DuckDB SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwatch.operators import drift
from tabwatch.plans import oracle as O
from tabwatch.plans import tables as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --------------------------------------------------------------------------- drift (H)

NUM, CAT = T.LINEITEM_NUMERIC, T.LINEITEM_CATEGORICAL


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


@register("drift_psi_numeric", _with(O.numeric_ctes(O.LI_BASE, O.LI_CUR, NUM)) + """
SELECT feature, round(psi, 6) AS psi, n_bins_used, n_b, n_c FROM psi_n""")
def drift_psi_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, c = T.lineitem_sides(spark, sf_dir)
    return T.rounded(drift.psi_numeric(b, c, NUM))


@register("drift_psi_categorical", _with(O.categorical_ctes(O.LI_BASE, O.LI_CUR, CAT)) + """
SELECT feature, round(psi, 6) AS psi, n_b, n_c FROM psi_c""")
def drift_psi_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, c = T.lineitem_sides(spark, sf_dir)
    return T.rounded(drift.psi_categorical(b, c, CAT))


@register("drift_ks", _with(O.numeric_ctes(O.LI_BASE, O.LI_CUR, NUM)) + """
SELECT feature, round(ks_statistic, 6) AS ks_statistic, round(ks_pvalue, 6) AS ks_pvalue,
       n_b, n_c FROM ks_n""")
def drift_ks(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, c = T.lineitem_sides(spark, sf_dir)
    return T.rounded(drift.ks_two_sample(b, c, NUM))


_FEAT_SQL = _with(O.numeric_ctes(O.LI_BASE, O.LI_CUR, NUM),
                  O.categorical_ctes(O.LI_BASE, O.LI_CUR, CAT),
                  O.feature_table_cte(NUM, CAT))


@register("drift_features", _FEAT_SQL + """
SELECT feature, type, round(psi, 6) AS psi, round(ks_statistic, 6) AS ks_statistic,
       round(ks_pvalue, 6) AS ks_pvalue, psi_alert, ks_alert, n_bins_used, ordinal
FROM feat ORDER BY psi DESC, ordinal""")
def drift_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, c = T.lineitem_sides(spark, sf_dir)
    return T.rounded(drift.detect_drift(b, c, NUM, CAT))


def _score_drift(spark: SparkSession, sf_dir: str, *models: str) -> DataFrame:
    """Train rows against all other rows, a row for each model: the two sides cover the table."""
    t = drift.prediction_drift_within(T.line_scores(spark, sf_dir), F.col("split") == "train", [f"s_{m}" for m in models])
    return t.select(F.substring("feature", 3, 10).alias("model"), *t.columns[1:])


def _score_sql(model: str) -> tuple[str, str]:
    s = O.scored_lineitem_sql()
    return tuple(f"(SELECT score FROM {s} WHERE model = '{model}' AND split {op} 'train')" for op in ("=", "<>"))


def _score_drift_sql(model: str) -> str:
    b, c = _score_sql(model)
    return _with(
        O.numeric_ctes(b, c, ["score"]),
        f"sb AS (SELECT avg(score) AS baseline_mean, stddev_pop(score) AS baseline_std FROM {b})",
        f"sc AS (SELECT avg(score) AS current_mean, stddev_pop(score) AS current_std FROM {c})",
    ) + f"""
SELECT '{model}' AS model, round(psi, 6) AS psi, round(baseline_mean, 6) AS baseline_mean,
       round(current_mean, 6) AS current_mean, round(baseline_std, 6) AS baseline_std,
       round(current_std, 6) AS current_std FROM psi_n, sb, sc"""


@register("score_drift", "\nUNION ALL\n".join(f"SELECT * FROM ({_score_drift_sql(m)})" for m in ("price", "qty")))
def score_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.rounded(_score_drift(spark, sf_dir, "price", "qty"))


def _summary_sql() -> str:
    b, c = _score_sql("price")
    return _FEAT_SQL + "," + O.numeric_ctes(b, c, ["score"], p="s_")


@register("drift_summary", _summary_sql() + """
SELECT CAST(count(*) AS BIGINT) AS n_features,
       CAST(count(*) FILTER (WHERE psi_alert) AS BIGINT) AS n_psi_alerts,
       CAST(count(*) FILTER (WHERE ks_alert) AS BIGINT) AS n_ks_alerts,
       CAST(count(*) FILTER (WHERE psi_alert) + count(*) FILTER (WHERE ks_alert) AS BIGINT)
           AS n_total_alerts,
       round(coalesce(max(psi), 0.0), 6) AS max_psi,
       (SELECT coalesce(psi >= 0.2, false) FROM s_psi_n) AS prediction_drift_alert
FROM feat""")
def drift_summary_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, c = T.lineitem_sides(spark, sf_dir)
    table = drift.detect_drift(b, c, NUM, CAT)
    return T.rounded(drift.drift_summary(table, _score_drift(spark, sf_dir, "price")))


# the null policy: a feature with NULLs and NaNs in a third of its rows, and one of only NULLs
_ODD = ("(SELECT *, CASE l_linenumber % 3 WHEN 0 THEN {nan} WHEN 1 THEN NULL ELSE l_extendedprice END AS odd, "
        "CAST(NULL AS DOUBLE) AS never FROM {src})")


def _odd_sides(spark: SparkSession, sf_dir: str):
    n = F.col("l_linenumber") % 3
    odd = F.when(n == 0, F.lit(float("nan"))).when(n == 2, F.col("l_extendedprice"))
    return [d.withColumn("odd", odd).withColumn("never", F.lit(None).cast("double"))
            for d in T.lineitem_sides(spark, sf_dir)]


_ODD_CTES = O.numeric_ctes(*(_ODD.format(src=x, nan="NULL") for x in (O.LI_BASE, O.LI_CUR)), ["odd", "l_tax"])


@register("drift_nan_feature", _with(_ODD_CTES) + """
SELECT p.feature, round(psi, 6) AS psi, n_bins_used, round(ks_statistic, 6) AS ks_statistic, p.n_b, p.n_c
FROM psi_n p JOIN ks_n k ON p.feature = k.feature""")
def drift_nan_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN counts as NULL: it is in no bin and no size."""
    t = drift._NumericDrift(*_odd_sides(spark, sf_dir), ["odd", "l_tax"]).table()
    return T.rounded(t.select("feature", "psi", "n_bins_used", "ks_statistic", "n_b", "n_c"))


@register("drift_all_null_feature", _with(_ODD_CTES) + """
SELECT feature, round(psi, 6) AS psi, n_b, n_c FROM psi_n
UNION ALL SELECT 'never', CAST(NULL AS DOUBLE), CAST(0 AS BIGINT), CAST(0 AS BIGINT)""")
def drift_all_null_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per listed feature, also for a feature without any value."""
    return T.rounded(drift.psi_numeric(*_odd_sides(spark, sf_dir), ["odd", "never", "l_tax"])
                     .select("feature", "psi", "n_b", "n_c"))


# --------------------------------------------------------------------------- metrics (G)

from tabwatch.operators import metrics as M  # noqa: E402

_S = O.scored_lineitem_sql()
_MS = ["model", "split"]


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.scored_lineitem(spark, sf_dir)


@register("metric_set", f"""
SELECT r.model, r.split, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc,
       round(f1, 6) AS f1, round(log_loss, 6) AS log_loss, round(brier, 6) AS brier
FROM {O.rank_metrics_sql(_S, _MS)} r JOIN {O.point_metrics_sql(_S, _MS)} p
  ON r.model = p.model AND r.split = p.split""")
def metric_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.rounded(M.classification_metrics(_scored(spark, sf_dir), _MS, key_bound=6))


@register("roc_pr_auc", f"""
SELECT model, split, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc, n_pos, n_neg
FROM {O.rank_metrics_sql(_S, _MS)} r""")
def roc_pr_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.rounded(M.rank_metrics(_scored(spark, sf_dir), _MS, key_bound=6))


@register("confusion_at_half", f"""
SELECT model, split, tp, fp, fn, tn FROM {O.point_metrics_sql(_S, _MS)} p""")
def confusion_at_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.confusion_at(_scored(spark, sf_dir), _MS, 0.5)


@register("threshold_sweep", f"""
SELECT model, split, round(threshold, 6) AS threshold, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(f1, 6) AS f1, tp, fp, fn, tn
FROM {O.sweep_sql(_S, _MS, M.default_thresholds())} s""")
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.rounded(M.threshold_sweep(_scored(spark, sf_dir), _MS))


@register("calibration", f"""
SELECT model, split, bin, round(bin_lower, 6) AS bin_lower, round(bin_upper, 6) AS bin_upper,
       round(predicted_mean, 6) AS predicted_mean, round(observed_rate, 6) AS observed_rate,
       count FROM {O.calibration_sql(_S, _MS)} c""")
def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.rounded(M.calibration_table(_scored(spark, sf_dir), _MS))


# the same with row weights, some of them 0
_W = O.scored_lineitem_sql(weighted=True)


def _weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.scored_lineitem(spark, sf_dir, weighted=True)


@register("weighted_metric_set", f"""
SELECT r.model, r.split, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc,
       round(f1, 6) AS f1, round(log_loss, 6) AS log_loss, round(brier, 6) AS brier
FROM {O.rank_metrics_sql(_W, _MS, 'w')} r JOIN {O.point_metrics_sql(_W, _MS, 0.5, 'w')} p
  ON r.model = p.model AND r.split = p.split""")
def weighted_metric_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1-G6 with weights."""
    return T.rounded(M.classification_metrics(_weighted(spark, sf_dir), _MS, key_bound=6, weight="w"))


@register("weighted_roc_pr_auc", f"""
SELECT model, split, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc, round(n_pos, 6) AS n_pos,
  round(n_neg, 6) AS n_neg FROM {O.rank_metrics_sql(_W, _MS, 'w')} r""")
def weighted_roc_pr_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1, G2 with weights."""
    return T.rounded(M.rank_metrics(_weighted(spark, sf_dir), _MS, key_bound=6, weight="w"))


@register("weighted_confusion", f"""
SELECT model, split, round(CAST(tp AS DOUBLE), 6) AS tp, round(CAST(fp AS DOUBLE), 6) AS fp,
  round(CAST(fn AS DOUBLE), 6) AS fn, round(CAST(tn AS DOUBLE), 6) AS tn FROM {O.point_metrics_sql(_W, _MS, 0.5, 'w')} p""")
def weighted_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G9 with weights."""
    return T.rounded(M.confusion_at(_weighted(spark, sf_dir), _MS, 0.5, weight="w"))


@register("weighted_sweep", f"""
SELECT model, split, round(threshold, 6) AS threshold, round(precision, 6) AS precision,
  round(recall, 6) AS recall, round(f1, 6) AS f1, round(CAST(tp AS DOUBLE), 6) AS tp,
  round(CAST(fp AS DOUBLE), 6) AS fp, round(CAST(fn AS DOUBLE), 6) AS fn, round(CAST(tn AS DOUBLE), 6) AS tn
FROM {O.sweep_sql(_W, _MS, M.default_thresholds(), 'w')} s""")
def weighted_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G7 with weights."""
    return T.rounded(M.threshold_sweep(_weighted(spark, sf_dir), _MS, weight="w"))


@register("weighted_calibration", f"""
SELECT model, split, bin, round(bin_lower, 6) AS bin_lower, round(bin_upper, 6) AS bin_upper,
  round(predicted_mean, 6) AS predicted_mean, round(observed_rate, 6) AS observed_rate, count,
  round(weight_sum, 6) AS weight_sum FROM {O.calibration_sql(_W, _MS, 10, 'w')} c""")
def weighted_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G8 with weights."""
    return T.rounded(M.calibration_table(_weighted(spark, sf_dir), _MS, weight="w"))


@register("weighted_comparison", f"""
SELECT r.model, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc, round(f1, 6) AS f1,
  round(log_loss, 6) AS log_loss, round(brier, 6) AS brier
FROM {O.rank_metrics_sql(_W, ['model'], 'w')} r JOIN {O.point_metrics_sql(_W, ['model'], 0.5, 'w')} p ON r.model = p.model""")
def weighted_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G10 with weights."""
    return T.rounded(M.compare_models(_weighted(spark, sf_dir), key_bound=2, weight="w"))


_CMP = f"""(SELECT r.model, roc_auc, pr_auc, f1, log_loss, brier
FROM {O.rank_metrics_sql(_S, ['model'])} r JOIN {O.point_metrics_sql(_S, ['model'])} p
  ON r.model = p.model)"""


@register("model_comparison", f"""
SELECT model, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc, round(f1, 6) AS f1,
       round(log_loss, 6) AS log_loss, round(brier, 6) AS brier FROM {_CMP} c""")
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.rounded(M.compare_models(_scored(spark, sf_dir), key_bound=2))


@register("champion_model", f"""
SELECT model, round(roc_auc, 6) AS roc_auc FROM {_CMP} c
ORDER BY roc_auc DESC, model LIMIT 1""")
def champion_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.rounded(M.champion(M.compare_models(_scored(spark, sf_dir), key_bound=2)))


_DOC = """(SELECT 'doc_len' AS model, CAST(l.quality AS INTEGER) AS label,
       CAST(d.n_chars AS DOUBLE) / (d.n_chars + 2000.0) AS score
FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def _doc_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = T.table(spark, sf_dir, "labels").select("doc_id", "quality")
    doc = T.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return lab.join(doc, "doc_id").select(
        F.lit("doc_len").alias("model"), F.col("quality").cast("int").alias("label"),
        (F.col("n_chars").cast("double") / (F.col("n_chars") + F.lit(2000.0))).alias("score"))


@register("doc_quality_metrics", f"""
SELECT r.model, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc, round(f1, 6) AS f1,
       round(log_loss, 6) AS log_loss, round(brier, 6) AS brier
FROM {O.rank_metrics_sql(_DOC, ['model'])} r JOIN {O.point_metrics_sql(_DOC, ['model'])} p
  ON r.model = p.model""")
def doc_quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.rounded(M.classification_metrics(_doc_scored(spark, sf_dir), ["model"], key_bound=1))


# --------------------------------------------------------------------------- contracts (B)

from tabwatch.operators import contracts as C  # noqa: E402
from tabwatch.operators import prep as P  # noqa: E402
from tabwatch.operators import split as D  # noqa: E402
from tabwatch.sources import io as IO  # noqa: E402

# Contracts declared for the driver's tables.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
ORDERS_CONTRACT = C.Contract("orders", (
    C.ColumnSpec("o_orderkey", "bigint", unique=True),
    C.ColumnSpec("o_custkey", "bigint"),
    C.ColumnSpec("o_orderstatus", "string", isin=("F", "O", "P")),
    C.ColumnSpec("o_totalprice", "double", gt=0.0),
    C.ColumnSpec("o_orderdate", "timestamp_ntz"),
    C.ColumnSpec("o_orderpriority", "string", isin=PRIORITIES),
), strict=True, key=("o_orderkey",))
LINEITEM_CONTRACT = C.Contract("lineitem", (
    C.ColumnSpec("l_orderkey", "bigint"),
    C.ColumnSpec("l_partkey", "bigint", ge=0),
    C.ColumnSpec("l_suppkey", "bigint", ge=0),
    C.ColumnSpec("l_linenumber", "int", ge=1, le=7),
    C.ColumnSpec("l_quantity", "double", ge=1.0, le=50.0),
    C.ColumnSpec("l_extendedprice", "double", gt=0.0),
    C.ColumnSpec("l_discount", "double", ge=0.0, le=0.1),
    C.ColumnSpec("l_tax", "double", ge=0.0, le=0.08),
    C.ColumnSpec("l_returnflag", "string", isin=("A", "N", "R")),
    C.ColumnSpec("l_linestatus", "string", isin=("F", "O")),
    C.ColumnSpec("l_shipdate", "timestamp_ntz"),
), strict=True, key=("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
    unique=(("l_orderkey", "l_linenumber"),))
PROFILE_CONTRACT = C.Contract("profile", (
    C.ColumnSpec("customer_id", "bigint", unique=True),
    C.ColumnSpec("segment", "string", isin=tuple(T.SEGMENTS)),
    C.ColumnSpec("nation", "string"),
    C.ColumnSpec("tenure", "int", nullable=True, ge=0, le=72),
    C.ColumnSpec("n_orders", "bigint", ge=0),
    C.ColumnSpec("total_spend", "double", nullable=True, ge=0.0),
    C.ColumnSpec("monthly_spend", "double", nullable=True, gt=0.0),
    C.ColumnSpec("acctbal", "double"),
    C.ColumnSpec("churned", "string", isin=("Yes", "No")),
), strict=True, key=("customer_id",))
# scoring input: wider tenure range, bounded spend, extra fields ignored
PROFILE_SCORING_CONTRACT = C.Contract("profile_scoring", (
    C.ColumnSpec("tenure", "int", nullable=True, ge=0, le=100),
    C.ColumnSpec("monthly_spend", "double", nullable=True, gt=0.0, le=100000.0),
    C.ColumnSpec("total_spend", "double", nullable=True, ge=0.0),
), strict=False, key=("customer_id",))

_ORD_COLS = [c.name for c in ORDERS_CONTRACT.columns]
_LI_COLS = [c.name for c in LINEITEM_CONTRACT.columns]
_PROF_COLS = [c.name for c in PROFILE_CONTRACT.columns]


@register("contract_summary_orders", O.contract_summary_sql("orders", ORDERS_CONTRACT, _ORD_COLS))
def contract_summary_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.violation_summary(T.table(spark, sf_dir, "orders"), ORDERS_CONTRACT)


@register("contract_summary_lineitem",
          O.contract_summary_sql("lineitem", LINEITEM_CONTRACT, _LI_COLS))
def contract_summary_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.violation_summary(T.table(spark, sf_dir, "lineitem"), LINEITEM_CONTRACT)


@register("contract_violations_lineitem",
          O.contract_detail_sql("lineitem", LINEITEM_CONTRACT, _LI_COLS))
def contract_violations_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.violation_table(T.table(spark, sf_dir, "lineitem"), LINEITEM_CONTRACT)


@register("contract_summary_profile",
          O.contract_summary_sql(O.PROFILE, PROFILE_CONTRACT, _PROF_COLS))
def contract_summary_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.violation_summary(T.customer_profile(spark, sf_dir), PROFILE_CONTRACT)


@register("contract_violations_profile",
          O.contract_detail_sql(O.PROFILE, PROFILE_CONTRACT, _PROF_COLS))
def contract_violations_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.violation_table(T.customer_profile(spark, sf_dir), PROFILE_CONTRACT)


@register("scoring_quarantine", f"""
SELECT customer_id, _violations AS violations
FROM {O.contract_flags_sql(O.PROFILE, PROFILE_SCORING_CONTRACT, _PROF_COLS)} f
WHERE _violations <> ''""")
def scoring_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = C.split_valid(T.customer_profile(spark, sf_dir), PROFILE_SCORING_CONTRACT)
    return bad.select("customer_id", F.concat_ws(",", C.VIOLATIONS).alias("violations"))


@register("scoring_valid_count", f"""
SELECT CAST(count(*) AS BIGINT) AS n_valid
FROM {O.contract_flags_sql(O.PROFILE, PROFILE_SCORING_CONTRACT, _PROF_COLS)} f
WHERE _violations = ''""")
def scoring_valid_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = C.split_valid(T.customer_profile(spark, sf_dir), PROFILE_SCORING_CONTRACT)
    return good.agg(F.count(F.lit(1)).alias("n_valid"))


@register("contract_missing_column", """
SELECT 'orders' AS contract, 'missing column o_orderstatus' AS problem
UNION ALL SELECT 'orders', 'unknown column extra'
UNION ALL SELECT 'orders', 'column o_custkey has type string, expected bigint'""")
def contract_missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: schema problems as rows; such a frame never passes as clean."""
    o = T.table(spark, sf_dir, "orders").drop("o_orderstatus").withColumn("extra", F.lit(1)) \
        .withColumn("o_custkey", F.col("o_custkey").cast("string"))
    return C.schema_report(o, ORDERS_CONTRACT)


TEXT_CONTRACT = C.Contract("orders_text", (
    C.ColumnSpec("o_orderkey", "bigint"), C.ColumnSpec("price", "double", nullable=True, gt=0.0),
    C.ColumnSpec("days", "int", ge=0)), strict=True, coerce=True, key=("o_orderkey",))
_TEXT_SQL = """(SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
  CASE o_orderkey % 5 WHEN 0 THEN 'n/a' WHEN 1 THEN ' ' WHEN 2 THEN '-1.5' ELSE '12.25' END AS price,
  CASE WHEN o_custkey % 4 = 0 THEN 'soon' ELSE CAST(o_custkey AS VARCHAR) END AS days FROM orders)"""


@register("contract_coerce_text", f"""
WITH t AS (SELECT *, TRY_CAST(trim(price) AS DOUBLE) AS p, TRY_CAST(trim(days) AS INTEGER) AS d FROM {_TEXT_SQL})
SELECT 'o_orderkey:type' AS rule, 'o_orderkey' AS column, CAST(0 AS BIGINT) AS n_violations
UNION ALL SELECT 'o_orderkey:not_null', 'o_orderkey', CAST(0 AS BIGINT)
UNION ALL SELECT 'price:type', 'price', CAST(count(*) FILTER (WHERE p IS NULL AND trim(price) <> '') AS BIGINT) FROM t
UNION ALL SELECT 'price:gt', 'price', CAST(count(*) FILTER (WHERE p <= 0) AS BIGINT) FROM t
UNION ALL SELECT 'days:type', 'days', CAST(count(*) FILTER (WHERE d IS NULL AND trim(days) <> '') AS BIGINT) FROM t
UNION ALL SELECT 'days:not_null', 'days', CAST(count(*) FILTER (WHERE d IS NULL) AS BIGINT) FROM t
UNION ALL SELECT 'days:ge', 'days', CAST(count(*) FILTER (WHERE d < 0) AS BIGINT) FROM t""")
def contract_coerce_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: text columns cast to their declared types; a failed cast is a violation."""
    k = F.col("o_orderkey") % 5
    o = T.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(k == 0, "n/a").when(k == 1, " ").when(k == 2, "-1.5").otherwise("12.25").alias("price"),
        F.when(F.col("o_custkey") % 4 == 0, "soon").otherwise(F.col("o_custkey").cast("string")).alias("days"))
    return C.violation_summary(o, TEXT_CONTRACT)


# --------------------------------------------------------------------------- prep (C)

@register("customer_profile", f"""
SELECT customer_id, segment, nation, tenure, n_orders, total_spend, monthly_spend, acctbal,
       churned
FROM {O.PROFILE} p""")
def customer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    # row-level arithmetic is bit-identical in both engines: no rounding needed
    return T.customer_profile(spark, sf_dir)


@register("preprocessed_profile", f"""
SELECT customer_id, segment, nation, tenure, n_orders, total_spend, monthly_spend, acctbal,
       churn
FROM {O.PROCESSED} p""")
def preprocessed_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.processed_profile(spark, sf_dir)


@register("tenure_buckets", f"""
SELECT customer_id, tenure, CAST(CASE WHEN tenure IS NULL THEN NULL WHEN tenure < 12 THEN 0
  WHEN tenure < 24 THEN 1 WHEN tenure < 48 THEN 2 ELSE 3 END AS INTEGER) AS tenure_bucket
FROM {O.PROFILE} p""")
def tenure_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.with_bucket(T.customer_profile(spark, sf_dir), "tenure", (12, 24, 48),
                         "tenure_bucket").select("customer_id", "tenure", "tenure_bucket")


# Fixed values of the perturbation plan (mirrors the price-hike / segment-swing demo).
INJECT_SEED = 0
INJECT_FACTOR = 1.25
INJECT_SEGMENT_P = [0.70, 0.10, 0.10, 0.05, 0.05]


def _injected(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    return P.inject_drift(T.processed_profile(spark, sf_dir) if rows is None else rows, "monthly_spend", INJECT_FACTOR,
                          {"segment": (T.SEGMENTS, INJECT_SEGMENT_P)}, INJECT_SEED, "customer_id")


def _injected_sql() -> str:
    u = (f"(CAST({O.uniform_hash_sql(INJECT_SEED, 'segment_salt', 'customer_id')} AS DOUBLE)"
         f" / 4294967296.0)").replace("CAST(segment_salt AS VARCHAR)", "'segment'")
    cum, acc = [], 0.0
    for p in INJECT_SEGMENT_P[:-1]:
        acc += p / sum(INJECT_SEGMENT_P)
        cum.append(acc)
    case = "CASE " + " ".join(f"WHEN {u} < {O.dbl(c)} THEN '{v}'" for v, c in
                              zip(T.SEGMENTS[:-1], cum)) + f" ELSE '{T.SEGMENTS[-1]}' END"
    return (f"(SELECT * REPLACE (monthly_spend * {O.dbl(INJECT_FACTOR)} AS monthly_spend, "
            f"{case} AS segment) FROM {O.PROCESSED})")


@register("injected_profile", f"""
SELECT customer_id, monthly_spend, segment FROM {_injected_sql()} i""")
def injected_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _injected(spark, sf_dir).select("customer_id", "monthly_spend", "segment")


@register("swapped_profile", f"""
SELECT customer_id, CASE segment WHEN 'AUTOMOBILE' THEN 'MACHINERY'
  WHEN 'MACHINERY' THEN 'AUTOMOBILE' ELSE segment END AS segment FROM {O.PROFILE} p""")
def swapped_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.swap_category(T.customer_profile(spark, sf_dir), "segment", "AUTOMOBILE",
                           "MACHINERY").select("customer_id", "segment")


_PN, _PC = T.PROFILE_NUMERIC, T.PROFILE_CATEGORICAL


@register("drift_injected", _with(O.numeric_ctes(O.PROCESSED, _injected_sql(), _PN),
                                  O.categorical_ctes(O.PROCESSED, _injected_sql(), _PC),
                                  O.feature_table_cte(_PN, _PC)) + """
SELECT feature, type, round(psi, 6) AS psi, round(ks_statistic, 6) AS ks_statistic,
       round(ks_pvalue, 6) AS ks_pvalue, psi_alert, ks_alert, n_bins_used, ordinal FROM feat""")
def drift_injected(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = T.processed_profile(spark, sf_dir)
    return T.rounded(drift.detect_drift(base, _injected(spark, sf_dir), _PN, _PC))


# --------------------------------------------------------------------------- splits (D)

SPLIT_SEED = 42


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the label is 0/1: more than two strata would be an error
    return D.stratified_split(T.processed_profile(spark, sf_dir), "customer_id", "churn",
                              0.2, 0.2, SPLIT_SEED, max_strata=2)


_SPLIT_SQL = O.split_sql(O.PROCESSED, "customer_id", "churn", 0.2, 0.2, SPLIT_SEED)


@register("split_exact", f"SELECT customer_id, split FROM {_SPLIT_SQL} s")
def split_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir).select("customer_id", "split")


_APPROX_TEST, _APPROX_VAL = D.cut_points(0.2, 0.2)
_APPROX_SQL = (f"(SELECT o_orderkey, o_orderstatus, CASE WHEN {O.uniform_hash_sql(SPLIT_SEED, 'o_orderkey')} < {_APPROX_TEST} "
               f"THEN 'test' WHEN {O.uniform_hash_sql(SPLIT_SEED, 'o_orderkey')} < {_APPROX_VAL} THEN 'val' "
               "ELSE 'train' END AS split FROM orders)")


def _approx_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = T.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return D.stratified_split(orders, "o_orderkey", "o_orderstatus", seed=SPLIT_SEED, mode="approx")


@register("split_approx", f"SELECT o_orderkey, split FROM {_APPROX_SQL} s")
def split_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1, mode 'approx': every order, one narrow pass."""
    return _approx_split(spark, sf_dir).select("o_orderkey", "split")


@register("split_approx_rates", f"""
SELECT o_orderstatus, split, CAST(count(*) AS BIGINT) AS n,
  round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY o_orderstatus), 6) AS share
FROM {_APPROX_SQL} s GROUP BY o_orderstatus, split""")
def split_approx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of the approximate split within each stratum."""
    n = _approx_split(spark, sf_dir).groupBy("o_orderstatus", "split").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("o_orderstatus"))  # three rows a stratum
    return T.rounded(n.withColumn("share", F.col("n") / total))


# a stratum that is NULL for every third customer
_NULL_STRATUM = ("(SELECT *, CASE WHEN customer_id % 3 = 0 THEN NULL ELSE segment END AS seg FROM "
                 f"{O.PROCESSED})")


@register("split_null_stratum", f"""
SELECT seg, split, CAST(count(*) AS BIGINT) AS n
FROM (SELECT s.split, p.seg FROM {O.split_sql(f"(SELECT * REPLACE (coalesce(seg, '') AS seg) FROM {_NULL_STRATUM})", "customer_id", "seg", 0.2, 0.2, SPLIT_SEED)} s
      JOIN {_NULL_STRATUM} p ON s.customer_id = p.customer_id) GROUP BY seg, split""")
def split_null_stratum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 with a nullable stratum: NULL is a stratum, every row is in a split."""
    p = T.processed_profile(spark, sf_dir).withColumn(
        "seg", F.when(F.col("customer_id") % 3 != 0, F.col("segment")))
    return D.stratified_split(p, "customer_id", "seg", 0.2, 0.2, SPLIT_SEED).groupBy("seg", "split") \
        .agg(F.count(F.lit(1)).alias("n"))


@register("split_sizes", f"""
SELECT s.split, CAST(count(*) AS BIGINT) AS n, round(avg(CAST(p.churn AS DOUBLE)), 6)
       AS positive_rate
FROM {_SPLIT_SQL} s JOIN {O.PROCESSED} p ON s.customer_id = p.customer_id GROUP BY s.split""")
def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.rounded(D.split_stats(_split(spark, sf_dir), "churn"))


@register("kfold", f"""
SELECT customer_id, CAST(rk % 5 AS INTEGER) AS fold
FROM {O.ranked_sql(O.PROCESSED, 'customer_id', 'churn', SPLIT_SEED)} r""")
def kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.stratified_folds(T.processed_profile(spark, sf_dir), "customer_id", "churn", 5,
                              SPLIT_SEED, max_strata=2).select("customer_id", "fold")


# --------------------------------------------------------------------------- fingerprint (A2)

# Columns of the driver's tables, by DuckDB type.
_TABLE_COLUMNS = {t: [tuple(c.rsplit(" ", 1)) for c in cols.split(", ")] for t, cols in {
    "region": "r_regionkey INTEGER, r_name VARCHAR",
    "nation": "n_nationkey INTEGER, n_name VARCHAR, n_regionkey INTEGER",
    "customer": "c_custkey BIGINT, c_name VARCHAR, c_nationkey INTEGER, c_acctbal DOUBLE, c_mktsegment VARCHAR",
    "supplier": "s_suppkey BIGINT, s_name VARCHAR, s_nationkey INTEGER, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name VARCHAR, p_brand VARCHAR, p_type VARCHAR, p_size INTEGER, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus VARCHAR, o_totalprice DOUBLE, o_orderdate TIMESTAMP, "
              "o_orderpriority VARCHAR",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INTEGER, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag VARCHAR, l_linestatus VARCHAR, "
                "l_shipdate TIMESTAMP",
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR",
    "documents": "doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding FLOAT[], label INTEGER",
    "pages": "page_id BIGINT, url VARCHAR, html VARCHAR",
    "benchmark": "item_id BIGINT, text VARCHAR",
    "labels": "doc_id BIGINT, quality INTEGER, toxic INTEGER",
    "conversations": "conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR",
}.items()}


@register("dataset_fingerprint",
          "\nUNION ALL\n".join(O.fingerprint_sql(t, cols) for t, cols in _TABLE_COLUMNS.items()))
def dataset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 of every table."""
    out = None
    for t, cols in _TABLE_COLUMNS.items():
        f = IO.fingerprint(IO.read_parquet(spark, f"{sf_dir.rstrip('/')}/{t}.parquet"), [c for c, _ in cols]) \
            .select(F.lit(t).alias("table_name"), "n_rows", "fp_sum_hi", "fp_sum_lo", "fp_xor")
        out = f if out is None else out.unionByName(f)
    return out


# --------------------------------------------------------------------------- features (E)

from tabwatch.operators import behavior as BH  # noqa: E402
from tabwatch.operators import features as FE  # noqa: E402
from tabwatch.operators import models as MD  # noqa: E402
from tabwatch.operators import scoring as SC  # noqa: E402


def _train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir).where(F.col("split") == "train")


def _pipeline():
    return FE.build_feature_pipeline(_PN, "tenure", _PC)


@register("scaler_stats", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std "
    f"FROM {O.TRAIN} t" for c in _PN))
def scaler_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.rounded(FE.population_stats(_train_rows(spark, sf_dir), _PN))


def _wide_sql() -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1.0) AS s_{c}"
                      for c in _PN)
    num = ", ".join(f"round((CAST(p.{c} AS DOUBLE) - m_{c}) / s_{c}, 6) AS numerical__{c}"
                    for c in _PN)
    bucket = ("CASE WHEN p.tenure < 12 THEN 0 WHEN p.tenure < 24 THEN 1 "
              "WHEN p.tenure < 48 THEN 2 ELSE 3 END")
    bk = ", ".join(f"CASE WHEN {bucket} = {k} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "
                   f"tenure_bucket__tenure_bucket_{k}" for k in range(4))
    seg = ", ".join(f"CASE WHEN p.segment = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "
                    f"categorical__segment_{v}" for v in T.SEGMENTS)
    seg += ", " + ", ".join(f"CASE WHEN p.nation = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "
                            f"\"categorical__nation_{v}\"" for v in T.NATIONS)
    return (f"SELECT p.customer_id, {num}, {bk}, {seg} FROM {O.PROCESSED} p, "
            f"(SELECT {stats} FROM {O.TRAIN} t) st")


@register("wide_features", _wide_sql())
def wide_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoding fitted on the train split, applied to every customer as plain columns."""
    train = _train_rows(spark, sf_dir).persist()  # read by the scaler and the indexer
    try:
        fm = _pipeline().fit(train)
    finally:
        train.unpersist()
    return T.rounded(FE.wide_encode(T.processed_profile(spark, sf_dir), fm, ["customer_id"]))


@register("class_weights", f"""
SELECT churn, n, round(CAST(tot AS DOUBLE) / (2.0 * n), 6) AS weight_linear,
       round(CASE WHEN churn = 1 AND pos > 0 THEN CAST(neg AS DOUBLE) / pos ELSE 1.0 END, 6)
       AS weight_trees
FROM (SELECT churn, count(*) AS n, sum(count(*)) OVER () AS tot,
             coalesce(sum(CASE WHEN churn = 1 THEN count(*) END) OVER (), 0) AS pos,
             coalesce(sum(CASE WHEN churn = 0 THEN count(*) END) OVER (), 0) AS neg
      FROM {O.TRAIN} t GROUP BY churn)""")
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.rounded(MD.class_weight_table(_train_rows(spark, sf_dir), "churn"))


# --------------------------------------------------------------------------- models (F, I, J)

# Model set of the registered training plans, with the registry's own settings.
TRAINED_MODELS = ("logreg", "gbt", "mlp")


def _source_state(spark: SparkSession, sf_dir: str) -> str:
    """Digest of path, size and time of the files that the profile is made from."""
    import hashlib

    conf, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    seen = []
    for t in ("orders", "customer", "nation"):
        for f in sorted(T.table(spark, sf_dir, t).inputFiles()):
            p = jvm.org.apache.hadoop.fs.Path(f)
            s = p.getFileSystem(conf).getFileStatus(p)
            seen.append(f"{f}|{s.getLen()}|{s.getModificationTime()}")
    return hashlib.md5("\n".join(seen).encode()).hexdigest()


def _trained(spark: SparkSession, sf_dir: str):
    """(features, models, metric table, rows), trained once per application and state of the source
    files and kept as saved models below the shared checkpoint folder; a changed table trains anew.
    rows: the processed profile with its split, kept beside the models, so that checks of each model
    read it instead of aggregating and splitting the orders again."""
    from tabwatch.session import ensure_checkpoint_dir

    jvm = spark.sparkContext._jvm
    top = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tabwatch-models-" \
          f"{spark.sparkContext.applicationId}-{_source_state(spark, sf_dir)}"
    done = jvm.org.apache.hadoop.fs.Path(f"{top}/metrics/_SUCCESS")
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        _split(spark, sf_dir).write.mode("overwrite").parquet(f"{top}/rows")
        fm, fitted, metrics = MD.train_all(spark.read.parquet(f"{top}/rows"), _pipeline(), "churn",
                                           TRAINED_MODELS, key="customer_id")
        for name, model in fitted.items():
            model.save(f"{top}/{name}", fm)
        metrics.write.mode("overwrite").parquet(f"{top}/metrics")
    loaded = {m: MD.FittedModel.load(f"{top}/{m}") for m in TRAINED_MODELS}
    return (loaded[TRAINED_MODELS[0]][1], {m: x[0] for m, x in loaded.items()},
            spark.read.parquet(f"{top}/metrics"), spark.read.parquet(f"{top}/rows"))


def _per_model(parts: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in parts.items():
        d = df.select(F.lit(name).alias("model"), "*")
        out = d if out is None else out.unionByName(d)
    return out


def _test_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir).where(F.col("split") == "test")


@register("train_metrics")
def train_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """val / test metrics of every registry model (rows check: Spark ML estimators)."""
    return T.rounded(_trained(spark, sf_dir)[2])


@register("trained_champion")
def trained_champion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """best model by test ROC-AUC."""
    return T.rounded(M.champion(_trained(spark, sf_dir)[2].where(F.col("split") == "test")))


@register("batch_scores")
def batch_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every profile row through the scoring contract, preprocessing, features, each model."""
    fm, models, _, _ = _trained(spark, sf_dir)
    prof = T.customer_profile(spark, sf_dir)
    return _per_model({name: SC.score_batch(prof, PROFILE_SCORING_CONTRACT, T.fill_profile, fm, m,
                                            ["customer_id"])[0] for name, m in models.items()})


@register("quality_gate")
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I3 on the test split of each trained model."""
    fm, models, _, rows = _trained(spark, sf_dir)
    test = fm.transform(rows.where(F.col("split") == "test"))
    scored = _per_model({name: m.score(test, keep=["churn"]) for name, m in models.items()})
    # stored: the gate reads the scores several times, and hundreds of trees make each
    return T.rounded(BH.quality_gate(scored.checkpoint(), ["model"], label="churn"))


@register("invariance_check")
def invariance_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Swapping two segments must barely move the scores of any model."""
    fm, models, _, rows = _trained(spark, sf_dir)
    test = rows.where(F.col("split") == "test")
    return T.rounded(_per_model({name: BH.invariance(test, fm, m, "segment", "AUTOMOBILE", "MACHINERY")
                                 for name, m in models.items()}))


@register("directional_check")
def directional_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I2 on the hold-out rows, each model: long-tenure cohort, spend x 1.5."""
    fm, models, _, rows = _trained(spark, sf_dir)
    test = rows.where(F.col("split") == "test")
    return T.rounded(_per_model({name: BH.directional(test, fm, m, F.col("tenure") >= 48, "total_spend", 1.5)
                                 for name, m in models.items()}))


#: Trials of each registered search.
TUNING_TRIALS = 30


def _tuning(spark: SparkSession, sf_dir: str, model: str) -> DataFrame:
    data = D.stratified_folds(_train_rows(spark, sf_dir).drop("split"), "customer_id", "churn", 5,
                              SPLIT_SEED).persist()
    try:
        return T.rounded(MD.tune(model, data, _pipeline(), "churn", "fold", TUNING_TRIALS)[0])
    finally:
        data.unpersist()


@register("tuning_logreg")
def tuning_logreg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8, logistic regression: trials on 5 stratified folds of the train rows."""
    return _tuning(spark, sf_dir, "logreg")


@register("tuning_gbt")
def tuning_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8, boosted trees: trials on 5 stratified folds of the train rows."""
    return _tuning(spark, sf_dir, "gbt")


@register("tuning_mlp")
def tuning_mlp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8, network: trials on 5 stratified folds of the train rows."""
    return _tuning(spark, sf_dir, "mlp")


@register("encoded_features", f"""
SELECT customer_id, feature, value FROM (UNPIVOT ({_wide_sql()}) ON COLUMNS(* EXCLUDE (customer_id))
INTO NAME feature VALUE value)""")
def encoded_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The assembled vector of every customer, exploded with its feature names."""
    from pyspark.ml.functions import vector_to_array

    train = _train_rows(spark, sf_dir).persist()
    try:
        fm = _pipeline().fit(train)
    finally:
        train.unpersist()
    names = F.array(*[F.lit(n) for n in FE.feature_names(fm)])
    x = fm.transform(T.processed_profile(spark, sf_dir)).select(
        "customer_id", F.posexplode(vector_to_array(FE.FEATURES)).alias("i", "value"))
    return T.rounded(x.select("customer_id", F.get(names, F.col("i")).alias("feature"), "value"))


# Fixed values of the linear model: SQL can state it, so the scoring, behaviour and drift code
# paths have an oracle.
LINEAR = MD.LinearModel("linear", None, {}, 0.5, 0.4, {"tenure": -0.03, "total_spend": -0.000001, "n_orders": -0.08},
                        {"segment": {"AUTOMOBILE": 0.02, "MACHINERY": -0.02}})


def _linear_sql(src: str) -> str:
    z = " + ".join([O.dbl(LINEAR.bias), *[f"{O.dbl(w)} * CAST({c} AS DOUBLE)" for c, w in LINEAR.weights.items()],
                    *[f"CASE WHEN {c} = '{v}' THEN {O.dbl(w)} ELSE 0.0::DOUBLE END"
                      for c, vs in LINEAR.offsets.items() for v, w in vs.items()]])
    return f"(SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + exp(-({z}))) AS score FROM {src})"


def _identity():
    from pyspark.ml import PipelineModel

    return PipelineModel(stages=[])


_TEST = f"(SELECT p.* FROM {O.PROCESSED} p JOIN {_SPLIT_SQL} s ON p.customer_id = s.customer_id WHERE s.split = 'test')"
_VALID = f"""(SELECT * EXCLUDE (_violations) REPLACE (coalesce(tenure, 0) AS tenure,
  coalesce(total_spend, 0.0) AS total_spend, coalesce(monthly_spend, 0.0) AS monthly_spend)
  FROM {O.contract_flags_sql(O.PROFILE, PROFILE_SCORING_CONTRACT, _PROF_COLS)} f WHERE _violations = '')"""


@register("linear_batch_scores", f"""
SELECT customer_id, round(score, 6) AS probability, CAST(score >= 0.5 AS INTEGER) AS prediction,
       0.5::DOUBLE AS threshold FROM {_linear_sql(_VALID)}""")
def linear_batch_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract, shared fill, model with a stated formula."""
    return T.rounded(SC.score_batch(T.customer_profile(spark, sf_dir), PROFILE_SCORING_CONTRACT, T.fill_profile,
                                    _identity(), LINEAR, ["customer_id"])[0])


@register("linear_quality_gate", f"""
SELECT 'linear' AS model, round(roc_auc, 6) AS roc_auc, round(sd, 6) AS score_std,
  roc_auc >= 0.80 AS above_floor, roc_auc > 0.60 AS above_chance, sd > 0.05 AS not_constant,
  roc_auc >= 0.80 AND sd > 0.05 AS passed
FROM {O.rank_metrics_sql(f"(SELECT 'linear' AS model, churn AS label, score FROM {_linear_sql(_TEST)})", ['model'])} r,
     (SELECT stddev_pop(score) AS sd FROM {_linear_sql(_TEST)}) d""")
def linear_quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I3 on the hold-out rows."""
    s = LINEAR.score(_test_rows(spark, sf_dir), keep=["churn"]).withColumn("model", F.lit("linear"))
    return T.rounded(BH.quality_gate(s, ["model"], label="churn"))


def _after_sql(change: str) -> str:
    return (f"(SELECT a.customer_id, a.score AS s0, b.score AS s1, a.tenure FROM {_linear_sql(_TEST)} a JOIN "
            f"{_linear_sql(f'(SELECT * REPLACE ({change}) FROM {_TEST})')} b ON a.customer_id = b.customer_id)")


_SWAP = ("CASE segment WHEN 'AUTOMOBILE' THEN 'MACHINERY' WHEN 'MACHINERY' THEN 'AUTOMOBILE' ELSE segment END "
         "AS segment")


@register("linear_invariance", f"""
SELECT count(*) AS n, round(avg(abs(s1 - s0)), 6) AS mean_abs_change, round(max(abs(s1 - s0)), 6) AS max_abs_change,
  avg(abs(s1 - s0)) <= 0.05 AND max(abs(s1 - s0)) <= 0.10 AS passed FROM {_after_sql(_SWAP)}""")
def linear_invariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1 on the hold-out rows."""
    return T.rounded(BH.invariance(_test_rows(spark, sf_dir), _identity(), LINEAR, "segment", "AUTOMOBILE", "MACHINERY"))


@register("linear_directional", f"""
SELECT count(*) AS n_cohort, round(avg(s0), 6) AS mean_before, round(avg(s1), 6) AS mean_after,
  count(*) >= 5 AND avg(s1) - avg(s0) <= 0.001 AS passed
FROM {_after_sql("total_spend * 1.5::DOUBLE AS total_spend")} WHERE tenure >= 48""")
def linear_directional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I2 on the hold-out rows."""
    return T.rounded(BH.directional(_test_rows(spark, sf_dir), _identity(), LINEAR, F.col("tenure") >= 48,
                                    "total_spend", 1.5))


_LIN_B, _LIN_C = _linear_sql(O.PROCESSED), _linear_sql(_injected_sql())


@register("linear_scored_drift", _with(
    O.numeric_ctes(O.PROCESSED, _injected_sql(), _PN), O.categorical_ctes(O.PROCESSED, _injected_sql(), _PC),
    O.feature_table_cte(_PN, _PC)) + "," + O.numeric_ctes(_LIN_B, _LIN_C, ["score"], p="s_") + f"""
SELECT CAST(count(*) AS BIGINT) AS n_features, CAST(count(*) FILTER (WHERE psi_alert) AS BIGINT) AS n_psi_alerts,
       CAST(count(*) FILTER (WHERE ks_alert) AS BIGINT) AS n_ks_alerts,
       CAST(count(*) FILTER (WHERE psi_alert) + count(*) FILTER (WHERE ks_alert) AS BIGINT) AS n_total_alerts,
       round(coalesce(max(psi), 0.0), 6) AS max_psi,
       (SELECT coalesce(psi >= 0.2, false) FROM s_psi_n) AS prediction_drift_alert,
       (SELECT round(psi, 6) FROM s_psi_n) AS prediction_psi,
       (SELECT round(avg(score), 6) FROM {_LIN_B}) AS baseline_mean,
       (SELECT round(avg(score), 6) FROM {_LIN_C}) AS current_mean
FROM feat""")
def linear_scored_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H8: drift of a scored batch against its baseline."""
    base, cur = T.processed_profile(spark, sf_dir), _injected(spark, sf_dir)
    pred = drift.prediction_drift(LINEAR.score(base), LINEAR.score(cur))
    s = drift.drift_summary(drift.detect_drift(base, cur, _PN, _PC), pred).withColumn("_k", F.lit(1))
    return T.rounded(s.join(pred.select(F.lit(1).alias("_k"), F.col("psi").alias("prediction_psi"), "baseline_mean",
                                        "current_mean"), "_k").drop("_k"))


# --------------------------------------------------------------------------- streaming twin

from tabwatch.streaming import baseline as SB  # noqa: E402

# Fixed values of the events drift plan: the first seven days are the baseline.
EVENTS_BASELINE_END = "2024-01-08 00:00:00"


def _events_sql() -> str:
    qs = ", ".join(O.dbl(q) for q in drift.quantile_probs(10))
    base = f"(SELECT * FROM events WHERE ts < TIMESTAMP '{EVENTS_BASELINE_END}')"
    cur = f"(SELECT * FROM events WHERE ts >= TIMESTAMP '{EVENTS_BASELINE_END}')"
    binv = "CAST(len(list_filter(e.inner_edges, lambda x: x <= v.value + 0.0)) AS VARCHAR)"
    return f"""
WITH e AS (SELECT CASE WHEN len(ed) >= 2 THEN ed[2:len(ed) - 1] ELSE [] END AS inner_edges
           FROM (SELECT list_sort(list_distinct(quantile_cont(value + 0.0, [{qs}]))) AS ed
                 FROM {base} WHERE value IS NOT NULL)),
bb AS (SELECT 'value' AS feature, {binv} AS bin, count(*) AS n FROM {base} v, e
       WHERE v.value IS NOT NULL GROUP BY 1, 2
       UNION ALL
       SELECT 'event_type', coalesce('=' || event_type, 'N'), count(*) FROM {base} GROUP BY 1, 2),
bp AS (SELECT feature, bin, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY feature) AS pb FROM bb),
cb AS (SELECT date_trunc('day', ts) AS window_start, 'value' AS feature, {binv} AS bin,
              count(*) AS n FROM {cur} v, e WHERE v.value IS NOT NULL GROUP BY 1, 2, 3
       UNION ALL
       SELECT date_trunc('day', ts), 'event_type', coalesce('=' || event_type, 'N'), count(*)
       FROM {cur} GROUP BY 1, 2, 3),
cp AS (SELECT window_start, feature, bin, CAST(n AS DOUBLE) / sum(n) OVER
              (PARTITION BY window_start, feature) AS pc,
              sum(n) OVER (PARTITION BY window_start, feature) AS n_tot FROM cb),
grid AS (SELECT DISTINCT window_start, feature, n_tot FROM cp),
allb AS (SELECT g.window_start, g.feature, g.n_tot, b.bin FROM grid g JOIN bp b
         ON g.feature = b.feature
         UNION SELECT window_start, feature, n_tot, bin FROM cp)
SELECT a.window_start, a.feature,
       round(sum((coalesce(c.pc, 1e-6) - coalesce(b.pb, 1e-6))
                 * ln(coalesce(c.pc, 1e-6) / coalesce(b.pb, 1e-6))), 6) AS psi,
       CAST(a.n_tot AS BIGINT) AS n
FROM allb a LEFT JOIN cp c ON a.window_start = c.window_start AND a.feature = c.feature
     AND a.bin = c.bin
LEFT JOIN bp b ON a.feature = b.feature AND a.bin = b.bin
GROUP BY a.window_start, a.feature, a.n_tot"""


@register("drift_events_daily", _events_sql())
def drift_events_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 batch twin: daily PSI of events (value, event_type) against the first week."""
    ev = T.table(spark, sf_dir, "events")
    cut = T.ts(EVENTS_BASELINE_END)
    base = SB.fit_baseline(ev.where(F.col("ts") < cut), ["value"], ["event_type"])
    return T.rounded(SB.windowed_psi_batch(ev.where(F.col("ts") >= cut), base, "ts"))


# --------------------------------------------------------------------------- scored batch drift (H8, A4)

def _scored_drift_parts(spark: SparkSession, sf_dir: str):
    """Baseline = the whole processed profile, current = its perturbed copy, both scored by the
    logistic model (the perturbed-copy drift demo, with prediction drift)."""
    fm, models, _, rows = _trained(spark, sf_dir)
    base = rows.drop("split")
    cur = _injected(spark, sf_dir, base)
    score = lambda d: models["logreg"].score(fm.transform(d), keep=["customer_id"])
    return drift.detect_drift(base, cur, _PN, _PC), drift.prediction_drift(score(base), score(cur))


@register("scored_batch_drift")
def scored_batch_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H8: feature drift summary plus prediction drift of a scored batch."""
    table, pred = _scored_drift_parts(spark, sf_dir)
    s = drift.drift_summary(table, pred).withColumn("_k", F.lit(1))
    return T.rounded(s.join(pred.withColumn("_k", F.lit(1)), "_k").drop("_k"))


@register("drift_report")
def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: the one-row JSON-ready report (feature table, prediction drift, summary)."""
    table, pred = _scored_drift_parts(spark, sf_dir)
    return IO.report_frame(table, drift.drift_summary(table, pred), pred)


@register("drift_psi_numeric_approx")
def drift_psi_numeric_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1 with approx=True: sketch edges (rows check; the exact variant has the oracle)."""
    b, c = T.lineitem_sides(spark, sf_dir)
    return T.rounded(drift.psi_numeric(b, c, NUM, approx=True))

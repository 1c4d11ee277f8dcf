"""DuckDB SQL that computes the same results as the registered plans, from the same
parquet views. Written independently of the Spark code paths: quantile_cont for the edges,
plain window functions for running sums, brute-force CASE sums for sweeps."""

from __future__ import annotations

from tabwatch.functions.hashing import double_text_sql
from tabwatch.operators.drift import quantile_probs
from tabwatch.plans import tables as T


def dbl(x: float) -> str:
    """An exact DOUBLE literal (a plain decimal literal would be DECIMAL first)."""
    return f"'{float(x)!r}'::DOUBLE"


def long_numeric(src: str, cols: list[str], side: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{side}' AS side, '{c}' AS feature, CAST({c} AS DOUBLE) + 0.0 AS value "
        f"FROM {src}" for c in cols)


def long_categorical(src: str, cols: list[str], side: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{side}' AS side, '{c}' AS feature, CAST({c} AS VARCHAR) AS value FROM {src}"
        for c in cols)


def ks_pvalue_sql(d: str, n1: str, n2: str) -> str:
    m = f"(CAST({n1} AS DOUBLE) * CAST({n2} AS DOUBLE) / CAST({n1} + {n2} AS DOUBLE))"
    lam = f"({d} * (sqrt({m}) + {dbl(0.12)} + {dbl(0.11)} / sqrt({m})))"
    series = (f"list_sum(list_transform(range(1, 101), lambda k: "
              f"(CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) * "
              f"exp(-2.0 * CAST(k * k AS DOUBLE) * {lam} * {lam})))")
    return (f"(CASE WHEN {lam} < 0.2 THEN 1.0 ELSE "
            f"least(greatest(2.0 * {series}, 0.0), 1.0) END)")


def numeric_ctes(base: str, cur: str, cols: list[str], n_bins: int = 10, p: str = "") -> str:
    """CTEs {p}both_n (side, feature, value), {p}edges, {p}psi_n, {p}ks_n."""
    qs = ", ".join(dbl(q) for q in quantile_probs(n_bins))
    return f"""
{p}both_n AS (SELECT * FROM ({long_numeric(base, cols, 'b')} UNION ALL
                          {long_numeric(cur, cols, 'c')}) WHERE value IS NOT NULL),
{p}tot_n AS (SELECT feature, count(*) FILTER (WHERE side = 'b') AS n_b,
                 count(*) FILTER (WHERE side = 'c') AS n_c FROM {p}both_n GROUP BY feature),
{p}edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, [{qs}]))) AS edges
          FROM {p}both_n WHERE side = 'b' GROUP BY feature),
{p}inner_e AS (SELECT feature, edges, edges[2:len(edges) - 1] AS inner_edges FROM {p}edges
            WHERE len(edges) >= 2),
{p}bins AS (SELECT a.feature, len(list_filter(i.inner_edges, lambda e: e <= a.value)) AS bin,
                count(*) FILTER (WHERE a.side = 'b') AS bb,
                count(*) FILTER (WHERE a.side = 'c') AS bc
         FROM {p}both_n a JOIN {p}inner_e i ON a.feature = i.feature GROUP BY 1, 2),
{p}psi_bins AS (SELECT b.feature, sum(
    ((CASE WHEN bc = 0 THEN 1e-6 ELSE CAST(bc AS DOUBLE) / t.n_c END)
     - (CASE WHEN bb = 0 THEN 1e-6 ELSE CAST(bb AS DOUBLE) / t.n_b END))
    * ln((CASE WHEN bc = 0 THEN 1e-6 ELSE CAST(bc AS DOUBLE) / t.n_c END)
         / (CASE WHEN bb = 0 THEN 1e-6 ELSE CAST(bb AS DOUBLE) / t.n_b END))) AS psi
    FROM {p}bins b JOIN {p}tot_n t ON b.feature = t.feature GROUP BY b.feature),
{p}psi_n AS (SELECT t.feature,
    CASE WHEN t.n_b = 0 OR t.n_c = 0 THEN NULL
         WHEN coalesce(len(e.edges), 0) < 2 THEN 0.0 ELSE p.psi END AS psi,
    CAST(greatest(coalesce(len(e.edges), 0) - 1, 0) AS INTEGER) AS n_bins_used,
    t.n_b, t.n_c
    FROM {p}tot_n t LEFT JOIN {p}edges e ON t.feature = e.feature
    LEFT JOIN {p}psi_bins p ON t.feature = p.feature),
{p}cnt_n AS (SELECT feature, value, count(*) FILTER (WHERE side = 'b') AS nb,
                 count(*) FILTER (WHERE side = 'c') AS nc FROM {p}both_n GROUP BY 1, 2),
{p}cum_n AS (SELECT feature,
    sum(nb) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cb,
    sum(nc) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cc
    FROM {p}cnt_n),
{p}d_n AS (SELECT c.feature, max(abs(CAST(cb AS DOUBLE) / t.n_b - CAST(cc AS DOUBLE) / t.n_c))
               AS ks_statistic
        FROM {p}cum_n c JOIN {p}tot_n t ON c.feature = t.feature GROUP BY c.feature),
{p}ks_n AS (SELECT t.feature, d.ks_statistic,
                {ks_pvalue_sql('d.ks_statistic', 't.n_b', 't.n_c')} AS ks_pvalue, t.n_b, t.n_c
         FROM {p}tot_n t JOIN {p}d_n d ON t.feature = d.feature)"""


def categorical_ctes(base: str, cur: str, cols: list[str]) -> str:
    return f"""
both_c AS ({long_categorical(base, cols, 'b')} UNION ALL {long_categorical(cur, cols, 'c')}),
cnt_c AS (SELECT feature, value, count(*) FILTER (WHERE side = 'b') AS nb,
                 count(*) FILTER (WHERE side = 'c') AS nc FROM both_c GROUP BY 1, 2),
tot_c AS (SELECT feature, sum(nb) AS n_b, sum(nc) AS n_c FROM cnt_c GROUP BY 1),
psi_c AS (SELECT t.feature, CASE WHEN t.n_b = 0 OR t.n_c = 0 THEN NULL ELSE sum(
    ((CASE WHEN nc = 0 THEN 1e-6 ELSE CAST(nc AS DOUBLE) / t.n_c END)
     - (CASE WHEN nb = 0 THEN 1e-6 ELSE CAST(nb AS DOUBLE) / t.n_b END))
    * ln((CASE WHEN nc = 0 THEN 1e-6 ELSE CAST(nc AS DOUBLE) / t.n_c END)
         / (CASE WHEN nb = 0 THEN 1e-6 ELSE CAST(nb AS DOUBLE) / t.n_b END))) END AS psi,
    CAST(t.n_b AS BIGINT) AS n_b, CAST(t.n_c AS BIGINT) AS n_c
    FROM cnt_c c JOIN tot_c t ON c.feature = t.feature GROUP BY t.feature, t.n_b, t.n_c)"""


def feature_table_cte(numerical: list[str], categorical: list[str],
                      psi_threshold: float = 0.2, ks_alpha: float = 0.05) -> str:
    order = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate([*numerical, *categorical]))
    return f"""
feat AS (
  SELECT feature, type, psi, ks_statistic, ks_pvalue,
         coalesce(psi >= {dbl(psi_threshold)}, false) AS psi_alert,
         coalesce(type = 'numerical' AND ks_pvalue < {dbl(ks_alpha)}, false) AS ks_alert,
         n_bins_used, CAST(CASE feature {order} END AS INTEGER) AS ordinal
  FROM (SELECT p.feature, 'numerical' AS type, p.psi, k.ks_statistic, k.ks_pvalue,
               p.n_bins_used FROM psi_n p JOIN ks_n k ON p.feature = k.feature
        UNION ALL
        SELECT feature, 'categorical', psi, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
               CAST(NULL AS INTEGER) FROM psi_c))"""


LI_BASE = f"(SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{T.LINEITEM_CUTOFF}')"
LI_CUR = f"(SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '{T.LINEITEM_CUTOFF}')"


def uniform_hash_sql(seed, *keys: str) -> str:
    parts = " || ':' || ".join([f"'{seed}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    return f"('0x' || substr(md5({parts}), 1, 8))::BIGINT"


def scored_lineitem_sql(weighted: bool = False) -> str:
    h = f"({uniform_hash_sql(T.SPLIT_SEED, 'l_orderkey', 'l_linenumber')} % 5)"
    split = f"CASE WHEN {h} < 3 THEN 'train' WHEN {h} < 4 THEN 'val' ELSE 'test' END"
    weight = ", l_discount * 10 AS w" if weighted else ""
    common = (f"l_orderkey * 10 + l_linenumber AS key, "
              f"CAST(l_returnflag = 'R' AS INTEGER) AS label, {split} AS split{weight}")
    return (f"(SELECT 'qty' AS model, {common}, l_quantity / {dbl(T.QTY_SCALE)} AS score "
            f"FROM lineitem UNION ALL "
            f"SELECT 'price' AS model, {common}, "
            f"l_extendedprice / (l_extendedprice + {dbl(T.PRICE_SCALE)}) AS score FROM lineitem)")


def total_sql(cond: str, weight: str | None) -> str:
    """Rows where a condition holds, or their weight (exact to 9 decimal places)."""
    return f"count(*) FILTER (WHERE {cond})" if weight is None else \
        f"coalesce(sum(CAST({weight} AS DECIMAL(18, 9))) FILTER (WHERE {cond}), 0)"


def rank_metrics_sql(src: str, keys: list[str], weight: str | None = None) -> str:
    """CTE body giving keys, roc_auc, pr_auc, n_pos, n_neg."""
    kind = "BIGINT" if weight is None else "DOUBLE"
    k = ", ".join(keys)
    part = f"PARTITION BY {k}"
    return f"""(
  SELECT {k}, CASE WHEN P > 0 AND N > 0 THEN auc / (CAST(P AS DOUBLE) * CAST(N AS DOUBLE)) END AS roc_auc,
         CASE WHEN P > 0 THEN coalesce(ap, 0.0) / CAST(P AS DOUBLE) END AS pr_auc,
         CAST(P AS {kind}) AS n_pos, CAST(N AS {kind}) AS n_neg
  FROM (
    SELECT {k}, any_value(P) AS P, any_value(N) AS N,
      sum(CAST(n_pos AS DOUBLE) * (CAST(cn AS DOUBLE) - CAST(n_neg AS DOUBLE) / 2.0)) AS auc,
      sum(CASE WHEN n_pos > 0 THEN CAST(n_pos AS DOUBLE) * (CAST(P - (cp - n_pos) AS DOUBLE)
          / CAST((P - (cp - n_pos)) + (N - (cn - n_neg)) AS DOUBLE)) END) AS ap
    FROM (
      SELECT *, sum(n_pos) OVER ({part} ORDER BY score ROWS UNBOUNDED PRECEDING) AS cp,
                sum(n_neg) OVER ({part} ORDER BY score ROWS UNBOUNDED PRECEDING) AS cn,
                sum(n_pos) OVER ({part}) AS P, sum(n_neg) OVER ({part}) AS N
      FROM (SELECT {k}, CAST(score AS DOUBLE) AS score,
                   {total_sql("label = 1", weight)} AS n_pos,
                   {total_sql("label = 0", weight)} AS n_neg
            FROM {src} WHERE score IS NOT NULL GROUP BY {k}, score))
    GROUP BY {k}))"""


def point_metrics_sql(src: str, keys: list[str], threshold: float = 0.5, weight: str | None = None) -> str:
    from tabwatch.operators.metrics import LOG_LOSS_EPS
    k = ", ".join(keys)
    t = dbl(threshold)
    mean = (lambda x: f"avg({x})") if weight is None else \
        (lambda x: f"sum({weight} * {x}) / nullif(sum(CASE WHEN score IS NOT NULL THEN {weight} END), 0)")
    return f"""(
  SELECT {k}, CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0
                   ELSE CAST(2 * tp AS DOUBLE) / CAST(2 * tp + fp + fn AS DOUBLE) END AS f1,
         log_loss, brier, tp, fp, fn, tn
  FROM (SELECT {k},
      {total_sql(f"score >= {t} AND label = 1", weight)} AS tp,
      {total_sql(f"score >= {t} AND label = 0", weight)} AS fp,
      {total_sql(f"score < {t} AND label = 1", weight)} AS fn,
      {total_sql(f"score < {t} AND label = 0", weight)} AS tn,
      -{mean(f"ln(least(greatest(CASE WHEN label = 1 THEN score ELSE 1.0 - score END, "
             f"{dbl(LOG_LOSS_EPS)}), {dbl(1.0 - LOG_LOSS_EPS)}))")} AS log_loss,
      {mean("power(score - label, 2)")} AS brier
    FROM {src} GROUP BY {k}))"""


def sweep_sql(src: str, keys: list[str], thresholds: list[float], weight: str | None = None) -> str:
    w = None if weight is None else f"s.{weight}"
    k = ", ".join(f"s.{x}" for x in keys)
    tl = ", ".join(dbl(t) for t in sorted(set(thresholds)))
    return f"""(
  SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
                 ELSE 2 * precision * recall / (precision + recall) END AS f1
  FROM (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) END
                  AS precision,
               CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) END AS recall
        FROM (SELECT {k}, t.threshold,
                {total_sql("s.score >= t.threshold AND s.label = 1", w)} AS tp,
                {total_sql("s.score >= t.threshold AND s.label = 0", w)} AS fp,
                {total_sql("s.score < t.threshold AND s.label = 1", w)} AS fn,
                {total_sql("s.score < t.threshold AND s.label = 0", w)} AS tn
              FROM {src} s, (SELECT unnest([{tl}]) AS threshold) t
              GROUP BY {k}, t.threshold)))"""


def calibration_sql(src: str, keys: list[str], n_bins: int = 10, weight: str | None = None) -> str:
    import numpy as np
    edges = [float(x) for x in np.linspace(0.0, 1.0, n_bins + 1)]
    el = "[" + ", ".join(dbl(e) for e in edges) + "]"
    il = "[" + ", ".join(dbl(e) for e in edges[1:-1]) + "]"
    k = ", ".join(keys)
    j = " AND ".join(f"sp.{x} = a.{x}" for x in keys)
    mean = (lambda x: f"avg({x})") if weight is None else (lambda x: f"sum({weight} * {x}) / nullif(sum({weight}), 0)")
    extra = "" if weight is None else ", coalesce(a.ws, 0.0) AS weight_sum"
    return f"""(
  SELECT {", ".join(f"sp.{x}" for x in keys)}, CAST(sp.bin AS INTEGER) AS bin,
         {el}[sp.bin + 1] AS bin_lower, {el}[sp.bin + 2] AS bin_upper,
         a.predicted_mean, a.observed_rate, CAST(coalesce(a.cnt, 0) AS BIGINT) AS count{extra}
  FROM (SELECT {k}, b AS bin FROM (SELECT DISTINCT {k} FROM {src}
                                   WHERE score >= 0 AND score <= 1),
                                  range(0, {n_bins}) r(b)) sp
  LEFT JOIN (SELECT {k}, len(list_filter({il}, lambda e: e <= score)) AS bin,
                    {mean("score")} AS predicted_mean, {mean("CAST(label AS DOUBLE)")} AS observed_rate,
                    count(*) AS cnt{"" if weight is None else f", sum({weight}) AS ws"}
             FROM {src} WHERE score >= 0 AND score <= 1 GROUP BY ALL) a
  ON {j} AND sp.bin = a.bin)"""


# --------------------------------------------------------------------------- contracts

def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, float):
        return dbl(v)
    return str(v)


def contract_rules_sql(contract, columns: list[str]) -> list[tuple[str, str, str]]:
    """(rule, column, violated-SQL) in the same order as the Spark compiler."""
    out = []
    for c in contract.columns:
        if c.name not in columns:
            continue
        x = c.name
        if not c.nullable:
            out.append((f"{x}:not_null", x, f"({x} IS NULL)"))
        checks = []
        if c.isin is not None:
            checks.append(("isin", f"{x} NOT IN ({', '.join(_lit(v) for v in c.isin)})"))
        if c.ge is not None:
            checks.append(("ge", f"{x} < {_lit(c.ge)}"))
        if c.gt is not None:
            checks.append(("gt", f"{x} <= {_lit(c.gt)}"))
        if c.le is not None:
            checks.append(("le", f"{x} > {_lit(c.le)}"))
        if c.lt is not None:
            checks.append(("lt", f"{x} >= {_lit(c.lt)}"))
        for kind, bad in checks:
            out.append((f"{x}:{kind}", x, f"coalesce({bad}, false)"))
    return out


def _unique_keys(contract) -> list[list[str]]:
    return [[c.name] for c in contract.columns if c.unique] + [list(u) for u in contract.unique]


def _dup_sql(src: str, key: list[str]) -> str:
    cols = ", ".join(key)
    present = " AND ".join(f"{c} IS NOT NULL" for c in key)
    return f"SELECT {cols}, count(*) AS n FROM {src} q WHERE {present} GROUP BY {cols} HAVING count(*) > 1"


def contract_summary_sql(src: str, contract, columns: list[str]) -> str:
    rules = contract_rules_sql(contract, columns)
    parts = [f"SELECT '{r}' AS rule, '{c}' AS column, CAST(count(*) FILTER (WHERE {b}) AS BIGINT)"
             f" AS n_violations FROM {src} t" for r, c, b in rules]
    for key in _unique_keys(contract):
        name = ",".join(key)
        parts.append(f"SELECT '{name}:unique' AS rule, '{name}' AS column, "
                     f"CAST(coalesce(sum(n), 0) AS BIGINT) AS n_violations FROM ({_dup_sql(src, key)})")
    return "\nUNION ALL\n".join(parts)


def contract_flags_sql(src: str, contract, columns: list[str]) -> str:
    """src columns + _violations (comma-joined rule names, '' when clean)."""
    rules = contract_rules_sql(contract, columns)
    joins, items = "", [f"CASE WHEN {b} THEN '{r}' END" for r, _, b in rules]
    for i, key in enumerate(_unique_keys(contract)):
        on = " AND ".join(f"t.{c} = _u{i}.{c}" for c in key)
        joins += f" LEFT JOIN ({_dup_sql(src, key)}) _u{i} ON {on}"
        items.append(f"CASE WHEN _u{i}.n IS NOT NULL THEN '{','.join(key)}:unique' END")
    return f"(SELECT t.*, concat_ws(',', {', '.join(items)}) AS _violations FROM {src} t{joins})"


def contract_detail_sql(src: str, contract, columns: list[str]) -> str:
    key = ", ".join(f"t.{c}" for c in contract.key)
    rules = contract_rules_sql(contract, columns)
    parts = [f"SELECT {key}, '{r}' AS rule, '{c}' AS column FROM {src} t WHERE {b}"
             for r, c, b in rules]
    for u in _unique_keys(contract):
        on = " AND ".join(f"t.{c} = d.{c}" for c in u)
        name = ",".join(u)
        parts.append(f"SELECT {key}, '{name}:unique' AS rule, '{name.split(':')[0]}' AS column FROM {src} t "
                     f"JOIN ({_dup_sql(src, u)}) d ON {on}")
    return "\nUNION ALL\n".join(parts)


# --------------------------------------------------------------------------- profile

PROFILE = f"""(
  SELECT customer_id, segment, nation, tenure, n_orders, total_spend,
         total_spend / CAST(tenure + 1 AS DOUBLE) AS monthly_spend, acctbal, churned
  FROM (SELECT c.c_custkey AS customer_id, c.c_mktsegment AS segment, n.n_name AS nation,
               CAST((year(o._last) * 12 + month(o._last))
                    - (year(o._first) * 12 + month(o._first)) AS INTEGER) AS tenure,
               CAST(coalesce(o.n_orders, 0) AS BIGINT) AS n_orders, o.total_spend,
               c.c_acctbal AS acctbal,
               CASE WHEN o._last IS NULL OR o._last < TIMESTAMP '{T.CHURN_CUTOFF}' THEN 'Yes'
                    ELSE 'No' END AS churned
        FROM customer c
        LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS _first, max(o_orderdate) AS _last,
                          count(*) AS n_orders, round(sum(o_totalprice), 2) AS total_spend
                   FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey
        LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey))"""

PROCESSED = f"""(
  SELECT customer_id, segment, nation, coalesce(tenure, 0) AS tenure, n_orders,
         coalesce(total_spend, 0.0) AS total_spend, coalesce(monthly_spend, 0.0) AS monthly_spend,
         acctbal, CAST(churned = 'Yes' AS INTEGER) AS churn
  FROM {PROFILE})"""


def allocation_sql(src: str, n_col: str, size: float, out: str) -> str:
    """Largest-remainder allocation over strata rows (stratum, n_col, ...)."""
    return f"""(
  SELECT * EXCLUDE (_want, _quota, _base, _rest, _rk),
         CAST(_base + CASE WHEN _rk <= _rest THEN 1 ELSE 0 END AS BIGINT) AS {out}
  FROM (SELECT *, row_number() OVER (ORDER BY _quota - _base DESC, stratum) AS _rk
        FROM (SELECT *, _want - sum(_base) OVER () AS _rest
              FROM (SELECT *, floor(_quota) AS _base
                    FROM (SELECT *, CAST(_want * {n_col} AS DOUBLE)
                                    / CAST(sum({n_col}) OVER () AS DOUBLE) AS _quota
                          FROM (SELECT *, ceil({dbl(size)} * CAST(sum({n_col}) OVER () AS DOUBLE))
                                          AS _want FROM {src}))))))"""


def ranked_sql(src: str, key: str, stratum: str, seed: int) -> str:
    return f"""(
  SELECT {key}, {stratum} AS stratum,
         row_number() OVER (PARTITION BY {stratum}
                            ORDER BY {uniform_hash_sql(seed, key)}, {key}) - 1 AS rk
  FROM {src})"""


def split_sql(src: str, key: str, stratum: str, test_size: float, val_size: float,
              seed: int) -> str:
    strata = f"(SELECT {stratum} AS stratum, count(*) AS ns FROM {src} GROUP BY 1)"
    a1 = allocation_sql(strata, "ns", test_size, "t")
    a2 = allocation_sql(f"(SELECT *, ns - t AS left_n FROM {a1})", "left_n", val_size, "v")
    return f"""(
  SELECT r.{key}, CASE WHEN r.rk < a.t THEN 'test' WHEN r.rk < a.t + a.v THEN 'val'
                      ELSE 'train' END AS split
  FROM {ranked_sql(src, key, stratum, seed)} r JOIN {a2} a ON r.stratum = a.stratum)"""

# train split of the processed profile, as used by the feature and model plans
TRAIN = (f"(SELECT p.* FROM {PROCESSED} p JOIN "
         f"{split_sql(PROCESSED, 'customer_id', 'churn', 0.2, 0.2, 42)} s "
         f"ON p.customer_id = s.customer_id WHERE s.split = 'train')")


# --------------------------------------------------------------------------- fingerprint

def fingerprint_sql(tbl: str, cols: list[tuple[str, str]]) -> str:
    """cols: (name, DuckDB type)."""
    def text(c: str, t: str) -> str:
        if t in ("DOUBLE", "FLOAT"):
            return double_text_sql(c, "VARCHAR")
        if t == "TIMESTAMP":
            return f"CAST(epoch_us({c}) AS VARCHAR)"
        if t == "FLOAT[]":
            return (f"array_to_string(list_transform({c}, lambda e: coalesce({double_text_sql('e', 'VARCHAR')}, 'N')), ',')")
        return f"CAST({c} AS VARCHAR)"

    fields = " || ".join(f"coalesce(CAST(length({text(c, t)}) AS VARCHAR) || ':' || {text(c, t)}, 'N')" for c, t in cols)
    word = lambda k: f"('0x' || substr(d, {8 * k + 1}, 8))::BIGINT"
    half = lambda k: f"CAST(sum({word(2 * k)}::HUGEINT * 4294967296 + {word(2 * k + 1)}) AS DECIMAL(38,0))"
    xors = ", ".join(f"lpad(lower(to_hex(bit_xor({word(k)}))), 8, '0')" for k in range(4))
    return (f"SELECT '{tbl}' AS table_name, count(*) AS n_rows, {half(0)} AS fp_sum_hi, {half(1)} AS fp_sum_lo, "
            f"concat({xors}) AS fp_xor FROM (SELECT md5({fields}) AS d FROM {tbl})")

"""Distributed running sums and exact order statistics.

``Window.partitionBy(key).orderBy(x)`` puts every row of a key into one task, which does not
survive a key holding a third of a 100 TB table. Instead:

1. per key, approximate quantiles of the order column cut it into ``n_buckets`` buckets
   (a small table: keys x n_buckets values);
2. the bucket of a row is the number of cut points strictly below its value, a plain column
   expression, so recomputation after an executor loss gives the same bucket;
3. totals per (key, bucket) and their running sum give each bucket's offset (<= n_buckets
   rows per key);
4. a window over (key, bucket) ordered by the value adds the offset.

Bucket boundaries only affect balance, never results. Inputs are expected to be
pre-aggregated to one row per (key, order value) -- the callers do that with a map-side
combined ``groupBy`` -- so a hot value is one row, not a skewed partition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Broadcast a side table only when its size is proven below this bound.
BROADCAST_BYTES = 64 << 20


def hint_small(df: DataFrame, max_rows: int | None, row_bytes: int = 128) -> DataFrame:
    """Broadcast ``df`` when the caller can bound its rows and their width; otherwise leave the
    choice to AQE, which broadcasts at run time only if the measured output is small."""
    if max_rows is not None and max_rows * row_bytes <= BROADCAST_BYTES:
        return F.broadcast(df)
    return df


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where NULL equals NULL, so that no group is lost; the keys appear
    once, as in a join by names."""
    renamed = right.select(*[F.col(k).alias(f"__{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(F.col(f"__{k}"))
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, how).drop(*[f"__{k}" for k in keys])


def count_below(df: DataFrame, sorted_arr, value, max_len: int, out: str,
                inclusive: bool = False) -> DataFrame:
    """``out`` = number of elements of the ascending array ``sorted_arr`` (at most
    ``max_len`` long) that are < value (<= with ``inclusive``)."""
    v = F.col(value) if isinstance(value, str) else value
    arr = F.col(sorted_arr) if isinstance(sorted_arr, str) else sorted_arr
    return df.withColumn(out, count_below_expr(arr, v, max_len, inclusive))


#: Above this array length the search is folded with ``aggregate`` (log2 steps, one
#: expression node) instead of a CASE tree whose generated code grows with the length.
TREE_MAX_LEN = 31


def count_below_expr(arr, v, max_len: int, inclusive: bool = False):
    """Number of elements of the ascending array ``arr`` that are < v (<= with inclusive)."""
    if max_len <= TREE_MAX_LEN:
        return _count_below_tree(arr, v, max_len, inclusive)
    return _count_below_fold(arr, v, max_len, inclusive)


def _count_below_fold(arr, v, max_len: int, inclusive: bool = False):
    """Binary search folded with ``aggregate``: ceil(log2(max_len + 1)) ``element_at`` probes,
    O(log B) per row instead of the O(B) of a ``filter`` scan, and a single expression node,
    so the optimizer cannot blow the tree up when it merges projections."""
    steps = []
    s = 1
    while s <= max_len:
        steps.append(s)
        s *= 2
    n = F.size(arr)

    def step(acc, st):
        probe = acc + st
        e = F.element_at(arr, probe)
        hit = (e <= v) if inclusive else (e < v)
        return F.when((probe <= n) & hit, probe).otherwise(acc)

    return F.aggregate(F.array(*[F.lit(x) for x in reversed(steps)]), F.lit(0), step)


def _count_below_tree(arr, v, max_len: int, inclusive: bool = False):
    """Binary search as a balanced ``CASE WHEN`` tree over array probes: O(max_len) expression
    nodes, O(log max_len) comparisons per row, all inside whole-stage codegen (a
    ``filter``/``aggregate`` lambda would be interpreted row by row). Each probe is guarded by
    the array size, so shorter arrays (e.g. after de-duplication) are fine."""
    n = F.size(arr)

    def below(i):  # element i (0-based) is below v
        e = F.get(arr, F.lit(i))
        return (n > i) & ((e <= v) if inclusive else (e < v))

    probes = [below(i) for i in range(max_len)]

    def tree(lo: int, hi: int):
        # invariant: elements [0, lo) are below v, elements [hi, max_len) are not
        if lo >= hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(probes[mid], tree(mid + 1, hi)).otherwise(tree(lo, mid))

    return tree(0, max_len)


_CHUNK = TREE_MAX_LEN + 1   # 32


def _assign_buckets(df: DataFrame, bounds: DataFrame, keys: list[str], order_col: str,
                    max_len: int, key_bound: int | None) -> DataFrame:
    """``_bucket`` = number of per-key cut points below the value.

    A search with 32 branches: each level joins, by (key, place so far), the at most 31 cut
    points that divide the range still open, and one code-generated CASE tree picks the part.
    Any number of cut points: 1,023 take two levels, 32,767 three. Keys are compared
    null-safe."""
    v = F.col(order_col)
    levels = 1
    while _CHUNK ** levels - 1 < max_len:
        levels += 1
    out, bound = df.withColumn("_bucket", F.lit(0)), key_bound
    for level in range(levels - 1, -1, -1):
        step = _CHUNK ** level          # cut points between two neighbours of this level
        width = step * _CHUNK           # cut points under one place of this level
        parts = bounds.select(*keys, F.explode(F.sequence(
            F.lit(0), F.floor(F.size("_bounds") / width).cast("int"))).alias("_p"), "_bounds")
        cuts = parts.select(*keys, (F.col("_p") * width).alias("_bucket"), F.filter(
            F.slice("_bounds", F.col("_p") * width + 1, width - 1),
            lambda x, i: (i + 1) % step == 0).alias("_c"))
        out = join_null_safe(out, hint_small(cuts, bound, 31 * 8 + 32), [*keys, "_bucket"]) \
            .withColumn("_bucket", F.col("_bucket") + step * _count_below_tree(F.col("_c"), v, TREE_MAX_LEN)) \
            .drop("_c")
        bound = None if bound is None else bound * _CHUNK
    return out


@dataclass
class RunningTotals:
    """``rows``: input columns + ``_bucket`` + ``cum_<c>`` (inclusive running sums, ties
    included). ``buckets``: keys, ``_bucket``, ``_tot_<c>`` and ``_off_<c>`` (sum over all
    earlier buckets)."""

    rows: DataFrame
    buckets: DataFrame
    keys: list[str]
    order_col: str
    value_cols: list[str]
    key_bound: int | None
    n_buckets: int

    def key_totals(self) -> DataFrame:
        """keys + ``total_<c>`` per key (<= number of keys rows)."""
        return self.buckets.groupBy(*self.keys).agg(
            *[F.sum(f"_tot_{c}").alias(f"total_{c}") for c in self.value_cols]
        )


def running_totals(df: DataFrame, keys: list[str], order_col: str, value_cols: list[str],
                   n_buckets: int = 1024, key_bound: int | None = None,
                   accuracy: int = 10000, bounds_from: DataFrame | None = None) -> RunningTotals:
    """Inclusive running sums of ``value_cols`` ordered by ``order_col`` within ``keys``.

    ``key_bound``: an upper bound on the number of distinct keys when the caller knows it
    (e.g. the number of feature columns); enables broadcast of the per-key side tables.
    ``bounds_from``: rows (keys, order column) whose sketch gives the bucket bounds, instead of
    ``df`` itself; bounds only affect balance. NULL keys are groups of their own.

    The sketch of ``df`` reads all its columns, as the other steps do, so that an exchange below
    ``df`` is the same for each of them and is computed once.
    """
    small = None if key_bound is None else key_bound * max(n_buckets, 1)
    accuracy = max(accuracy, n_buckets)
    if n_buckets > 1:
        probs = [i / n_buckets for i in range(1, n_buckets)]
        value = F.col(order_col)
        if bounds_from is None:
            counted = F.greatest(*value_cols) if len(value_cols) > 1 else F.col(value_cols[0])
            value = F.when(counted >= 0, value)
        bounds = (df if bounds_from is None else bounds_from).groupBy(*keys).agg(F.coalesce(
            F.array_distinct(F.percentile_approx(value, probs, accuracy)),
            F.array().cast("array<double>")).alias("_bounds")
        )
        bucketed = _assign_buckets(df, bounds, keys, order_col, n_buckets - 1, key_bound)
    else:
        bucketed = df.withColumn("_bucket", F.lit(0))

    totals = bucketed.groupBy(*keys, "_bucket").agg(
        *[F.sum(c).alias(f"_tot_{c}") for c in value_cols]
    )
    upto = (Window.partitionBy(*keys).orderBy("_bucket")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    buckets = totals.select(
        *keys, "_bucket", *[f"_tot_{c}" for c in value_cols],
        *[(F.sum(f"_tot_{c}").over(upto) - F.col(f"_tot_{c}")).alias(f"_off_{c}")
          for c in value_cols],
    )
    offsets = buckets.select(*keys, "_bucket", *[f"_off_{c}" for c in value_cols])
    within = (Window.partitionBy(*keys, "_bucket").orderBy(order_col)
              .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    rows = (
        join_null_safe(bucketed, hint_small(offsets, small), [*keys, "_bucket"])
        .select(
            *bucketed.columns,
            *[(F.sum(c).over(within) + F.col(f"_off_{c}")).alias(f"cum_{c}")
              for c in value_cols],
        )
    )
    return RunningTotals(rows, buckets, list(keys), order_col, list(value_cols), key_bound,
                         n_buckets)


def quantile_targets(n_per_key: DataFrame, keys: list[str], n_col: str,
                     probs: list[float]) -> DataFrame:
    """keys + ``_lo_<i>``, ``_hi_<i>`` (0-based ranks floor/ceil of (n - 1) p_i) and
    ``_fr_<i>`` (the fraction), one row per key with n > 0."""
    cols = []
    for i, p in enumerate(probs):
        pos = (F.col(n_col) - 1).cast("double") * F.lit(float(p))
        cols += [F.floor(pos).cast("long").alias(f"_lo_{i}"),
                 F.ceil(pos).cast("long").alias(f"_hi_{i}"),
                 (pos - F.floor(pos).cast("double")).alias(f"_fr_{i}")]
    return n_per_key.where(F.col(n_col) > 0).select(*keys, *cols)


def quantile_aggs(order_col: str, count_col: str, cum_col: str, n_probs: int) -> list:
    """Aggregates picking, per key, the value holding each target rank: the row whose
    [cum - count, cum) interval contains the rank. Rows with count 0 hold no rank."""
    v, c, cum = F.col(order_col), F.col(count_col), F.col(cum_col)
    out = []
    for i in range(n_probs):
        for side in ("lo", "hi"):
            r = F.col(f"_{side}_{i}")
            out.append(F.max(F.when((r >= cum - c) & (r < cum), v)).alias(f"_v{side}_{i}"))
    return out


def quantile_values(n_probs: int) -> list:
    """lo + (hi - lo) * frac per target, as ``q_<i>`` columns."""
    return [(F.col(f"_vlo_{i}") + (F.col(f"_vhi_{i}") - F.col(f"_vlo_{i}")) * F.col(f"_fr_{i}"))
            .alias(f"q_{i}") for i in range(n_probs)]


def exact_quantiles(rt: RunningTotals, count_col: str, probs: list[float]) -> DataFrame:
    """Exact quantiles with linear interpolation between order statistics.

    With n = total count of the key and pos = (n - 1) * p, the result is
    lo + (hi - lo) * (pos - floor(pos)) where lo / hi are the values at 0-based ranks
    floor(pos) / ceil(pos) -- the rule used by NumPy's default and DuckDB's quantile_cont.
    One map-side combined aggregate over the running sums (the per-key target ranks are a
    one-row-per-key side table). Returns keys, ``q_idx``, ``q_value``.
    """
    keys = rt.keys
    n = rt.buckets.groupBy(*keys).agg(F.sum(f"_tot_{count_col}").alias("_n"))
    targets = quantile_targets(n, keys, "_n", probs)
    agg = (join_null_safe(rt.rows, hint_small(targets, rt.key_bound, 64 * len(probs)), keys)
           .groupBy(*keys, *[f"_fr_{i}" for i in range(len(probs))])
           .agg(*quantile_aggs(rt.order_col, count_col, f"cum_{count_col}", len(probs))))
    q = agg.select(*keys, F.array(*quantile_values(len(probs))).alias("_q"))
    return q.select(*keys, F.posexplode("_q").alias("q_idx", "q_value"))

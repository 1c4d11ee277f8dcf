"""Exact, deterministic stratified splits and folds without a global sort.

Each row gets h = md5-hash(seed, key) (32 bits); within a stratum rows are ordered by
(h, key). A split is given by two cuts per stratum. Counts per (stratum, top ``prefix_bits`` of
h) and their running sum tell which prefix holds a cut; only the rows of those prefixes (two
per stratum) are ranked, which gives each cut as a pair (h, key). Then one narrow pass compares
every row with the cuts of its stratum: no row is shuffled for the result. A stratum holding a
third of the table is spread over 2^prefix_bits counts.

Sizes follow the usual rule: n_test = ceil(test_size * n); strata get floor of their share,
and the remaining rows go to the largest fractional shares (ties: smaller stratum value, NULL
first). Validation is cut the same way from the rows left after the test cut. NULL is a
stratum of its own; a NULL key raises.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwatch.functions.hashing import uniform_hash
from tabwatch.operators.prefix import hint_small, join_null_safe

#: Strata are listed on the driver; a column with more values is no stratum.
MAX_STRATA = 10_000


def _check_size(name: str, v: float) -> None:
    if not 0.0 < v < 1.0:
        raise ValueError(f"{name} must be in (0, 1); got {v}")


def _allocate(sizes: list[int], size: float) -> list[int]:
    """Largest-remainder allocation of ceil(size * total) rows over strata in their order."""
    total = sum(sizes)
    want = math.ceil(size * float(total))
    quota = [float(want * n) / float(total) if total else 0.0 for n in sizes]
    out = [math.floor(q) for q in quota]
    order = sorted(range(len(sizes)), key=lambda i: (-(quota[i] - out[i]), i))
    for i in order[:max(0, want - sum(out))]:
        out[i] += 1
    return out


def _ordered(df: DataFrame, key: str, strata_col: str, seed: int, prefix_bits: int):
    if strata_col not in df.columns:
        raise KeyError(f"strata column {strata_col!r} not found")
    h = uniform_hash(seed, key)
    return df.withColumn("_h", h).withColumn("_stratum", F.col(strata_col)) \
        .withColumn("_prefix", F.shiftright(F.col("_h"), 32 - prefix_bits))


def _prefix_counts(d: DataFrame, key: str, strata_col: str, max_strata: int):
    """(stored counts per (stratum, prefix), [(stratum, rows)] in order)."""
    counts = d.groupBy("_stratum", "_prefix").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col(key).isNull()).alias("_null")).persist()
    sizes = counts.groupBy("_stratum").agg(F.sum("_n").alias("n"), F.sum("_null").alias("null")) \
        .orderBy(F.asc_nulls_first("_stratum")).limit(max_strata + 1).collect()
    if len(sizes) > max_strata or any(r["null"] for r in sizes):
        counts.unpersist()
        raise ValueError(f"{strata_col} has more than {max_strata} values" if len(sizes) > max_strata
                         else f"the key {key} has NULLs")
    return counts, [(r["_stratum"], r["n"]) for r in sizes]


def _offsets(counts: DataFrame) -> DataFrame:
    """_stratum, _prefix, _n, _off: rows of the stratum in earlier prefixes (a window over at
    most 2^prefix_bits rows per stratum)."""
    w = Window.partitionBy("_stratum").orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_stratum", "_prefix", "_n", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))


def hash_split(df: DataFrame, key: str, test_size: float = 0.2, val_size: float = 0.2, seed: int = 42,
               out: str = "split") -> DataFrame:
    """Adds ``out`` in {'train', 'val', 'test'} by thresholds on the row's hash: one narrow pass,
    no counts, no state, so it runs on streams too, and a row gets the same split whenever and
    wherever it comes. Sizes and class rates are met in expectation: of n rows a share p deviates
    by about sqrt(p (1 - p) / n). Rows with equal keys stay together; a NULL key fails the job."""
    _check_size("test_size", test_size)
    _check_size("val_size", val_size)
    test, val = cut_points(test_size, val_size)
    bad = F.raise_error(F.lit(f"the key {key} has NULLs")).cast("long")
    h = F.when(F.col(key).isNull(), bad).otherwise(uniform_hash(seed, key))
    return df.withColumn(out, F.when(h < test, "test").when(h < val, "val").otherwise("train"))


def cut_points(test_size: float, val_size: float) -> tuple[int, int]:
    """Hashes below the first are test rows, others below the second validation rows."""
    test = math.floor(test_size * 2 ** 32)
    return test, test + math.floor(val_size * (2 ** 32 - test))


def stratified_split(df: DataFrame, key: str, strata_col: str, test_size: float = 0.2,
                     val_size: float = 0.2, seed: int = 42, prefix_bits: int = 16,
                     max_strata: int = MAX_STRATA, out: str = "split", mode: str = "exact") -> DataFrame:
    """Adds ``out`` in {'train', 'val', 'test'}: exact stratified sizes (64/16/20 for the
    defaults), identical for any partitioning. ``key`` must be unique and non-NULL. A strata
    column with more than ``max_strata`` values raises. ``mode='approx'``: ``hash_split``, whose
    sizes hold in expectation within every stratum; any number of strata."""
    if mode not in ("exact", "approx"):
        raise ValueError(f"mode must be 'exact' or 'approx'; got {mode!r}")
    _check_size("test_size", test_size)
    _check_size("val_size", val_size)
    if mode == "approx":
        if strata_col not in df.columns:
            raise KeyError(f"strata column {strata_col!r} not found")
        return hash_split(df, key, test_size, val_size, seed, out)
    d = _ordered(df, key, strata_col, seed, prefix_bits)
    counts, strata = _prefix_counts(d, key, strata_col, max_strata)
    try:
        test = _allocate([n for _, n in strata], test_size)
        val = _allocate([n - t for (_, n), t in zip(strata, test)], val_size)
        spark, kind = df.sparkSession, d.schema["_stratum"].dataType.simpleString()
        schema = f"_stratum {kind}, _cut int, _at long"
        cuts = [(s, c, at) for (s, n), t, v in zip(strata, test, val)
                for c, at in ((0, t), (1, t + v)) if 0 < at < n]
        # the prefix that holds row number _at of its stratum, and the rank within it
        holds = join_null_safe(_offsets(counts), F.broadcast(spark.createDataFrame(cuts, schema)), ["_stratum"]) \
            .where("_off <= _at AND _at < _off + _n") \
            .select("_stratum", "_prefix", "_cut", (F.col("_at") - F.col("_off")).alias("_rank"))
        inside = join_null_safe(d.select("_stratum", "_prefix", "_h", F.col(key).alias("_key")),
                                F.broadcast(holds.groupBy("_stratum", "_prefix").agg(
                                    F.collect_list(F.struct("_cut", "_rank")).alias("_cuts"))),
                                ["_stratum", "_prefix"])
        rank = F.row_number().over(Window.partitionBy("_stratum", "_prefix").orderBy("_h", "_key")) - 1
        found = inside.withColumn("_r", rank).select("_stratum", "_h", "_key", "_r", F.explode("_cuts").alias("_c")) \
            .where("_r = _c._rank").select("_stratum", F.col("_c._cut").alias("_cut"), "_h", "_key").collect()
    finally:
        counts.unpersist()
    at = {(r["_stratum"], r["_cut"]): (r["_h"], r["_key"]) for r in found}
    none = (None, None)
    key_type = df.schema[key].dataType.simpleString()
    # a cut at 0 lies before every row, one at n after the last
    rows = [(s, *at.get((s, 0), none), t >= n, *at.get((s, 1), none), t + v >= n)
            for (s, n), t, v in zip(strata, test, val)]
    table = spark.createDataFrame(rows, (
        f"_stratum {kind}, _th long, _tk {key_type}, _tall boolean, _vh long, _vk {key_type}, _vall boolean"))

    def before(h: str, k: str, every: str):
        return F.col(every) | F.coalesce(
            (F.col("_h") < F.col(h)) | ((F.col("_h") == F.col(h)) & (F.col(key) < F.col(k))), F.lit(False))

    j = join_null_safe(d, F.broadcast(table), ["_stratum"])
    return j.withColumn(out, F.when(before("_th", "_tk", "_tall"), "test")
                        .when(before("_vh", "_vk", "_vall"), "val").otherwise("train")) \
        .drop("_h", "_stratum", "_prefix", "_th", "_tk", "_tall", "_vh", "_vk", "_vall")


def stratified_folds(df: DataFrame, key: str, strata_col: str, k: int = 5, seed: int = 42,
                     prefix_bits: int = 16, max_strata: int = MAX_STRATA,
                     out: str = "fold") -> DataFrame:
    """Adds ``out`` = (rank of the row in its stratum by (h, key)) mod k: every fold gets
    floor or ceil of n_s / k rows of each stratum. Every row is ranked, but by a window over
    (stratum, prefix) groups plus prefix offsets, never over a whole stratum. NULL is a
    stratum of its own; a NULL key or more than ``max_strata`` strata raise."""
    if k < 2:
        raise ValueError(f"k must be >= 2; got {k}")
    d = _ordered(df, key, strata_col, seed, prefix_bits)
    counts, strata = _prefix_counts(d, key, strata_col, max_strata)
    offsets = _offsets(d.groupBy("_stratum", "_prefix").agg(F.count(F.lit(1)).alias("_n"))) \
        .select("_stratum", "_prefix", "_off")
    counts.unpersist()
    rank = F.row_number().over(Window.partitionBy("_stratum", "_prefix").orderBy("_h", key))
    small = hint_small(offsets, min(len(strata) << prefix_bits, sum(n for _, n in strata)), 48)
    return (join_null_safe(d, small, ["_stratum", "_prefix"])
            .withColumn(out, F.pmod(F.col("_off") + rank - 1, F.lit(k)).cast("int"))
            .drop("_h", "_stratum", "_prefix", "_off"))


def split_stats(df: DataFrame, label: str, split_col: str = "split") -> DataFrame:
    """Split, n, positive_rate."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"),
                                     F.avg(F.col(label).cast("double")).alias("positive_rate"))

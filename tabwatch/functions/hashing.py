"""Deterministic hashing used for splits, folds, resampling and fingerprints.

``rand(seed)`` depends on how rows are partitioned, so it cannot give the same split after a
repartition or an executor loss. A hash of (seed, key) does, and the same formula is
available in DuckDB (``('0x' || substr(md5(s), 1, 8))::BIGINT``), so hashed results can be
checked against SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: separator of the fields of a hashed key.
KEY_SEP = ":"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _escaped(k: str | Column) -> Column:
    text = F.replace(_c(k).cast("string"), F.lit("\\"), F.lit("\\\\"))
    return F.replace(text, F.lit(KEY_SEP), F.lit("\\" + KEY_SEP))


def uniform_hash(seed: int | str, *keys: str | Column, salt: str | None = None) -> Column:
    """32-bit unsigned hash (BIGINT in [0, 2^32)) of md5(seed[:salt]:key...). Separators inside
    a field are escaped and a NULL key has a mark of its own, so different fields differ."""
    parts = [F.lit(str(seed))]
    if salt is not None:
        parts.append(F.lit(str(salt)))
    parts += [F.coalesce(_escaped(k), F.lit("\\N")) for k in keys]
    return F.conv(F.substring(F.md5(F.concat_ws(KEY_SEP, *parts)), 1, 8), 16, 10).cast("long")


def unit_hash(seed: int | str, *keys: str | Column, salt: str | None = None) -> Column:
    """uniform_hash / 2^32: a reproducible draw in [0, 1)."""
    return uniform_hash(seed, *keys, salt=salt).cast("double") / F.lit(4294967296.0)


def double_text_sql(x: str, text: str = "STRING") -> str:
    """SQL of an exact text of a floating value: sign, integer part and three groups of 52
    fraction bits, each an exact integer (so values 1e-9 apart differ). Beyond the 64-bit
    integers or 156 fraction bits, the engine's own text is appended."""
    a = f"abs(CAST({x} AS DOUBLE))"
    f1 = f"(({a} - floor({a})) * 4503599627370496.0)"
    f2 = f"(({f1} - floor({f1})) * 4503599627370496.0)"
    f3 = f"(({f2} - floor({f2})) * 4503599627370496.0)"
    part = lambda e: f"CAST(CAST(floor({e}) AS BIGINT) AS {text})"
    own = f"CAST(CAST({x} AS DOUBLE) AS {text})"
    return (f"CASE WHEN isnan(CAST({x} AS DOUBLE)) THEN 'nan' WHEN {a} >= 9e18 THEN {own} "
            f"ELSE concat(CASE WHEN CAST({x} AS DOUBLE) < 0 THEN '-' ELSE '+' END, {part(a)}, '.', {part(f1)}, '.', "
            f"{part(f2)}, '.', {part(f3)}, CASE WHEN {f3} <> floor({f3}) THEN {own} ELSE '' END) END")


def canonical_sql(name: str, dtype: str) -> str:
    """SQL of the text of one field. Floating values are exact; timestamps are microseconds;
    arrays and structs are JSON."""
    x = f"`{name}`"
    if dtype in ("double", "float"):
        return double_text_sql(x)
    if dtype == "timestamp_ntz":
        return f"CAST(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {x}) AS STRING)"
    if dtype == "timestamp":
        return f"CAST(unix_micros({x}) AS STRING)"
    if dtype in ("array<float>", "array<double>"):
        item = double_text_sql("e")
        return f"concat_ws(',', transform({x}, e -> coalesce({item}, 'N')))"
    if dtype.startswith(("array", "struct", "map")):
        return f"to_json({x})"
    return f"CAST({x} AS STRING)"


def row_digest(cols: Sequence[tuple[str, str]]) -> Column:
    """md5 (32 hex digits) of the row: every field as its length, a colon and its text, NULL as
    N, so that no two different rows share a text. ``cols`` = (name, simple type)."""
    parts = []
    for n, t in cols:
        x = canonical_sql(n, t)
        parts.append(f"coalesce(CASE WHEN `{n}` IS NOT NULL THEN concat(CAST(length({x}) AS STRING), ':', {x}) END, 'N')")
    return F.expr(f"md5(concat({', '.join(parts)}))")


def with_row_digest(df: DataFrame, cols: Sequence[tuple[str, str]], out: str = "_d") -> DataFrame:
    """One column ``out``: ``row_digest`` of each row, computed in steps. A floating value's parts
    and a field's text are columns of projections of their own, so that each is computed once;
    the one expression of ``row_digest`` would write them out again wherever they are used."""
    types = dict(cols)
    floats = [n for n, t in cols if t in ("double", "float")]
    at = {n: k for k, (n, _) in enumerate(cols)}
    here = [F.col(f"`{n}`").alias(f"x{at[n]}") for n, _ in cols]
    part = lambda k, j: f"x{k}" if j < 0 else f"f{k}_{j}"
    d = df.select(*here)
    d = d.select("*", *[F.expr(f"abs(CAST(x{at[n]} AS DOUBLE))").alias(f"f{at[n]}_0") for n in floats])
    for j in (1, 2, 3):
        d = d.select("*", *[F.expr(f"(f{at[n]}_{j - 1} - floor(f{at[n]}_{j - 1})) * 4503599627370496.0").alias(f"f{at[n]}_{j}")
                            for n in floats])

    def text(n: str) -> Column:
        k, x = at[n], f"x{at[n]}"
        if n not in floats:
            return F.expr(canonical_sql(x, types[n]))
        whole = lambda j: f"CAST(CAST(floor({part(k, j)}) AS BIGINT) AS STRING)"
        own = f"CAST(CAST({x} AS DOUBLE) AS STRING)"
        return F.expr(
            f"CASE WHEN isnan(CAST({x} AS DOUBLE)) THEN 'nan' WHEN {part(k, 0)} >= 9e18 THEN {own} "
            f"ELSE concat(CASE WHEN CAST({x} AS DOUBLE) < 0 THEN '-' ELSE '+' END, {whole(0)}, '.', {whole(1)}, '.', {whole(2)}, "
            f"'.', {whole(3)}, CASE WHEN {part(k, 3)} <> floor({part(k, 3)}) THEN {own} ELSE '' END) END")
    d = d.select(*[F.when(F.col(f"x{at[n]}").isNotNull(), text(n)).alias(f"t{at[n]}") for n, _ in cols])
    field = lambda k: F.coalesce(F.concat(F.length(f"t{k}").cast("string"), F.lit(":"), F.col(f"t{k}")), F.lit("N"))
    return d.select(F.md5(F.concat(*[field(at[n]) for n, _ in cols])).alias(out))

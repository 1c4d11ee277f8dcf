"""Shared-folder tables and small column helpers of the pipeline operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Only a local session (driver and executors are one process) may leave the setting
    unset; it then gets a temporary folder. Elsewhere a missing setting raises."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.gettempdir()
    return f"{base.rstrip('/')}/tabwatch-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet and read it back: cuts the lineage with files that outlive
    any executor. ``compression``: of the files, the session's if not given."""
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote, on whatever store holds it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def finished(df: DataFrame, folder: str, compression: str | None = None) -> DataFrame:
    """Store a result beside ``folder`` and delete the tables below ``folder`` that led to it."""
    out = stored(df, f"{folder}-result", compression)
    drop_path(df.sparkSession, folder)
    return out


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def values_table(spark: SparkSession, schema: list[tuple[str, str]], rows: list[tuple]) -> DataFrame:
    """A literal table as a SQL VALUES list (no Python data path behind it). Only for fixed
    parameters: every row is part of the plan."""
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return str(v)

    names = [n for n, _ in schema]
    if not rows:
        cols = ", ".join(f"CAST(NULL AS {t}) AS {n}" for n, t in schema)
        return spark.sql(f"SELECT {cols} WHERE false")
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    cast = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in schema)
    return spark.sql(f"SELECT {cast} FROM VALUES {body} AS v({', '.join(names)})")


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """The whole row as struct ``row`` next to the given columns, so that columns of the input
    may have any names; ``unpacked`` gives the rows back."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                     *[c.alias(n) for n, c in columns.items()])


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")

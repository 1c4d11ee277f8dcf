"""Readers for the driver's parquet tables and the derived tables the plans share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

LINEITEM_CUTOFF = "1998-01-01 00:00:00"
LINEITEM_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINEITEM_CATEGORICAL = ["l_returnflag", "l_linestatus"]
PRICE_SCALE = 50000.0
QTY_SCALE = 51.0
SPLIT_SEED = 42


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ts(text: str) -> Column:
    """A TIMESTAMP_NTZ literal: comparisons against the tables' naive timestamps do not
    depend on the session time zone."""
    return F.lit(text).cast("timestamp_ntz")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column (both engines round computed doubles before the
    oracle compares them)."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def lineitem_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    li = table(spark, sf_dir, "lineitem")
    cut = ts(LINEITEM_CUTOFF)
    return li.where(F.col("l_shipdate") < cut), li.where(F.col("l_shipdate") >= cut)


def line_scores(spark: SparkSession, sf_dir: str, weighted: bool = False) -> DataFrame:
    """key, label, split, s_qty, s_price (and w): ``scored_lineitem`` with a column per model."""
    from tabwatch.functions.hashing import uniform_hash

    # the hash is a column of its own, so that it is computed once a row
    li = table(spark, sf_dir, "lineitem").withColumn("_h", uniform_hash(SPLIT_SEED, "l_orderkey", "l_linenumber") % 5)
    h = F.col("_h")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("key"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        F.when(h < 3, "train").when(h < 4, "val").otherwise("test").alias("split"),
        (F.col("l_quantity") / F.lit(QTY_SCALE)).alias("s_qty"),
        (F.col("l_extendedprice") / (F.col("l_extendedprice") + F.lit(PRICE_SCALE)))
        .alias("s_price"), *([(F.col("l_discount") * 10).alias("w")] if weighted else []),
    )


def scored_lineitem(spark: SparkSession, sf_dir: str, weighted: bool = False) -> DataFrame:
    """Scored table (model, split, key, label, score): label = returned line; two "models"
    score every line -- ``qty`` = l_quantity / 51 (50 values, heavy ties) and ``price`` =
    p / (p + 50000) (nearly all distinct). The split is a hash of the line key. ``weighted``: a
    column w too, ten times the discount (0 for some lines).

    Not ``unpivot``: plans that read its rows twice do not share an exchange above it, since its
    columns keep their identity in one of them only."""
    more = ["w"] if weighted else []
    scores = F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"s_{m}").alias("score")) for m in ("qty", "price")])
    return line_scores(spark, sf_dir, weighted).select("split", "key", "label", *more, F.inline(scores)) \
        .select("model", "split", "key", "label", *more, "score")


# Fixed values of the customer-profile plan: churn = no order in the 180 days before
# 2001-08-01 (the last order date in the data), i.e. last order before 2001-02-02.
CHURN_CUTOFF = "2001-02-02 00:00:00"
PROFILE_NUMERIC = ["tenure", "monthly_spend", "total_spend", "n_orders"]
PROFILE_CATEGORICAL = ["segment", "nation"]
NATIONS = [f"NATION_{i}" for i in range(25)]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _months(c: str) -> Column:
    return F.year(c) * 12 + F.month(c)


def customer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: customer ⋈ (orders aggregated by customer) ⋈ nation.

    Orders are aggregated before the join (map-side combined), so a customer holding a
    large share of all orders is one row by the time it meets the customer table."""
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("_first"), F.max("o_orderdate").alias("_last"),
        F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total_spend"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal",
                                                "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    tenure = (_months("_last") - _months("_first")).cast("int")
    return (
        c.join(o, c.c_custkey == o.o_custkey, "left")
        .join(n, c.c_nationkey == n.n_nationkey, "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_mktsegment").alias("segment"),
            F.col("n_name").alias("nation"),
            tenure.alias("tenure"),
            F.coalesce(F.col("n_orders"), F.lit(0)).cast("long").alias("n_orders"),
            F.col("total_spend"),
            (F.col("total_spend") / (tenure + 1).cast("double")).alias("monthly_spend"),
            F.col("c_acctbal").alias("acctbal"),
            F.when(F.col("_last").isNull() | (F.col("_last") < ts(CHURN_CUTOFF)), "Yes")
            .otherwise("No").alias("churned"),
        )
    )


# What a missing number of the profile becomes, for training and scoring alike.
PROFILE_FILL = {"total_spend": 0.0, "monthly_spend": 0.0}


def fill_profile(df: DataFrame, **label) -> DataFrame:
    """C1 and C2 share this: NULL tenure / spend -> 0."""
    from tabwatch.operators.prep import fill_and_label

    return fill_and_label(df, PROFILE_FILL, **label).withColumn("tenure", F.coalesce(F.col("tenure"), F.lit(0)))


def processed_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 on the profile: filled, label churn = churned == 'Yes'."""
    return fill_profile(customer_profile(spark, sf_dir), label_src="churned", label="churn")

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabwatch.operators import split as S


def toy(spark, n=4000, seed=11, parts=None):
    r = np.random.default_rng(seed)
    pdf = pd.DataFrame({"id": np.arange(n), "feature_a": r.normal(size=n),
                        "feature_b": r.choice(["x", "y", "z"], n),
                        "churn": (r.uniform(size=n) < 0.27).astype(int)})
    df = spark.createDataFrame(pdf)
    return (df.repartition(parts) if parts else df), pdf


def test_sizes_exact_disjoint_complete(spark):
    df, pdf = toy(spark)
    out = S.stratified_split(df, "id", "churn").toPandas()
    n = len(pdf)
    assert len(out) == n and out.id.is_unique
    n_test = math.ceil(0.2 * n)
    n_val = math.ceil(0.2 * (n - n_test))
    sizes = out.split.value_counts().to_dict()
    assert sizes == {"test": n_test, "val": n_val, "train": n - n_test - n_val}
    rate = pdf.churn.mean()
    for _, g in out.groupby("split"):
        assert abs(g.churn.mean() - rate) < 0.02
    assert abs(sizes["train"] / n - 0.64) < 0.005 and abs(sizes["test"] / n - 0.20) < 0.005


def test_partition_invariance_and_determinism(spark):
    results = []
    for parts in (1, 4, 17):
        df, _ = toy(spark, 1000, parts=parts)
        results.append(dict(S.stratified_split(df, "id", "churn", seed=3)
                            .select("id", "split").toPandas().values))
    assert results[0] == results[1] == results[2]
    df, _ = toy(spark, 1000)
    other = dict(S.stratified_split(df, "id", "churn", seed=4).select("id", "split").toPandas().values)
    assert other != results[0]


@pytest.mark.parametrize("t,v", [(0.0, 0.2), (1.0, 0.2), (0.2, 0.0), (0.2, 1.5)])
def test_bad_sizes(spark, t, v):
    df, _ = toy(spark, 10)
    with pytest.raises(ValueError):
        S.stratified_split(df, "id", "churn", t, v)


def test_missing_target(spark):
    df, _ = toy(spark, 10)
    with pytest.raises(KeyError):
        S.stratified_split(df, "id", "nope")


def test_folds_balanced(spark):
    df, pdf = toy(spark, 1003)
    out = S.stratified_folds(df, "id", "churn", k=5).toPandas()
    for _, g in out.groupby("churn"):
        c = g.fold.value_counts()
        assert c.max() - c.min() <= 1 and len(c) == 5
    stats = {r.split: r for r in S.split_stats(
        S.stratified_split(df, "id", "churn"), "churn").collect()}
    assert sum(r.n for r in stats.values()) == 1003


def test_tiny_table(spark):
    df = spark.createDataFrame([(1, 0)], "id long, churn int")
    assert [r.split for r in S.stratified_split(df, "id", "churn").collect()] == ["test"]


def test_approximate_split_keeps_rates_and_ratios(spark):
    d = spark.range(200_000).select("id", (F.pmod(F.xxhash64("id"), F.lit(100)) < 27).cast("int").alias("churn"))
    s = S.stratified_split(d, "id", "churn", mode="approx").persist()
    n = {r.split: (r["n"], r.positive_rate) for r in S.split_stats(s, "churn").collect()}
    rate = d.agg(F.avg("churn")).first()[0]
    for split, share in (("train", 0.64), ("val", 0.16), ("test", 0.20)):
        assert abs(n[split][0] / 200_000 - share) < 0.005 and abs(n[split][1] - rate) < 0.02
    assert sum(x[0] for x in n.values()) == 200_000
    again = S.stratified_split(d.repartition(17).where("id % 2 = 0"), "id", "churn", mode="approx")
    assert again.join(s.withColumnRenamed("split", "was"), "id").where("split <> was").count() == 0
    assert "Exchange" not in S.hash_split(d, "id")._jdf.queryExecution().executedPlan().toString()
    s.unpersist()


def test_approximate_split_on_a_stream(spark, tmp_dir):
    d = spark.range(500).select("id", F.lit(1).alias("churn"))
    d.repartition(5).write.parquet(f"{tmp_dir}/in")
    q = S.hash_split(spark.readStream.schema(d.schema).option("maxFilesPerTrigger", 2).parquet(f"{tmp_dir}/in"), "id") \
        .writeStream.format("parquet").option("checkpointLocation", f"{tmp_dir}/state").trigger(availableNow=True) \
        .start(f"{tmp_dir}/out")
    q.awaitTermination()
    got = {r.id: r.split for r in spark.read.parquet(f"{tmp_dir}/out").collect()}
    assert got == {r.id: r.split for r in S.stratified_split(d, "id", "churn", mode="approx").collect()}


def test_approximate_split_refuses(spark):
    d = spark.createDataFrame([(1, 0), (None, 1)], "id long, churn int")
    with pytest.raises(Exception, match="NULL"):
        S.hash_split(d, "id").collect()
    with pytest.raises(ValueError, match="mode"):
        S.stratified_split(d, "id", "churn", mode="fast")
    with pytest.raises(ValueError, match="test_size"):
        S.hash_split(d, "id", test_size=1.0)
    with pytest.raises(KeyError):
        S.stratified_split(d, "id", "nothing", mode="approx")
    assert S.hash_split(d.limit(0), "id").collect() == []

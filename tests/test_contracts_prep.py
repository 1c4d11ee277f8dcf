import numpy as np
import pandas as pd
import pytest

from tabwatch.functions.columns import bucketize
from tabwatch.operators import contracts as C
from tabwatch.operators import prep as P
from tabwatch.sources import telco as T
from tests.conftest import telco_rows


def raw(spark, pdf):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(pdf.astype({"TotalCharges": str}))
    return df.withColumn("TotalCharges", F.when(F.col("TotalCharges") == "nan", " ")
                         .otherwise(F.col("TotalCharges")))


def summary(df, contract):
    return {r.rule: r.n_violations for r in C.violation_summary(df, contract).collect()}


def test_clean_table_passes(spark):
    df = raw(spark, telco_rows())
    assert all(v == 0 for v in summary(df, T.RAW_CONTRACT).values())
    out = C.validate(df, T.RAW_CONTRACT)
    assert dict(out.dtypes)["tenure"] == "int" and dict(out.dtypes)["TotalCharges"] == "double"


def test_every_violation_reported(spark):
    pdf = telco_rows(50)
    pdf.loc[0, "gender"] = "Other"
    pdf.loc[1, "tenure"] = -3
    pdf.loc[2, "customerID"] = pdf.loc[3, "customerID"]
    pdf.loc[4, "MonthlyCharges"] = 0.0
    s = summary(raw(spark, pdf), T.RAW_CONTRACT)
    assert s["gender:isin"] == 1 and s["tenure:ge"] == 1 and s["customerID:unique"] == 2
    assert s["MonthlyCharges:gt"] == 1
    with pytest.raises(C.ContractError) as e:
        C.validate(raw(spark, pdf), T.RAW_CONTRACT)
    assert len(e.value.problems) == 4
    detail = C.violation_table(raw(spark, pdf), T.RAW_CONTRACT).collect()
    assert {(r.customerID, r.rule) for r in detail} >= {("C00000", "gender:isin"),
                                                        ("C00001", "tenure:ge")}


def test_schema_strictness(spark):
    df = spark.createDataFrame(telco_rows(5).drop(columns=["Churn"]).assign(extra=1))
    problems = C.schema_problems(df.schema, T.RAW_CONTRACT)
    assert "missing column Churn" in problems and "unknown column extra" in problems
    with pytest.raises(C.ContractError):
        C.check_schema(spark.createDataFrame(telco_rows(5)), T.PROCESSED_CONTRACT)


def test_blank_total_is_missing_then_zero(spark, tmp_dir):
    pdf = telco_rows(20)
    pdf["TotalCharges"] = pdf["TotalCharges"].astype(str)
    pdf.loc[0, "TotalCharges"] = " "
    pdf.loc[0, "tenure"] = 0
    path = f"{tmp_dir}/raw.csv"
    pdf.to_csv(path, index=False)
    df = T.load_raw(spark, path)
    assert df.where("customerID = 'C00000'").first().TotalCharges is None
    assert summary(df, T.RAW_CONTRACT)["TotalCharges:ge"] == 0
    out = T.preprocess(df)
    assert "customerID" not in out.columns and "Churn" not in out.columns
    r = out.where("tenure = 0").first()
    assert r.TotalCharges == 0.0 and dict(out.dtypes)["churn"] == "int"
    C.check_schema(out.withColumn("TotalCharges", out.TotalCharges), T.PROCESSED_CONTRACT)


def test_scoring_contract_is_wider(spark):
    pdf = telco_rows(10).drop(columns=["customerID", "Churn"])
    pdf.loc[0, "tenure"] = 90
    pdf.loc[1, "MonthlyCharges"] = 250.0
    df = spark.createDataFrame(pdf).withColumn("extra", __import__("pyspark.sql.functions",
                                                                    fromlist=["lit"]).lit(1))
    good, bad = C.split_valid(df, T.SCORING_CONTRACT)
    assert good.count() == 9
    assert [r._violations for r in bad.collect()] == [["MonthlyCharges:le"]]


def test_bucketizer_known_vectors(spark):
    xs = [0, 5, 11, 12, 18, 23, 24, 36, 47, 48, 60, 72]
    df = spark.createDataFrame([(x,) for x in xs], "t int")
    assert [r.b for r in df.select(bucketize("t").alias("b")).collect()] == \
        [0, 0, 0, 1, 1, 1, 2, 2, 2, 3, 3, 3]
    df2 = spark.createDataFrame([(x,) for x in [0, 5, 6, 23, 24, 71]], "t int")
    assert [r.b for r in df2.select(bucketize("t", (6, 24)).alias("b")).collect()] == \
        [0, 0, 1, 1, 2, 2]


def test_resample_deterministic_and_weighted(spark):
    df = spark.range(20000).withColumn("c", __import__("pyspark.sql.functions",
                                                       fromlist=["lit"]).lit("x"))
    vals, probs = ["a", "b", "c"], [0.85, 0.10, 0.05]
    a = P.weighted_resample(df, "c", vals, probs, 0, "id")
    b = P.weighted_resample(df.repartition(7), "c", vals, probs, 0, "id")
    ca = {r.c: r["count"] for r in a.groupBy("c").count().collect()}
    cb = {r.c: r["count"] for r in b.groupBy("c").count().collect()}
    assert ca == cb
    assert abs(ca["a"] / 20000 - 0.85) < 0.01 and abs(ca["c"] / 20000 - 0.05) < 0.01
    assert df.first().c == "x"


def test_inject_and_swap(spark):
    df = spark.createDataFrame(telco_rows(50))
    out = P.inject_drift(df, "MonthlyCharges", 1.25, {"Contract": (list(T.CONTRACT), [.85, .10, .05])},
                         0, "customerID")
    before = df.select("customerID", "MonthlyCharges").toPandas().set_index("customerID")
    after = out.select("customerID", "MonthlyCharges").toPandas().set_index("customerID")
    assert np.allclose(after.MonthlyCharges, before.MonthlyCharges * 1.25)
    sw = P.swap_category(df, "gender", "Female", "Male").select("gender").toPandas().gender
    assert (sw.values != df.select("gender").toPandas().gender.values).all()


def test_unique_marks_against_brute_force(spark):
    """Small bitmaps let many clean rows through; marks stay exact. NULL keys never count."""
    import random
    from collections import Counter

    r = random.Random(3)
    rows = [(r.choice([None, *range(4000)]), r.choice(["a", "b", None]), r.randrange(900), i) for i in range(3000)]
    rows += [(7, "hot", i, 3000 + i) for i in range(1500)]
    df = spark.createDataFrame(rows, "k long, t string, u int, id long")
    contract = C.Contract("c", tuple(C.ColumnSpec(n, t, unique=n == "u", nullable=True) for n, t in
                                     (("k", "bigint"), ("t", "string"), ("u", "int"), ("id", "bigint"))),
                          key=("id",), unique=(("k", "t"),))
    us, kt = Counter(x[2] for x in rows), Counter(x[:2] for x in rows if None not in x[:2])
    want = {x[3]: [n for n, bad in (("u:unique", us[x[2]] > 1), ("k,t:unique", kt.get(x[:2], 0) > 1)) if bad] for x in rows}
    for bits in (1 << 15, C.BITMAP_BITS):
        out = C.with_violations(df, contract, bitmap_bits=bits)
        assert out.columns == ["k", "t", "u", "id", "_violations"]
        got = out.collect()
        assert len(got) == len(rows) and {x.id: list(x["_violations"]) for x in got} == want
    assert C.with_violations(df.limit(0), contract).count() == 0
    with pytest.raises(ValueError):
        C.with_violations(df, contract, bitmap_bits=100)


def test_unique_marks_move_suspicious_rows_only(spark):
    """Unlike keys, clean rows are in no shuffle: what is written is the keys and a few rows."""
    df = spark.range(20000).selectExpr("if(id < 20, 1, id) AS k", "repeat(cast(id AS string), 50) AS payload")
    contract = C.Contract("c", (C.ColumnSpec("k", "bigint", unique=True), C.ColumnSpec("payload", "string")), key=("k",))
    keys = [r.k for r in C._suspicious(df, ["k"], C._repeated(df, ["k"], "d"), 0, C.BITMAP_BITS).where("_sus_0").collect()]
    assert keys.count(1) == 20 and len(keys) < 60
    assert C.with_violations(df, contract).where("size(_violations) > 0").count() == 20

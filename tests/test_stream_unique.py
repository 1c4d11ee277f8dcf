"""Uniqueness on streams: repeats across micro-batches and restarts, rows unchanged."""

from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabwatch.operators import contracts as C
from tabwatch.operators import models as M
from tabwatch.streaming import jobs as J
from tabwatch.streaming import sinks as K
from tabwatch.streaming import unique as U

BIG = 2 ** 53 + 1


def drain(frame, out, ck):
    q = frame.writeStream.format("parquet").option("checkpointLocation", ck).trigger(availableNow=True).start(out)
    assert q.awaitTermination(60)
    assert q.exception() is None


def test_marks_and_values(spark, tmp_dir):
    make = ("if(id % 10 = 3, NULL, id % 40 + {big}) AS id", "id AS row", "if(id % 7 = 0, NULL, id) AS k",
            "if(id % 3 = 0, double('NaN'), id / 7) AS d", "cast(id / 3 AS decimal(20, 9)) AS c",
            "timestamp_micros(id * 1000003) AS t", "timestamp'2020-01-01' AS `a.b`",
            "cast(cast(id AS string) AS binary) AS b", "if(id % 2 = 0, NULL, array(named_struct('u', id, 'v', NULL))) AS n",
            "if(id % 4 = 0, '', 'ü\\n\"') AS s")
    df = spark.range(300).selectExpr(*[m.format(big=BIG) for m in make])
    src = f"{tmp_dir}/in"
    df.where("row < 200").repartition(4).write.parquet(src)
    stream = lambda: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    drain(U.mark_repeats(stream(), ["id"], "again", "1 day"), f"{tmp_dir}/out", f"{tmp_dir}/ck")
    df.where("row >= 200").repartition(2).write.mode("append").parquet(src)
    drain(U.mark_repeats(stream(), ["id"], "again", "1 day"), f"{tmp_dir}/out", f"{tmp_dir}/ck")  # goes on
    got = spark.read.parquet(f"{tmp_dir}/out")
    assert got.columns == [*df.columns, "again"] and got.count() == 300
    text = lambda x: x.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j"))
    assert Counter(r.j for r in text(got.drop("again")).collect()) == Counter(r.j for r in text(df).collect())
    first = Counter(r.id for r in got.where("NOT again").collect())
    assert first[None] == 30 and all(n == 1 for k, n in first.items() if k is not None) and len(first) == 37


class State:
    def __init__(self):
        self.exists = self.hasTimedOut = False

    def update(self, _):
        self.exists = True

    def remove(self):
        self.exists = False

    def setTimeoutTimestamp(self, ms):
        self.ms = ms


def test_state_expires():
    state = State()
    part = pd.DataFrame({"ms": [5000, 5000], "row": [["a"], ["b"]]})
    run = lambda g: [x for p in U._mark(g, iter([part, part.iloc[:0], part]), state) for x in p["repeated"]]
    assert run(("1", None)) == [False, True, True, True] and state.ms == 5000
    assert run(("1", None)) == [True] * 4
    state.hasTimedOut = True
    assert run(("1", None)) == [] and not state.exists
    state.hasTimedOut = False
    assert run(("1", None)) == [False, True, True, True]
    assert not any(run((None, 3)))


class Same:
    def transform(self, df):
        return df


def test_repeated_keys_are_quarantined(spark, tmp_dir):
    contract = C.Contract("c", (C.ColumnSpec("id", "bigint", True, unique=True), C.ColumnSpec("x", "double", ge=0.0)), key=("id",))
    model = M.LinearModel("linear", None, {}, 0.5, 0.1, {"x": 0.5})
    for lo in (0, 10):
        spark.range(lo, lo + 20, 1, 1).select("id", (F.col("id") - 1).cast("double").alias("x")) \
            .write.mode("append").parquet(f"{tmp_dir}/in")
    stream = spark.readStream.schema("id long, x double").option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/in")
    args = (contract, lambda d: d, Same(), model, ["id"], f"{tmp_dir}/ok", f"{tmp_dir}/bad")
    with pytest.raises(ValueError, match="unique_within"):
        J.score_stream(stream, *args, checkpoint=f"{tmp_dir}/ck")
    q = J.score_stream(stream, *args, checkpoint=f"{tmp_dir}/ck", unique_within="7 days")
    assert q.awaitTermination(60) and q.exception() is None
    ok = sorted(r.id for r in K.read_finished(spark, f"{tmp_dir}/ok").collect())
    bad = {(r.id, r.violations) for r in K.read_finished(spark, f"{tmp_dir}/bad").collect()}
    assert ok == list(range(1, 30))
    assert bad == {(0, "x:ge")} | {(k, "id:unique") for k in range(10, 20)}

"""Streams across restarts: every row once, folders owned by one stream, NULL categories."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tabwatch.streaming import baseline as SB
from tabwatch.streaming import jobs as J
from tabwatch.streaming import sinks as K

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

# one application of its own: scores what lies in the source, and may die in the middle of a batch
APP = """
import os, sys
sys.path.insert(0, {repo!r})
from pyspark.sql import functions as F
from tabwatch.operators import contracts as C
from tabwatch.operators import models as M
from tabwatch.session import get_session
from tabwatch.streaming import jobs as J
from tabwatch.streaming import sinks as K

top, die_at = {top!r}, {die_at!r}
spark = get_session("local[2]", 4)
model = M.LinearModel("linear", None, {{}}, 0.5, 0.1, {{"x": 0.5}})


class Same:
    def transform(self, df):
        return df


if die_at is not None:
    kept = K.StreamSink.finish

    def finish(self, batch_id):  # both folders are written, the manifest is not
        if batch_id == die_at:
            os._exit(7)
        kept(self, batch_id)
    K.StreamSink.finish = finish
contract = C.Contract("c", (C.ColumnSpec("id", "bigint", True), C.ColumnSpec("x", "double", ge=0.0)))
stream = spark.readStream.schema("id long, x double").option("maxFilesPerTrigger", 1).parquet(top + "/in")
q = J.score_stream(stream, contract, lambda d: d, Same(), model, ["id"], top + "/ok", top + "/bad", top + "/ck")
q.awaitTermination(100)
if q.exception():
    raise q.exception()
print("batches", K.finished_batches(spark, top + "/ok"))
os._exit(0)
"""


def run_app(top, die_at=None):
    code = APP.format(repo=REPO, top=top, die_at=die_at)
    return subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=200)


def add_rows(spark, top, lo, hi):
    spark.range(lo, hi, 1, 1).select("id", (F.col("id") % 10 - 1).cast("double").alias("x")) \
        .write.mode("append").parquet(f"{top}/in")


def test_every_row_once_after_a_crash_and_restarts(spark, tmp_dir):
    for k in range(3):
        add_rows(spark, tmp_dir, 100 * k, 100 * k + 100)
    died = run_app(tmp_dir, die_at=1)
    assert died.returncode == 7, died.stderr[-2000:]
    assert K.finished_batches(spark, f"{tmp_dir}/ok") == [0]
    assert K.read_finished(spark, f"{tmp_dir}/ok").where("batch_id <> 0").count() == 0  # batch 1 is there, unfinished
    add_rows(spark, tmp_dir, 300, 400)
    again = run_app(tmp_dir)  # a new application
    assert again.returncode == 0, again.stderr[-2000:]
    assert "batches [0, 1, 2, 3]" in again.stdout
    more = run_app(tmp_dir)   # nothing new
    assert more.returncode == 0 and "batches [0, 1, 2, 3]" in more.stdout
    ok, bad = (K.read_finished(spark, f"{tmp_dir}/{p}") for p in ("ok", "bad"))
    assert sorted(r.id for r in ok.collect()) == [i for i in range(400) if i % 10]
    assert sorted(r.id for r in bad.collect()) == [i for i in range(400) if not i % 10]
    assert spark.read.parquet(f"{tmp_dir}/ok").count() == 360  # the manifest is no data


def rows_of(spark, path, n=10):
    spark.range(n).select("id", F.lit(1.0).alias("x")).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema("id long, x double").parquet(path)


def pass_on(stream, sink, checkpoint):
    q = stream.writeStream.foreachBatch(sink.writer(lambda b: {"out": b})) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination(100)
    return q


def test_a_folder_belongs_to_one_stream(spark, tmp_dir):
    stream = rows_of(spark, f"{tmp_dir}/in")
    assert K.read_finished(spark, f"{tmp_dir}/out") is None
    pass_on(stream, K.StreamSink(spark, {"out": f"{tmp_dir}/out"}), f"{tmp_dir}/ck")
    with pytest.raises(Exception, match="belongs to stream"):
        pass_on(stream, K.StreamSink(spark, {"out": f"{tmp_dir}/out"}), f"{tmp_dir}/other")
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 10
    spark.range(3).write.parquet(f"{tmp_dir}/old/batch_id=0")
    with pytest.raises(Exception, match="without a manifest"):
        pass_on(stream, K.StreamSink(spark, {"out": f"{tmp_dir}/old"}), f"{tmp_dir}/third")


def test_a_finished_batch_is_not_written_again(spark, tmp_dir):
    sink = K.StreamSink(spark, {"out": f"{tmp_dir}/out"})
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "me")
    try:
        write = sink.writer(lambda b: {"out": b})
        write(spark.range(5), 0)
        write(spark.range(9), 0)
        assert spark.read.parquet(f"{tmp_dir}/out").count() == 5
        write(spark.range(0), 1)  # an empty batch is finished too
        assert K.finished_batches(spark, f"{tmp_dir}/out") == [0, 1]
        sink.folders["out"].fs.delete(sink.folders["out"]._of(f"{tmp_dir}/out/{K.MANIFEST}/1"), False)
        write(spark.range(4), 1)  # unfinished: replaces what is there
        assert spark.read.parquet(f"{tmp_dir}/out").where("batch_id = 1").count() == 4
        assert json.loads(sink.folders["out"].read(f"{K.MANIFEST}/1")) == {"batch_id": 1}
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)


def test_no_checkpoint_no_stream(spark, tmp_dir):
    stream = rows_of(spark, f"{tmp_dir}/in")
    base = SB.fit_baseline(spark.range(10).select(F.col("id").alias("x")), ["x"], [])
    for start in (lambda c: J.score_stream(stream, None, None, None, None, ["id"], f"{tmp_dir}/a", f"{tmp_dir}/b", c),
                  lambda c: J.drift_stream(stream, base, "ts", f"{tmp_dir}/c", checkpoint=c)):
        for missing in (None, ""):
            with pytest.raises(ValueError, match="checkpoint"):
                start(missing)


def test_null_category_is_not_the_word_null(spark):
    from tabwatch.operators import drift
    rows = [("NULL",)] * 6 + [(None,)] * 2 + [("a",)] * 4 + [("=a",)] * 3
    now = [("NULL",)] * 2 + [(None,)] * 7 + [("a",)] * 5 + [("=a",)]
    base, cur = (spark.createDataFrame(r, "kind string") for r in (rows, now))
    b = SB.fit_baseline(base, [], ["kind"])
    assert b.props.count() == 4
    counts = SB.binned(cur, b).groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"))
    got = SB.psi_from_counts(counts, b, []).first().psi
    want = drift.psi_categorical(base, cur, ["kind"]).first().psi
    assert abs(got - want) < 1e-12

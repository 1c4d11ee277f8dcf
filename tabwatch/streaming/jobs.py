"""Structured Streaming jobs: scoring (J2) and windowed drift.

Sinks are folders of ``streaming.sinks``: owned by one stream, each micro-batch written once, also
when a stream goes on in a new application. The checkpoint location is the stream's identity, so
it has no default; give a folder on shared storage and keep it as long as the sinks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabwatch.operators.contracts import VIOLATIONS, Contract
from tabwatch.operators.models import FittedModel
from tabwatch.streaming.baseline import Baseline, binned, psi_from_counts
from tabwatch.streaming.sinks import StreamSink
from tabwatch.streaming.unique import stream_violations


def _checkpoint(given: str | None) -> str:
    if not given:
        raise ValueError("a stream needs a checkpoint folder of its own, kept across restarts")
    return given


def score_stream(stream: DataFrame, contract: Contract, prep: Callable[[DataFrame], DataFrame],
                 features: PipelineModel, model: FittedModel, key: Sequence[str],
                 valid_path: str, quarantine_path: str, checkpoint: str | None = None,
                 trigger: dict | None = None, unique_within: str | None = None) -> StreamingQuery:
    """Contract check, shared preprocessing and the fitted pipeline on every row of the
    stream; valid rows -> scores sink, others -> quarantine sink. Stateless but for unique keys: a row
    whose key came before, in any micro-batch of the last ``unique_within``, is quarantined.
    ``checkpoint`` must be given; with the same one a new application goes on where the last one stopped."""
    at = _checkpoint(checkpoint)
    flagged = stream_violations(stream, contract, unique_within)

    def outputs(batch: DataFrame) -> dict[str, DataFrame]:
        good = batch.where(F.size(VIOLATIONS) == 0).drop(VIOLATIONS)
        scored = model.score(features.transform(prep(good)), keep=list(key))
        return {"valid": scored.select(*key, F.col("score").alias("probability"), "prediction",
                                       F.lit(model.threshold).alias("threshold")),
                "quarantine": batch.where(F.size(VIOLATIONS) > 0).select(
                    *key, F.concat_ws(",", VIOLATIONS).alias("violations"))}

    sink = StreamSink(stream.sparkSession, {"valid": valid_path, "quarantine": quarantine_path})
    w = flagged.writeStream.foreachBatch(sink.writer(outputs)).option("checkpointLocation", at)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def drift_stream(stream: DataFrame, baseline: Baseline, ts_col: str, out_path: str,
                 window: str = "1 day", watermark: str = "1 day",
                 checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Counts per (window, feature, bin) with a watermark (state = open windows x
    features x bins), emitted once a window closes (append); PSI per closed window against
    the frozen baseline in ``foreachBatch``. Rows older than the previous batch's watermark
    are dropped; a window already emitted never changes. ``checkpoint`` must be given."""
    at = _checkpoint(checkpoint)
    cols = [*baseline.numeric, *baseline.categorical]
    # Watermarks need TIMESTAMP event time; a TIMESTAMP_NTZ column is cast (wall clock read
    # in the session time zone, UTC by default here) and window starts are cast back.
    ntz = dict(stream.dtypes).get(ts_col) == "timestamp_ntz"
    ev = stream.select(F.col(ts_col).cast("timestamp").alias(ts_col), *cols)
    counts = (
        binned(ev.withWatermark(ts_col, watermark), baseline, [ts_col])
        .groupBy(F.window(ts_col, window).alias("w"), "feature", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
        .select((F.col("w.start").cast("timestamp_ntz") if ntz else F.col("w.start"))
                .alias("window_start"), "feature", "bin", "n")
    )

    sink = StreamSink(stream.sparkSession, {"psi": out_path})
    write = sink.writer(lambda batch: {"psi": psi_from_counts(batch, baseline, ["window_start"])})
    w = counts.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", at)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()

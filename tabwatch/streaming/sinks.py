"""Folders that a stream writes once and only once, also across restarts.

Each micro-batch is a folder ``batch_id=<n>``. A manifest in ``_manifest`` (which Spark's readers
skip) names the stream that owns the folder, by the id that Spark keeps in the stream's
checkpoint, and the batches that are finished in all folders of the stream. A batch that comes
again after a failure is left out if it is finished and replaces its own output if not; a stream
with another checkpoint is refused, since it would number its batches from 0 and mix them with
those that are there."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MANIFEST = "_manifest"


class Folder:
    """Small files of a folder on whatever store Spark's Hadoop layer reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.path = path.rstrip("/")
        self.fs = self._of(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _of(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, sub: str = "") -> list[str]:
        at = self._of(f"{self.path}/{sub}" if sub else self.path)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, name: str) -> str | None:
        at = self._of(f"{self.path}/{name}")
        if not self.fs.exists(at):
            return None
        stream = self.fs.open(at)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Whole or not at all: written beside its place and renamed."""
        part, at = self._of(f"{self.path}/{MANIFEST}/.{name.rsplit('/', 1)[-1]}.part"), self._of(f"{self.path}/{name}")
        out = self.fs.create(part, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.fs.delete(at, False)
        if not self.fs.rename(part, at):
            raise OSError(f"{at.toString()} can't be written")


class StreamSink:
    """The folders of one stream, by name."""

    def __init__(self, spark: SparkSession, paths: dict[str, str]):
        self.folders = {k: Folder(spark, p) for k, p in paths.items()}

    def claim(self, stream_id: str) -> None:
        """Make the folders this stream's. Raises if one belongs to another stream, or holds
        batches of no known one."""
        for f in self.folders.values():
            owner = f.read(f"{MANIFEST}/owner")
            if owner is None:
                if any(n.startswith("batch_id=") for n in f.names()):
                    raise ValueError(f"{f.path} holds batches without a manifest")
                f.write(f"{MANIFEST}/owner", stream_id)
            elif owner != stream_id:
                raise ValueError(f"{f.path} belongs to stream {owner}; this one is {stream_id}. Go on with that "
                                 "stream's checkpoint, or give another folder")

    def finished(self, batch_id: int) -> bool:
        return all(f.read(f"{MANIFEST}/{batch_id}") is not None for f in self.folders.values())

    def finish(self, batch_id: int) -> None:
        for f in self.folders.values():
            f.write(f"{MANIFEST}/{batch_id}", json.dumps({"batch_id": batch_id}))

    def writer(self, outputs: Callable[[DataFrame], dict[str, DataFrame]]) -> Callable[[DataFrame, int], None]:
        """A function for ``foreachBatch``: ``outputs`` gives the frame of each folder."""
        claimed: list[str] = []

        def write(batch: DataFrame, batch_id: int) -> None:
            stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
            if claimed != [stream_id]:
                self.claim(stream_id)
                claimed[:] = [stream_id]
            if self.finished(batch_id):
                return
            batch = batch.persist()
            try:
                for name, frame in outputs(batch).items():
                    frame.write.mode("overwrite").parquet(f"{self.folders[name].path}/batch_id={batch_id}")
                self.finish(batch_id)
            finally:
                batch.unpersist()
        return write


def finished_batches(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n) for n in Folder(spark, path).names(MANIFEST) if n.isdigit())


def read_finished(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows of the finished batches, with their batch_id; what an interrupted batch has left is not
    read. None before the first batch."""
    path = path.rstrip("/")
    parts = [f"{path}/batch_id={n}" for n in finished_batches(spark, path)]
    return spark.read.option("basePath", path).parquet(*parts) if parts else None

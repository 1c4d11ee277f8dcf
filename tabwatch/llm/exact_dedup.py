"""Exact deduplication by Grace hash partitioning.

Records are combined once in each scan task, then partitioned by the hash of their text. A
task fills one open-addressing table that compares complete texts. When the table outgrows
its memory bound, whole sub-buckets of the next four hash bits leave it and are written as
spill rows in the shared folder; the next level partitions only those, by four further bits.
The recursion ends when nothing is spilled. Copies of one text are one table entry, already
combined before the shuffle, so a hot text costs one row per scan task."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwatch.llm.common import packed, shared_dir, stored, text_or_empty, unpacked

TABLE_BYTES = 64 << 20  # texts held by one table before sub-buckets leave it
LEVELS = 16             # 16 levels x 4 bits = the 64 hash bits
ENTRY_BYTES = 200       # bookkeeping of one entry, next to its text
BATCH_BYTES = 4 << 20

RECORD = "h long, sha string, text string, max_id long, n long, n_max long"
LEVEL_OUT = "resolved boolean, " + RECORD


class OpenTable:
    """Open addressing with linear probing; a slot holds an entry number. An entry matches
    only if hash and complete text are equal."""

    def __init__(self, n_slots: int = 1 << 10):
        self.slots = [-1] * n_slots
        self.entries: list[list] = []  # [h, sha, text, max_id, n, n_max]
        self.bytes = 0

    def _grow(self) -> None:
        n = len(self.slots) * 2
        self.slots = [-1] * n
        for k, e in enumerate(self.entries):
            i = e[0] & (n - 1)
            while self.slots[i] >= 0:
                i = (i + 1) & (n - 1)
            self.slots[i] = k

    def add(self, h, sha, text, max_id, n, n_max) -> None:
        mask = len(self.slots) - 1
        i = h & mask
        while (k := self.slots[i]) >= 0:
            e = self.entries[k]
            if e[0] == h and e[2] == text:
                e[4] += n
                if e[3] == max_id:
                    e[5] += n_max
                elif e[3] is None or (max_id is not None and max_id > e[3]):
                    e[3], e[5] = max_id, n_max
                return
            i = (i + 1) & mask
        self.slots[i] = len(self.entries)
        self.entries.append([h, sha, text, max_id, n, n_max])
        self.bytes += len(text) + ENTRY_BYTES
        if 2 * len(self.entries) > len(self.slots):
            self._grow()

    def take(self, pick) -> list[list]:
        """Remove and return the entries for which ``pick(h)`` holds."""
        out = [e for e in self.entries if pick(e[0])]
        self.entries = [e for e in self.entries if not pick(e[0])]
        self.bytes = sum(len(e[2]) + ENTRY_BYTES for e in self.entries)
        self.slots = [-1] * max(1 << 10, 1 << (2 * len(self.entries)).bit_length())
        mask = len(self.slots) - 1
        for k, e in enumerate(self.entries):
            i = e[0] & mask
            while self.slots[i] >= 0:
                i = (i + 1) & mask
            self.slots[i] = k
        return out


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns)))


def _batches(entries: list[list], resolved: bool | None) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most about BATCH_BYTES of text; resolved entries drop the text."""
    part, size = [], 0
    for e in entries:
        part.append(e)
        size += ENTRY_BYTES + (0 if resolved else len(e[2]))
        if size >= BATCH_BYTES:
            yield _batch(part, resolved)
            part, size = [], 0
    if part:
        yield _batch(part, resolved)


def _batch(part: list[list], resolved: bool | None) -> pa.RecordBatch:
    h, sha, text, max_id, n, n_max = map(list, zip(*part))
    cols = [pa.array(h, pa.int64()), pa.array(sha, pa.string()),
            pa.array([None] * len(part) if resolved else text, pa.string()),
            pa.array(max_id, pa.int64()), pa.array(n, pa.int64()), pa.array(n_max, pa.int64())]
    names = ["h", "sha", "text", "max_id", "n", "n_max"]
    if resolved is not None:
        cols, names = [pa.array([resolved] * len(part)), *cols], ["resolved", *names]
    return pa.RecordBatch.from_arrays(cols, names)


def _combine(limit: int):
    """Scan side: equal texts of one task become one record (a full table is passed on and
    begun anew, so memory is bounded and nothing is lost)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = OpenTable()
        for b in batches:
            for h, sha, text, i in _rows(b):
                table.add(h, sha, text, i, 1, 1)
                if table.bytes > limit:
                    yield from _batches(table.entries, None)
                    table = OpenTable()
        yield from _batches(table.entries, None)
    return run


def _grace(level: int, limit: int):
    """One level: fill the table; evict sub-buckets (four hash bits) while it is too large."""
    shift = 4 * level

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, gone = OpenTable(), set()
        sub = lambda h: (h >> shift) & 15
        spilled: list[list] = []
        size = 0
        for b in batches:
            for h, sha, text, max_id, n, n_max in _rows(b):
                if sub(h) in gone:
                    spilled.append([h, sha, text, max_id, n, n_max])
                    size += len(text)
                else:
                    table.add(h, sha, text, max_id, n, n_max)
                    while table.bytes > limit and level < LEVELS and len(table.entries) > 1:
                        by: dict[int, int] = {}
                        for e in table.entries:
                            by[sub(e[0])] = by.get(sub(e[0]), 0) + len(e[2])
                        out = max(by, key=lambda k: (by[k], k))
                        gone.add(out)
                        yield from _batches(table.take(lambda x: sub(x) == out), False)
                if size >= BATCH_BYTES:
                    yield from _batches(spilled, False)
                    spilled, size = [], 0
        yield from _batches(spilled, False)
        yield from _batches(table.entries, True)
    return run


def text_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per different text: text_sha256, keep_id, group_size, n_keep.

    keep_id is the largest id among equal texts (null only if all their ids are null), n_keep
    the number of rows that bear it. A null text counts as empty. Returns a stored table."""
    spark = docs.sparkSession
    folder = shared_dir(spark)
    text = text_or_empty(text_col)
    rec = docs.select(F.xxhash64(text).alias("h"), F.sha2(text, 256).alias("sha"),
                      text.alias("text"), F.col(id_col).cast("long").alias("max_id"))
    rec = rec.mapInArrow(_combine(table_bytes), RECORD)
    done: list[DataFrame] = []
    for level in range(LEVELS + 1):
        out = stored(rec.repartition(F.col("h"), F.lit(level))
                     .mapInArrow(_grace(level, table_bytes), LEVEL_OUT), f"{folder}/level{level}")
        done.append(out.where("resolved"))
        rec = out.where("NOT resolved").drop("resolved")
        if rec.isEmpty():
            break
    classes = done[0]
    for d in done[1:]:
        classes = classes.unionByName(d)
    return classes.select(F.col("sha").alias("text_sha256"), F.col("max_id").alias("keep_id"),
                          F.col("n").alias("group_size"), F.col("n_max").alias("n_keep"))


def dedup_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id is kept; of rows equal in id and text exactly
    one is kept. Null text: empty. Null ids: smaller than any id. Empty table: no rows."""
    classes = text_classes(docs, id_col, text_col, table_bytes)
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.sha2(text_or_empty(text_col), 256).alias("text_sha256"))
            .groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("m")))
    j = rows.join(classes, "text_sha256")
    return j.select("doc_id", "keep_id", "group_size", "text_sha256",
                    F.explode(F.sequence(F.lit(1), F.col("m"))).alias("k")).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("k") == 1)).alias("kept"),
        "text_sha256")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The input rows that stay, with all their columns as they were."""
    classes = text_classes(docs, id_col, text_col, table_bytes)
    rows = packed(docs, id=F.col(id_col).cast("long"), sha=F.sha2(text_or_empty(text_col), 256))
    keep = classes.select("keep_id", "text_sha256")
    kept = rows.join(keep, F.col("id").eqNullSafe(F.col("keep_id"))
                     & (F.col("sha") == F.col("text_sha256")), "left_semi")
    if not classes.where("n_keep > 1").isEmpty():
        # rows equal in id and text: any one of them, chosen by the hash of the whole row
        w = Window.partitionBy("id", "sha").orderBy(F.xxhash64(F.to_json("row")))
        kept = kept.withColumn("k", F.row_number().over(w)).where("k = 1")
    return unpacked(kept)

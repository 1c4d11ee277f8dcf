"""Token-id shards with a minimal perfect hash index.

Texts are range-partitioned by document id; each task encodes its texts in id order into one
binary file: raw little-endian ids, then the keys, row lengths and a minimal perfect hash over
the distinct keys of the file. A slot holds a fingerprint of its key, the key's first row and
its offset in the payload, so a key is found with one hash, one seed and one slot. A small
manifest (one row per file, with its key range) leads to the file.

File names are new for every task attempt and the manifest, which Spark commits, names only
those of the attempts that ended well. Ids come from the tokenizers library; each worker keeps
those of pre-tokens it has met, since the encoding of a pre-token depends on nothing else."""

from __future__ import annotations

import functools
import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwatch.llm import pretokens as P
from tabwatch.llm.common import shared_dir, stored, text_or_empty

MAGIC = b"TWTOK001"
MAX_KEPT = 600_000     # pre-tokens whose ids a worker keeps; then it begins anew
READ_AHEAD = 8 << 20
BATCH = 1 << 21        # characters whose pre-tokens are looked up together
MASK = (1 << 64) - 1
NULL_HASH = (0x5DEECE66D1234567, 0x2545F4914F6CDD1D)  # hash and fingerprint of the null key

MANIFEST = "part int, file string, min_id long, max_id long, n_docs long, n_ids long"


class Encoder:
    """Whole texts to ids, as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, path: str):
        self.tokenizer, spec = P.load(path)
        self.special = P.specials(spec)
        self.classes = P.Classes(self.tokenizer)
        self.width = 2 if max(spec["model"]["vocab"].values(), default=0) < 1 << 16 \
            and max(self.special.values(), default=0) < 1 << 16 else 4
        self.to_char = {b: ord(c) for b, c in enumerate(P.byte_chars())}
        self.kept: dict[bytes, bytes] = {}

    def _learn(self, new: list[bytes]) -> None:
        tokenize, ids, ends = self.tokenizer.model.tokenize, [], [0]
        for w in new:
            ids += [t.id for t in tokenize(w.decode("latin-1").translate(self.to_char))]
            ends.append(len(ids) * self.width)
        flat = np.array(ids, f"<u{self.width}").tobytes()
        self.kept.update((w, flat[a:b]) for w, a, b in zip(new, ends, ends[1:]))

    def _ids(self, data: bytes, begin: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(ids of all pre-tokens, where those of each begin; the end last). Each distinct pre-token of
        the batch is looked up once."""
        if not len(begin):
            return b"", np.zeros(1, np.int64)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(begin), [
            None, pa.py_buffer(np.append(begin, len(data)).astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()
        _, at, flat = pieces.dictionary.buffers()
        edges, flat = np.frombuffer(at, np.int64, len(pieces.dictionary) + 1).tolist(), flat.to_pybytes()
        words = [flat[a:b] for a, b in zip(edges, edges[1:])]
        found = list(map(self.kept.get, words))
        if new := [w for w, x in zip(words, found) if x is None]:
            self._learn(new)
            found = list(map(self.kept.get, words))
        ids = pa.array(found, pa.large_binary()).take(pieces.indices)
        _, at, flat = ids.buffers()
        return flat.to_pybytes() if flat else b"", np.frombuffer(at, np.int64, len(ids) + 1)

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for _, part in P.small_batches(texts, BATCH):
            if len(self.kept) > MAX_KEPT:
                self.kept = {}
            segs, owner, marks = P.segments(part, self.special)
            data, begin, n_bytes = P.cut(segs, self.classes)
            ids, at = self._ids(data, begin)
            stop = at[np.searchsorted(begin, np.cumsum(n_bytes), "left")].tolist()
            whole = [ids[a:b] for a, b in zip([0, *stop], stop)]
            if len(whole) == len(part):
                out += whole
                continue
            after = {(k, n): np.array([i], f"<u{self.width}").tobytes() for k, n, i in marks}
            texts_of: list[list[bytes]] = [[] for _ in part]
            for n, (k, w) in enumerate(zip(owner, whole), 1):
                texts_of[k] += [w, after.get((k, n), b"")]
            out += [b"".join(x) for x in texts_of]
        return out


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _mix(x: int) -> int:
    x = (x + 0x9E3779B97F4A7C15) & MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def key_hash(key: int | None) -> tuple[int, int]:
    """(hash, fingerprint) of a document key."""
    if key is None:
        return NULL_HASH
    h = _mix(key & MASK)
    return h, _mix(h ^ 0xA0761D6478BD642F)


def _slot(h: int, seed: int, n: int) -> int:
    return _mix(h ^ (seed * 0xD6E8FEB86659FD93 & MASK)) % n


def build_mph(hashes: list[int]) -> list[int]:
    """Seeds of a minimal perfect hash over different hashes: hash and displace, large buckets
    first. A negative seed -1 - s names slot s itself (buckets of one key, placed last)."""
    n = len(hashes)
    buckets: list[list[int]] = [[] for _ in range(max(1, n // 4))]
    for h in hashes:
        buckets[h % len(buckets)].append(h)
    seeds, taken = [0] * len(buckets), bytearray(n)
    for b in sorted(range(len(buckets)), key=lambda b: -len(buckets[b])):
        if len(buckets[b]) < 2:
            break
        seed = 0
        while True:
            at = {_slot(h, seed, n) for h in buckets[b]}
            if len(at) == len(buckets[b]) and not any(taken[s] for s in at):
                break
            seed += 1
        seeds[b] = seed
        for s in at:
            taken[s] = 1
    free = (s for s in range(n) if not taken[s])
    for b, keys in enumerate(buckets):
        if len(keys) == 1:
            seeds[b] = -1 - next(free)
    return seeds


def find_slot(h: int, seeds, n: int) -> int:
    seed = int(seeds[h % len(seeds)])
    return -1 - seed if seed < 0 else _slot(h, seed, n)


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def _write_shard(folder: str, vocabulary: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc = encoder(vocabulary)
        dtype = f"<u{enc.width}"
        end = np.array([end_id], dtype).tobytes()
        filesystem, top = _filesystem(folder)
        name = f"{top}/shard-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.tok"
        keys: list[int | None] = []
        lengths: list[int] = []
        out = None
        for b in batches:
            if out is None:
                filesystem.create_dir(top, recursive=True)
                out = filesystem.open_output_stream(name)
                out.write(MAGIC)
            keys += b.column(0).to_pylist()
            for ids in enc.encode(b.column(1).to_pylist()):
                out.write(ids + end)
                lengths.append(len(ids) // enc.width + 1)
        if out is None:
            return
        _write_index(out, keys, lengths, enc.width)
        out.close()
        ids = [k for k in keys if k is not None]
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([name]),
             pa.array([min(ids, default=None)], pa.int64()), pa.array([max(ids, default=None)], pa.int64()),
             pa.array([len(keys)], pa.int64()), pa.array([sum(lengths)], pa.int64())],
            ["part", "file", "min_id", "max_id", "n_docs", "n_ids"])
    return run


def _write_index(out, keys: list[int | None], lengths: list[int], width: int) -> None:
    """Sections after the payload, then a JSON footer that tells where they are."""
    first: dict[int | None, tuple[int, int]] = {}
    at = 0
    for row, (k, n) in enumerate(zip(keys, lengths)):
        first.setdefault(k, (row, at))
        at += n
    hashes = {k: key_hash(k) for k in first}
    seeds = build_mph([h for h, _ in hashes.values()])
    slots = np.zeros(len(first), [("fp", "<u8"), ("row", "<i8"), ("at", "<i8")])
    for k, (h, fp) in hashes.items():
        slots[find_slot(h, seeds, len(first))] = (fp, *first[k])
    sections = {"keys": np.array([k or 0 for k in keys], "<i8").tobytes(),
                "nulls": np.array([k is None for k in keys], "u1").tobytes(),
                "lengths": np.array(lengths, "<i8").tobytes(),
                "seeds": np.array(seeds, "<i8").tobytes(), "slots": slots.tobytes()}
    foot: dict = {"width": width, "n_ids": at}
    place = len(MAGIC) + at * width
    for name, data in sections.items():
        foot[name] = [place, len(data)]
        place += len(data)
        out.write(data)
    foot_bytes = json.dumps(foot).encode()
    out.write(foot_bytes + np.array([len(foot_bytes)], "<u8").tobytes() + MAGIC)


class ShardReader:
    """Keyed access to one shard file."""

    def __init__(self, filesystem, name: str):
        self.file = filesystem.open_input_file(name)
        size = self.file.size()
        tail = self.file.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{name} is not a complete shard")
        n = int(np.frombuffer(tail[:8], "<u8")[0])
        foot = json.loads(self.file.read_at(n, size - 16 - n))
        self.width, self.n_ids = foot["width"], foot["n_ids"]
        part = lambda k, t: np.frombuffer(self.file.read_at(foot[k][1], foot[k][0]), t)
        self.keys, self.nulls, self.lengths = part("keys", "<i8"), part("nulls", "u1"), part("lengths", "<i8")
        self.seeds = part("seeds", "<i8")
        self.slots = part("slots", [("fp", "<u8"), ("row", "<i8"), ("at", "<i8")])
        self._at, self._buffer = 0, b""

    def _read(self, at: int, n: int) -> bytes:
        if not (self._at <= at and at + n <= self._at + len(self._buffer)):
            self._at, self._buffer = at, self.file.read_at(max(n, READ_AHEAD), at)
        return self._buffer[at - self._at:at - self._at + n]

    def lookup(self, key: int | None) -> list[tuple[int, np.ndarray]]:
        """(offset in ids, ids) of each row that bears the key; empty if there is none."""
        if not len(self.slots):
            return []
        h, fp = key_hash(key)
        slot = self.slots[find_slot(h, self.seeds, len(self.slots))]
        if int(slot["fp"]) != fp:
            return []
        out, row, at = [], int(slot["row"]), int(slot["at"])
        while row < len(self.keys) and (bool(self.nulls[row]) if key is None else
                                        not self.nulls[row] and int(self.keys[row]) == key):
            n = int(self.lengths[row])
            ids = self._read(len(MAGIC) + at * self.width, n * self.width)
            out.append((at, np.frombuffer(ids, f"<u{self.width}")))
            row, at = row + 1, at + n
        return out


def write_tokens(docs: DataFrame, folder: str, vocabulary: str, shards: int | None = None,
                 end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, append ``end_id`` and write the shards; returns the stored manifest.

    Files hold documents in ascending id order (null ids first; rows of one id by text), ids
    take 2 bytes where the vocabulary allows. Null text: empty, only the end id. ``shards``
    defaults to the session's shuffle partitions. Empty table: no files, an empty manifest."""
    spark = docs.sparkSession
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    t = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    t = t.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    return stored(t.mapInArrow(_write_shard(f"{folder}/shards", vocabulary, end_id), MANIFEST),
                  f"{folder}/manifest")


def _read_shard(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, _ = _filesystem(folder)
        for b in batches:
            for name, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                reader = ShardReader(filesystem, name)
                rows: list[tuple] = []
                keys = dict.fromkeys(None if null else k for k, null in
                                     zip(reader.keys.tolist(), reader.nulls.tolist()))
                for key in keys:
                    for at, ids in reader.lookup(key):
                        rows.append((key, base + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                for k in range(0, len(rows), 50_000):
                    ids_, start, n, crc = zip(*rows[k:k + 50_000])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids_, pa.int64()), pa.array(start, pa.int64()),
                         pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def read_digest(manifest: DataFrame, folder: str) -> DataFrame:
    """Read the shards back by key: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32, one row per document."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    m = manifest.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    n = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return m.repartition(n, "file").mapInArrow(
        _read_shard(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokens_digest(docs: DataFrame, vocabulary: str, **options) -> DataFrame:
    """Write the shards to a new shared folder and read them back. Cases as in ``write_tokens``; further
    columns are not read, whatever their names. Empty table: no rows."""
    folder = shared_dir(docs.sparkSession)
    return read_digest(write_tokens(docs, folder, vocabulary, **options), folder)

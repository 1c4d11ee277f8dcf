"""Centroid clustering on bit planes.

Vectors of 64 components become integers, and bit i of all components of a vector one 64-bit
word, its plane i, in two's complement. The dot product of two vectors is the sum over pairs of
planes of their weights times the number of ones in the AND of both words, exactly. Planes are
stored once; each round reads them, assigns in NumPy and brings back sums of a fixed size for
each centroid."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.llm.common import finished, shared_dir, stored

WIDTH = 64         # components of a vector, bits of a plane
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
SALT = "2:"
MOST_PLANES = 29   # components below 2 ** 28, so that squared distances fit in 64 bits
SLICE = 8192       # vectors held as arrays at once


def kept_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, v (64 integers floor(256 x)): the vectors of exactly 64 components, none null or
    non-finite."""
    v = F.col(vec_col).cast("array<double>")
    inf = F.lit(float("inf"))
    good = (F.size(v) == WIDTH) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    return vectors.where(F.coalesce(good, F.lit(False))) \
        .select(F.col(id_col).cast("long").alias("vec_id"),
                F.transform(v, lambda x: F.floor(x * SCALE)).alias("v"))


def plane_weights(n: int) -> np.ndarray:
    """Weight of each plane: powers of two, the sign's plane negative."""
    w = np.int64(1) << np.arange(n, dtype=np.int64)
    w[-1] = -w[-1]
    return w


def to_planes(v: np.ndarray, n: int) -> np.ndarray:
    """(rows, n) words of 64 bits from (rows, 64) integers."""
    out = np.empty((len(v), n), np.uint64)
    for i in range(n):
        bits = ((v >> i) & 1).astype(np.uint8)
        out[:, i] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def from_planes(planes: np.ndarray) -> np.ndarray:
    """(rows, 64) integers."""
    out = np.zeros((len(planes), WIDTH), np.int64)
    for i, w in enumerate(plane_weights(planes.shape[1])):
        word = np.ascontiguousarray(planes[:, i]).astype("<u8").view(np.uint8).reshape(-1, 8)
        out += np.unpackbits(word, axis=1, bitorder="little").astype(np.int64) * w
    return out


def dots(planes: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Dot products of all rows with one row of planes, by weighted popcounts of ANDs."""
    w, total = plane_weights(planes.shape[1]), np.zeros(len(planes), np.int64)
    for j in np.flatnonzero(other):
        ones = np.bitwise_count(planes & other[j]).astype(np.float64)  # sums below 2 ** 35: exact
        total += (ones @ w.astype(np.float64)).astype(np.int64) * w[j]
    return total


def squares(planes: np.ndarray) -> np.ndarray:
    """Squared length of each row, the same way."""
    w, total = plane_weights(planes.shape[1]), np.zeros(len(planes), np.int64)
    for i in range(len(w)):
        for j in range(i, len(w)):
            ones = np.bitwise_count(planes[:, i] & planes[:, j]).astype(np.int64)
            total += ones * (w[i] * w[j] * (1 if i == j else 2))
    return total


def nearest(planes: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance); of equal ones the smaller number."""
    own = squares(planes)
    best, least = np.zeros(len(planes), np.int32), None
    for c, (row, length) in enumerate(zip(centres, squares(centres))):
        d = own - 2 * dots(planes, row) + length
        if least is None:
            least = d
        else:
            closer = d < least
            best[closer], least[closer] = c, d[closer]
    return best, least


def _slices(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for b in batches:
        for k in range(0, b.num_rows, SLICE):
            part = b.slice(k, SLICE)
            words = b"".join(part.column(1).to_pylist())
            yield part.column(0), np.frombuffer(words, "<u8").reshape(-1, n)


def pack(kept: DataFrame, n: int) -> DataFrame:
    """vec_id, planes (n words of 8 bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, SLICE):
                part = b.slice(k, SLICE)
                v = part.column(1).flatten().to_numpy().reshape(-1, WIDTH)
                words = to_planes(v, n).astype("<u8")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([r.tobytes() for r in words], pa.binary())], ["vec_id", "planes"])
    return kept.mapInArrow(run, "vec_id long, planes binary")


def _new_centres(planes: DataFrame, centres: np.ndarray) -> np.ndarray:
    """Componentwise floor of the means; centroids without vectors stay. Each task sends at most
    a row for each centroid."""
    n, k = centres.shape[1], len(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, WIDTH), np.int64), np.zeros(k, np.int64)
        for _, words in _slices(batches, n):
            best, _ = nearest(words, centres)
            order = np.argsort(best, kind="stable")
            there, begin = np.unique(best[order], return_index=True)
            sums[there] += np.add.reduceat(from_planes(words[order]), begin, axis=0)
            counts += np.bincount(best, minlength=k)
        at = np.flatnonzero(counts)
        flat = pa.array(sums[at].ravel(), pa.int64())
        ends = pa.array(np.arange(len(at) + 1, dtype=np.int32) * WIDTH, pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at]),
                                          pa.ListArray.from_arrays(ends, flat)], ["c", "n", "s"])

    part = planes.mapInArrow(run, "c int, n long, s array<long>")
    cells = part.select("c", "n", F.posexplode("s").alias("i", "x")).groupBy("c", "i").agg(
        F.sum(F.col("x").cast("decimal(38,0)")).alias("x"), F.sum("n").alias("n"))
    v = from_planes(centres)
    for r in cells.collect():  # 64 numbers for each centroid
        v[r.c, r.i] = int(r.x) // r.n
    return to_planes(v, n)


def _assigned(planes: DataFrame, centres: np.ndarray) -> DataFrame:
    n = centres.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, words in _slices(batches, n):
            best, least = nearest(words, centres)
            yield pa.RecordBatch.from_arrays([ids, pa.array(best), pa.array(least)], ["vec_id", "cluster", "distance"])
    return planes.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(vectors: DataFrame, folder: str, clusters: int = CLUSTERS, rounds: int = ROUNDS,
            id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance of each kept vector; centroids as rows of 64 integers).

    Start: the kept vectors with the smallest SHA-256 of "2:<vec_id>"; vectors with equal ids are
    taken in the order of their components, a null id as the empty string. Fewer vectors than
    ``clusters``: so many centroids. Vectors that are null, of another length, or with a null or
    non-finite component get no row. Components of 2 ** 20 and more (2 ** 28 after scaling) raise:
    squared distances would not fit in 64 bits. Empty table: no rows, no centroids."""
    kept = kept_vectors(vectors, id_col, vec_col)
    r = kept.agg(F.min(F.array_min("v")).alias("lo"), F.max(F.array_max("v")).alias("hi")).first()
    if r.lo is None:
        return kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), \
            np.zeros((0, WIDTH), np.int64)
    if max(-r.lo, r.hi + 1) > 1 << (MOST_PLANES - 1):
        raise ValueError(f"components from {r.lo} to {r.hi} do not fit in {MOST_PLANES} bits")
    n = max(int(-r.lo - 1).bit_length() if r.lo < 0 else 0, int(max(r.hi, 0)).bit_length()) + 1
    planes = stored(pack(kept, n), f"{folder}/planes")
    first = kept.withColumn("h", F.sha2(F.concat(F.lit(SALT), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)) \
        .orderBy("h", "v").limit(clusters).select("v").collect()
    centres = to_planes(np.array([x.v for x in first]).astype(np.int64), n)
    for _ in range(rounds):
        centres = _new_centres(planes, centres)
    return stored(_assigned(planes, centres), f"{folder}/assigned"), from_planes(centres)


def cluster_report(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia,
    centroid_sha256 (of the final centroid's components joined by commas). Cases as in
    ``cluster``; repeated rows are clustered as often as they stand there."""
    spark = vectors.sparkSession
    folder = shared_dir(spark)
    rows, centres = cluster(vectors, folder, id_col=id_col, vec_col=vec_col)
    sums = {r.cluster: r.s for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    named = [(c, int(sums[c]), sum(sums.values()), hashlib.sha256(",".join(map(str, v.tolist())).encode()).hexdigest())
             for c, v in enumerate(centres) if c in sums]  # a row for each centroid
    by = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return finished(rows.join(F.broadcast(by), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"), folder)


def oracle_sql() -> str:
    """DuckDB SQL of ``cluster_report`` over ``embeddings``: rounds written out one after another."""
    parts = [f"""
WITH e AS (SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings WHERE len(embedding) = {WIDTH}
  AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {WIDTH}),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('{SALT}' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c, v FROM e
  QUALIFY c < {CLUSTERS})"""]
    for k in range(ROUNDS + 1):
        parts.append(f"""
d{k} AS (SELECT e.r, c{k}.c, list_sum(list_transform(list_zip(e.v, c{k}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS dist
  FROM e, c{k}),
a{k} AS (SELECT r, arg_min(c, (dist, c)) AS c, min(dist) AS dist FROM d{k} GROUP BY r)""")
        if k < ROUNDS:
            parts.append(f"""
s{k} AS (SELECT a.c, i, sum(e.v[i]::HUGEINT)::HUGEINT AS s, count(*)::HUGEINT AS n
  FROM a{k} a JOIN e USING (r), range(1, {WIDTH + 1}) t(i) GROUP BY a.c, i),
m{k} AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY i) AS v FROM s{k} GROUP BY c),
c{k + 1} AS (SELECT c{k}.c, coalesce(m{k}.v, c{k}.v) AS v FROM c{k} LEFT JOIN m{k} USING (c))""")
    k = ROUNDS
    return ",".join(parts) + f"""
SELECT e.vec_id, a.c::INTEGER AS cluster, a.dist::BIGINT AS distance,
  sum(a.dist) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia, sum(a.dist) OVER ()::BIGINT AS inertia,
  sha256(list_aggregate(list_transform(c.v, lambda x: x::BIGINT::VARCHAR), 'string_agg', ',')) AS centroid_sha256
FROM a{k} a JOIN e USING (r) JOIN c{k} c ON a.c = c.c"""

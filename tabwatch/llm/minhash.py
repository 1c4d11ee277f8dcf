"""Near-duplicate groups by an inverted join on signature coordinates.

Each text gets a MinHash signature of its distinct 5-word shingles. Every (coordinate, value)
pair is a posting key. Two texts at similarity 0.75 agree on at least MATCHES of SIGNATURE
coordinates but for about 4 pairs in a million. If they do, and both order their keys from
rare to frequent, they share one of the first m - MATCHES + 1 keys (m: keys that any other
text has too). Only this prefix is posted; the longest lists are skipped, and the collisions
on skipped keys are counted by comparing the signatures of a candidate pair.

Texts with equal shingle sets are one class. In each posting list the classes are first
compared with the list's best connected class, which joins groups of near copies at a cost
linear in the list. In a list that is still in several components, the members outside its
largest component are compared with all others, in cells of bounded size inside the tasks, each
pair in one list; a member is sent once for each BLOCK members outside, so a large group with a
few classes apart is sent once. Members with a partner of enough collisions then bring their
full shingle sets into the cell; it confirms the pairs there and gives the links of a forest
only, fewer than it has members."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwatch.llm.common import finished, packed, shared_dir, stored, text_or_empty, unpacked

WORDS = 5
SIGNATURE = 64           # coordinates that are posted
MATCHES = 32             # collisions among them, at least
MORE = 128               # further coordinates (8 bits each) that are only counted
ENOUGH = 116             # collisions among all, at least: 4.7 deviations under a similarity of 0.75
BLOCK = 2048             # classes of a posting list that are held together, and met by as many
CHAIN = 1 << 15          # classes of a list's largest component that meet one block in one task
HELD = 1 << 20           # shingles of the classes whose sets are held together, and one class more
CHUNK = 1024             # shingles in one row
SIMILAR = 75             # percent
BROADCAST_IDS = 1_000_000  # ids of texts to be compared in full; more are shuffled
BROADCAST_SHINGLES = 3_000_000  # shingles (8 bytes each) of those texts; more are shuffled
SLICE = 1 << 20          # bytes hashed at once
ROWS = 256

_rng = np.random.default_rng(20240501)
_PLACE = _rng.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = _rng.integers(0, 1 << 63, SIGNATURE + MORE, dtype=np.uint64)
_TIMES = _rng.integers(1, 1 << 63, SIGNATURE + MORE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, byte position) of each word: runs without ASCII white space, A-Z in lower case."""
    u8 = np.frombuffer(data, np.uint8)
    out, places, at = [], [], 0
    while at < len(u8):
        end = at + SLICE
        while True:  # a slice ends before white space, however long the word
            part = u8[at:end]
            white = (part == 32) | ((part >= 9) & (part <= 13))
            if end >= len(u8) or (stop := np.flatnonzero(white)[-1:]).size:
                break
            end += SLICE
        if end < len(u8):
            part, white = part[:stop[0] + 1], white[:stop[0] + 1]
        low = part + np.where((part >= 65) & (part <= 90), np.uint8(32), np.uint8(0))
        word = ~white
        edge = np.diff(np.concatenate([[0], word.view(np.int8), [0]]))
        begin, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(begin):
            offsets = np.concatenate([[0], np.cumsum(stops - begin)])
            words = pa.Array.from_buffers(pa.large_binary(), len(begin), [
                None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(low[word])]).dictionary_encode()
            hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
            out.append(hashed[words.indices.to_numpy()])
            places.append(begin + at)
        at += len(part)
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(out), np.concatenate(places)


def shingle_sets(texts: list[str]) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes (64 bits) of each text."""
    raw = [t.encode("utf-8") for t in texts]
    words, places = word_hashes(b"\n".join(raw))
    ends = np.cumsum([len(r) + 1 for r in raw])
    cut = np.searchsorted(places, ends, "left")
    a = 0
    for b in cut.tolist():
        w, a = words[a:b], b
        n = min(len(w), WORDS)
        if not n:
            yield np.empty(0, np.uint64)
            continue
        s = np.full(len(w) - n + 1, np.uint64(n), np.uint64)
        for k in range(n):
            s = _mix(s + w[k:len(w) - n + 1 + k] * _PLACE[k])
        yield np.unique(s)


def signature(s: np.ndarray) -> tuple[np.ndarray, bytes]:
    """(posted coordinates, 8 bits of each further coordinate)."""
    least = np.full(SIGNATURE + MORE, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(s), 512):
        least = np.minimum(least, ((s[k:k + 512, None] ^ _XOR) * _TIMES).min(0))
    high = (least >> np.uint64(32)).astype(np.uint32)
    return high[:SIGNATURE].view(np.int32), _mix(least[SIGNATURE:]).astype(np.uint8).tobytes()


def _small(texts: list[str], chars: int = 1 << 19) -> Iterator[tuple[int, int]]:
    a, size = 0, 0
    for k, t in enumerate(texts):
        if k > a and size + len(t) > chars:
            yield a, k
            a, size = k, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts)


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of the batches: so many rows are Python objects at a time."""
    return (b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _few(batches):
        texts = b.column(2).to_pylist()
        for i, j in _small(texts):
            n, cid, sig, more, ends = [], [], [], [], [0]
            for s in shingle_sets(texts[i:j]):
                n.append(len(s))
                cid.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                if len(s):
                    posted, counted = signature(s)
                    sig.append(posted)
                more.append(counted if len(s) else None)
                ends.append(len(sig) * SIGNATURE)
            flat = np.concatenate(sig) if sig else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array(n, pa.int64()),
                 pa.array(cid, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                 pa.array(more, pa.binary())],
                ["doc_id", "h", "n_shingles", "cid", "sig", "more"])


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _few(batches):
        texts = b.column(0).to_pylist()
        for i, j in _small(texts):
            sets = list(shingle_sets(texts[i:j]))
            ends = np.cumsum([0, *map(len, sets)])
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))],
                ["cid", "shingles"])


def sign_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, h (text hash), n_shingles, cid (digest of the shingle set; null if empty), sig,
    more."""
    t = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return t.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(
        _sign, "doc_id long, h long, n_shingles long, cid binary, sig array<int>, more binary")


def prefix_postings(classes: DataFrame) -> DataFrame:
    """token, k (its coordinate), cid, hub, mask: the rarest keys of each class, as many as a
    similar pair can't miss. hub grows with the number of classes that share the keys of this
    one; mask has the bits of all coordinates in the prefix. token: coordinate and value in one
    number; with the number of the class it is all that is shuffled of a key."""
    token = F.shiftleft(F.col("k").cast("long"), 32).bitwiseOR(F.col("v").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    keys = classes.select("num", F.posexplode("sig").alias("k", "v")).select("num", token.alias("token"))
    lists = keys.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    own = keys.join(lists, "token").groupBy("num").agg(
        F.sort_array(F.collect_list(F.struct("n", "token"))).alias("t"), F.sum("n").alias("hub"))
    prefix = own.where(F.size("t") >= MATCHES).select(
        "num", "hub", F.slice("t", 1, F.size("t") - (MATCHES - 1)).alias("t"))
    k = "CAST(shiftright(x.token, 32) AS INT)"
    return prefix.join(classes.select("num", "cid"), "num") \
        .select("cid", "hub", F.expr(f"aggregate(t, 0L, (m, x) -> m | shiftleft(1L, {k}))").alias("mask"),
                F.explode("t").alias("x")) \
        .select(F.col("x.token").alias("token"), F.expr(k).alias("k"), "cid", "hub", "mask")


def _cell_members(left: list[tuple], right: list[tuple] | None, cell_of: tuple) -> Iterator[tuple]:
    """Members (cell, at, label, cid, partners) of one cell that have a partner: a member of the
    other side (``right`` None: of the same) in another component, of a size that allows
    similarity, with enough collisions, that shares no earlier coordinate of both prefixes (so
    that only one list gives the pair). Members beyond HELD shingles are dealt to several cells.
    at: place in the cell; label: number of the component in the cell; partners: bits of later
    places. Rows: token, i, j, late, k, cid, label, mask, n_shingles, sig, more."""
    if not left or right == []:
        return
    k, same = left[0][4], right is None
    left = sorted(left, key=lambda r: r[5])
    right = left if same else sorted(right, key=lambda r: r[5])
    names: dict[bytes, int] = {}
    pack = lambda x: (np.array([r[9] for r in x], np.int32), np.frombuffer(b"".join(r[10] for r in x), np.uint8).reshape(len(x), -1),
                      np.array([names.setdefault(r[6], len(names)) for r in x]),
                      (np.array([r[7] for r in x], np.int64)[:, None] >> np.arange(SIGNATURE)) & 1 == 1,
                      np.array([r[8] for r in x], np.int64))
    sa, ma, la, ba, na = pack(left)
    sb, mb, lb, bb, nb = (sa, ma, la, ba, na) if same else pack(right)
    skip = 0 if same else len(left)  # place of the first member of the right side
    members = left if same else left + right
    label = la if same else np.concatenate([la, lb])
    xs, ys = [], []
    for a in range(len(left)):
        met = sa[a] == sb
        ok = (met.sum(1) >= MATCHES) & (lb != la[a]) & (100 * np.minimum(nb, na[a]) >= SIMILAR * np.maximum(nb, na[a]))
        if same:
            ok[:a + 1] = False
        at = np.flatnonzero(ok)
        if not len(at):
            continue
        enough = met[at].sum(1) + (mb[at] == ma[a]).sum(1) >= ENOUGH
        first = (met[at] & ba[a] & bb[at]).argmax(1) == k
        at = at[enough & first]
        xs.append(np.full(len(at), a))
        ys.append(at + skip)
    if not xs:
        return
    x, y = np.concatenate(xs), np.concatenate(ys)
    used = np.unique(np.concatenate([x, y]))
    size = np.array([members[m][8] for m in used])
    part = np.zeros(len(members), np.int64)
    part[used] = (np.cumsum(size) - size) // HELD
    low, high = np.minimum(part[x], part[y]), np.maximum(part[x], part[y])
    for p, q in sorted(set(zip(low.tolist(), high.tolist()))):
        here = (low == p) & (high == q)
        own = np.unique(np.concatenate([x[here], y[here]]))
        bits = np.zeros((len(own), len(own)), bool)
        bits[np.searchsorted(own, x[here]), np.searchsorted(own, y[here])] = True
        cell = struct.pack("<qiiqqq", *cell_of, p, q)
        for place, m in enumerate(own.tolist()):
            yield cell, place, int(label[m]), members[m][5], np.packbits(bits[place]).tobytes()


def _compare_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (token, i, j, late). The block of a cell (late false) is held and, where
    j is 0, compared in itself; those that meet it follow and are held BLOCK at a time."""
    found: list[tuple] = []
    current, block, late, runs = None, [], [], 0
    types = [pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    emit = lambda: pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*found), types)], ["cell", "at", "label", "cid", "partners"])

    def met() -> None:
        nonlocal late, runs
        runs += 1
        found.extend(_cell_members(block, late, (*current, runs)))
        late = []

    def alone() -> None:
        if block and current[2] == 0:
            found.extend(_cell_members(block, None, (*current, 0)))

    for batch in _few(batches):
        for row in zip(*(batch.column(c).to_pylist() for c in range(batch.num_columns))):
            if row[:3] != current:
                if current:
                    met()
                    alone()
                current, block, runs = row[:3], [], 0
            if not row[3]:
                block.append(row)
            else:
                late.append(row)
                if len(late) >= BLOCK:
                    met()
            if len(found) >= 20_000:
                yield emit()
                found.clear()
    if current:
        met()
        alone()
    if found:
        yield emit()


def cells_apart(posts: DataFrame, label: DataFrame, classes: DataFrame) -> DataFrame:
    """cell, at, label, cid, partners: members of the posting lists whose classes lie in several
    components, with the candidates they are to be compared with (see ``_cell_members``)."""
    n = int(posts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt_apart(posts, label, classes).repartition(n, "token", "i", "j") \
        .sortWithinPartitions("token", "i", "j", "late") \
        .mapInArrow(_compare_cells, "cell binary, at int, label int, cid binary, partners binary")


def dealt_apart(posts: DataFrame, label: DataFrame, classes: DataFrame) -> DataFrame:
    """token, i, j, late, k, cid, label, mask, n_shingles, sig, more: the members of lists in several
    components, dealt to cells (token, i, j). Those outside the list's largest component are cut
    into blocks i. Those inside, cut into chains j, meet every block, so they are sent once a block;
    a member outside is sent to its block once a chain, and to the blocks before its own. No list
    sends the pairs inside its largest component."""
    at = posts.select("token", "k", "cid", "mask").join(label, F.col("cid") == F.col("node"), "left") \
        .select("token", "k", "cid", "mask", F.coalesce("label", "cid").alias("label"))
    sizes = at.groupBy("token", "label").agg(F.count(F.lit(1)).alias("n"))
    open_lists = sizes.groupBy("token").agg(
        F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("labels")) \
        .where("labels > 1").select(
            "token", F.col("top.label").alias("top"),
            F.ceil((F.col("n") - F.col("top.n")) / BLOCK).cast("int").alias("blocks"),
            F.ceil(F.col("top.n") / CHAIN).cast("int").alias("chains"))
    cell = lambda i, j, late: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(late).alias("late"))
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    mod = lambda n: F.pmod(F.xxhash64("cid"), F.col(n)).cast("int")
    own, zero = mod("blocks"), F.lit(0)
    inside = F.transform(upto(F.col("blocks")), lambda i: cell(i, mod("chains"), True))
    outside = F.transform(upto(F.col("chains")), lambda j: cell(own, j, False))
    before = F.when(own > 0, F.transform(upto(own), lambda i: cell(i, zero, True)))
    cells = F.when(F.col("label") == F.col("top"), inside).when(own > 0, F.concat(outside, before)).otherwise(outside)
    return at.join(open_lists, "token").withColumn("c", F.explode(cells)) \
        .join(classes.select("cid", "n_shingles", "sig", "more"), "cid") \
        .select("token", "c.i", "c.j", "c.late", "k", "cid", "label", "mask", "n_shingles", "sig", "more")


def _forest(members: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
    """Links of one cell that join two components. Members: label, cid, partners, shingle set, in
    the order of their places; pairs that earlier links have joined are not compared."""
    top = list(range(max(m[0] for m in members) + 1))

    def find(x: int) -> int:
        while top[x] != x:
            top[x] = x = top[top[x]]
        return x

    for label, cid, partners, own in members:
        at = np.flatnonzero(np.unpackbits(np.frombuffer(partners, np.uint8)))
        mine = find(label)
        at = [p for p in at.tolist() if find(members[p][0]) != mine]
        if not at:
            continue
        sizes = np.array([len(members[p][3]) for p in at])
        every = np.concatenate([members[p][3] for p in at])
        place = np.minimum(np.searchsorted(own, every), len(own) - 1)
        common = np.add.reduceat((own[place] == every).astype(np.int64), np.cumsum(sizes) - sizes)
        alike = 100 * common >= SIMILAR * (sizes + len(own) - common)
        for p in np.array(at)[alike].tolist():
            other = find(members[p][0])
            if other != find(label):
                top[other] = find(label)
                yield cid, members[p][1]


def _confirm_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (cell, at, chunk); the sets of one cell are held together, no more."""
    current, members, found = None, [], []

    def closed() -> None:
        if members:
            found.extend(_forest([(lab, cid, bits, np.concatenate(sets)) for _, lab, cid, bits, sets in members]))
            members.clear()

    emit = lambda: pa.RecordBatch.from_arrays(
        [pa.array(c, pa.binary()) for c in zip(*found)], ["a", "b"])
    for batch in _few(batches):
        cell, at, label, cid, partners = (batch.column(c).to_pylist() for c in range(5))
        sets = batch.column(6)
        for r in range(batch.num_rows):
            if cell[r] != current:
                closed()
                current = cell[r]
            if not members or members[-1][0] != at[r]:
                members.append((at[r], label[r], cid[r], partners[r], []))
            members[-1][4].append(sets[r].values.to_numpy().view(np.uint64).copy())
        if len(found) >= 20_000:
            yield emit()
            found.clear()
    closed()
    if found:
        yield emit()


def links_apart(cells: DataFrame, classes: DataFrame, docs: DataFrame, path: str) -> DataFrame:
    """a, b: links between components, confirmed on full sets inside the cells; of each cell, a
    forest."""
    needed = cells.select("cid").distinct().join(classes.select("cid", "rep"), "cid")
    sets = stored(_class_sets(needed, docs), f"{path}-sets")
    last = F.ceil(F.size("shingles") / CHUNK).cast("int") - 1
    parts = sets.select("cid", "shingles", F.explode(F.sequence(F.lit(0), last)).alias("chunk")) \
        .select("cid", "chunk", F.slice("shingles", F.col("chunk") * CHUNK + 1, F.lit(CHUNK)).alias("part"))
    rows = cells.join(parts, "cid").select("cell", "at", "label", "cid", "partners", "chunk", "part")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(rows.repartition(n, "cell").sortWithinPartitions("cell", "at", "chunk")
                  .mapInArrow(_confirm_cells, "a binary, b binary"), f"{path}-links")


def _class_sets(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """cid, shingles of the classes (cid, rep), from the texts of their representatives."""
    ids = classes.select(F.col("rep").alias("id")).distinct()
    few = ids.count() <= BROADCAST_IDS
    texts = docs.join(F.broadcast(ids) if few else ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    return texts.select("text").mapInArrow(_set_rows, "cid binary, shingles array<long>") \
        .join(classes.select("cid").distinct(), "cid", "left_semi").dropDuplicates(["cid"])


def _similar(pairs: DataFrame, classes: DataFrame, docs: DataFrame, path: str) -> DataFrame:
    """The pairs (a, b) that are similar: enough collisions, then full sets."""
    sig = classes.select("cid", "rep", "n_shingles", "sig")
    side = lambda n: sig.select(*[F.col(c).alias(f"{c}_{n}") for c in sig.columns])
    met = F.aggregate(F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int")), F.lit(0),
                      lambda s, x: s + x)
    sizes = 100 * F.least("n_shingles_a", "n_shingles_b") >= SIMILAR * F.greatest("n_shingles_a", "n_shingles_b")
    near = stored(pairs.join(side("a"), F.col("a") == F.col("cid_a"))
                  .join(side("b"), F.col("b") == F.col("cid_b")).where(sizes & (met >= MATCHES))
                  .select("a", "b", "rep_a", "rep_b"), f"{path}-near")
    both = near.select(F.col("a").alias("cid"), F.col("rep_a").alias("rep")).unionByName(
        near.select(F.col("b").alias("cid"), F.col("rep_b").alias("rep"))).distinct()
    sets = stored(_class_sets(both, docs), f"{path}-sets")
    common = F.size(F.array_intersect("sa", "sb"))
    total = sets.agg(F.sum(F.size("shingles")).alias("n")).first().n or 0
    hint = F.broadcast if total <= BROADCAST_SHINGLES else lambda d: d
    return stored(near.select("a", "b").join(hint(sets.select(F.col("cid").alias("a"), F.col("shingles").alias("sa"))), "a")
                  .join(hint(sets.select(F.col("cid").alias("b"), F.col("shingles").alias("sb"))), "b")
                  .where(100 * common >= SIMILAR * (F.size("sa") + F.size("sb") - common))
                  .select("a", "b"), f"{path}-links")


def components(links: DataFrame, folder: str) -> DataFrame:
    """node, label (the component's least node) for every node of the links, by alternating
    large-star and small-star steps; each step is a stored table."""
    e = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
               .where("u <> v").distinct(), f"{folder}/e0")
    sign = lambda d: d.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    was, k = sign(e), 0
    while was.n:
        k += 1
        ways = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = ways.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .where("u <> v").distinct()
        large = stored(large, f"{folder}/e{k}l")
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u")
        e = stored(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), f"{folder}/e{k}")
        now = sign(e)
        if (now.n, now.s) == (was.n, was.s):
            break
        was = now
    tops = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        tops.select("node", F.col("node").alias("label")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, h (text hash), n_shingles, component_id, kept.

    Texts without words have no shingles, no links and their own id as component. Texts with
    fewer than 5 words are one shingle. component_id is the least id reachable by links
    (similarity of at least 0.75); kept: doc_id is that id. Null ids count as larger than any
    id, null texts as empty. Rows with equal ids are alike in kept. Empty table: no rows."""
    spark: SparkSession = docs.sparkSession
    folder = shared_dir(spark)
    signed = stored(sign_documents(docs, id_col, text_col), f"{folder}/signed")
    classes = stored(signed.where("cid IS NOT NULL").groupBy("cid").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"),
        F.first("more").alias("more")).withColumn("num", F.monotonically_increasing_id()), f"{folder}/classes")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    posts = stored(prefix_postings(classes), f"{folder}/postings")

    # every class of a list against the list's best connected class
    leader = posts.groupBy("token").agg(F.max(F.struct("hub", "cid")).alias("lead"),
                                        F.count(F.lit(1)).alias("n")).where("n > 1")
    first = stored(posts.join(leader, "token").where("cid <> lead.cid").select(
        F.least("cid", "lead.cid").alias("a"), F.greatest("cid", "lead.cid").alias("b"))
        .distinct(), f"{folder}/pairs1")
    links = _similar(first, classes, texts, f"{folder}/1")
    label = components(links, f"{folder}/c1")

    # members of a list that are still apart
    apart = stored(cells_apart(posts, label, classes), f"{folder}/cells")
    more = links_apart(apart, classes, texts, f"{folder}/2")
    if not more.isEmpty():
        label = components(links.unionByName(more), f"{folder}/c2")

    member = classes.select("cid", "rep").join(label, F.col("cid") == F.col("node"), "left") \
        .select("cid", "rep", F.coalesce("label", "cid").alias("label"))
    least = member.groupBy("label").agg(F.min("rep").alias("component_id"))
    of_class = member.join(least, "label").select("cid", F.col("component_id").alias("least_id"))
    out = signed.select("doc_id", "h", "n_shingles", "cid").join(of_class, "cid", "left")
    comp = F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("least_id"))
    return finished(out.select("doc_id", "h", "n_shingles", comp.alias("component_id"),
                               F.col("doc_id").eqNullSafe(comp).alias("kept")), folder)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, one document of each group, with all their columns."""
    keep = near_duplicates(docs, id_col, text_col).where("kept").select("doc_id", F.col("h").alias("text_hash"))
    rows = packed(docs, id=F.col(id_col).cast("long"), h=F.xxhash64(text_or_empty(text_col)))
    return unpacked(rows.join(keep, F.col("id").eqNullSafe(F.col("doc_id"))
                              & (F.col("h") == F.col("text_hash")), "left_semi"))

"""Phrase collocations by best-first branch-and-bound growth.

A phrase of three words scores at most f(first two) / f(first): its count can't be larger than
that of its first two words, nor smaller parts rarer than the phrase. So the counts of a prefix
bound the scores of everything that grows from it, and the score of the prefix itself. Words are
counted first, then pairs of frequent words (nodes). Nodes are expanded from the best bound
down, in rounds that each read the documents once: an expansion counts all frequent phrases
that hold the node, which also tells whether a longer phrase covers it. A language is done
when no node left has a bound as high as its 2000th surviving score; nodes that tie with it are
expanded too.

What a round has to count is told to the tasks by bitmaps of a fixed size. They may let other
phrases through, which a join with the nodes removes; they never lose one."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwatch.llm.common import finished, shared_dir, stored, text_or_empty

MIN_COUNT = 10
TOP = 2000
COVER = 50               # percent of a phrase's count that a longer one must have to cover it
SCALE = 1_000_000
BITS = 26                # log2 of a bitmap's size: 8 MB, whatever it holds
BLOCK = 1 << 15          # bits that Spark's bitmap functions put into one value
FIRST = 4 * TOP          # nodes of a language that the first round expands, about
GROWTH = 8               # each further round expands so many times more
SMALL_LANGS = 10_000     # languages whose bounds are broadcast; more are shuffled
SLICE = 2 << 20          # bytes of text that are held as arrays
ROWS = 256               # texts taken from a batch at once

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 32]] = 1                                            # between words
_KIND[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = 2      # between pieces
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _crc(values: pa.Array) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, values.cast(pa.binary()).to_pylist()), np.uint64, len(values))


def _place(*hashes: np.ndarray) -> np.ndarray:
    """Bit of a phrase in the bitmaps, from the hashes of its language and words."""
    x = np.zeros(len(hashes[0]), np.uint64)
    for k, h in enumerate(hashes):
        x = (x ^ (h + np.uint64(k + 1))) * _M1
        x = (x ^ (x >> np.uint64(29))) * _M2
    return ((x ^ (x >> np.uint64(32))) * _M3) >> np.uint64(64 - BITS)


def _has(bitmap: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (bitmap[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap(phrases: DataFrame, words: list[str]) -> np.ndarray:
    """Bitmap of the phrases (lang and ``words``); 8 MB reach the driver, however many there are."""
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = _place(*[_crc(b.column(k)) for k in range(b.num_columns)])
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(p).astype(np.int64))], ["p"])
    rows = phrases.select("lang", *words).mapInArrow(places, "p long") \
        .groupBy(F.expr(f"p div {BLOCK}").alias("block")).agg(F.bitmap_construct_agg(F.col("p") % BLOCK).alias("bits"))
    out = np.zeros((1 << BITS) // 8, np.uint8)
    for r in rows.collect():
        out[r.block * BLOCK // 8:][:len(r.bits)] = np.frombuffer(r.bits, np.uint8)
    return out


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text in parts of about SLICE bytes, cut between pieces only."""
    u8, at = np.frombuffer(text, np.uint8), 0
    while len(text) - at > SLICE:
        ends = np.flatnonzero(_KIND[u8[at:at + SLICE]] == 2)[-1:]
        if not ends.size:  # a piece longer than that stays whole
            ends = np.flatnonzero(_KIND[u8[at:]] == 2)[:1]
        if not ends.size:
            break
        yield text[at:at + ends[0] + 1]
        at += int(ends[0]) + 1
    yield text[at:]


def _slices(langs: pa.Array, texts: pa.Array) -> Iterator[list[tuple[int, bytes]]]:
    rows, size = [], 0
    for k in range(0, len(texts), ROWS):
        for lang, text in zip(langs.slice(k, ROWS).to_pylist(), texts.slice(k, ROWS).to_pylist()):
            for part in _pieces(text):
                if rows and size + len(part) > SLICE:
                    yield rows
                    rows, size = [], 0
                rows.append((lang, part))
                size += len(part)
    if rows:
        yield rows


def _words(rows: list[tuple[int, bytes]]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, language of each, piece of each)."""
    data = np.frombuffer(b"\n".join(t for _, t in rows).translate(_LOWER), np.uint8)
    kind = _KIND[data]
    inside = kind == 0
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    ends = np.cumsum([len(t) + 1 for _, t in rows])
    lang = np.array([x for x, _ in rows], np.int64)[np.searchsorted(ends, begin, "right")]
    return words, lang, np.cumsum(kind == 2, dtype=np.int32)[begin]


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, the number of each key among them, their counts)."""
    at, found = pd.factorize(keys)
    return found, at, np.bincount(at, minlength=len(found))


def _grams(rows: list[tuple[int, bytes]], level: int, lang_hash: np.ndarray, known: np.ndarray | None,
           fresh: np.ndarray | None) -> tuple[pa.Array, np.ndarray, list[np.ndarray], np.ndarray]:
    """(dictionary, language of each phrase, its words in the dictionary, its count) of one slice.
    Level 2: both words are in ``known``. Level 3: both pairs are in ``known``, one in ``fresh``."""
    words, lang, piece = _words(rows)
    coded = words.dictionary_encode()
    names, code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    v = max(len(names), 1)
    word, at, count = _distinct(lang * v + code)
    owner, spelled = word // v, word % v
    if level == 1:
        return names, owner, [spelled], count
    h, hl = _crc(names)[spelled], lang_hash[owner]
    near = piece[1:] == piece[:-1]
    if level == 2:
        alive = _has(known, _place(hl, h))[at]
        near &= alive[1:] & alive[:-1]
    u = max(len(word), 1)
    pair, of, count = _distinct(at[:-1][near] * u + at[1:][near])
    one, two = pair // u, pair % u
    if level == 2:
        return names, owner[one], [spelled[one], spelled[two]], count
    p = _place(hl[one], h[one], h[two])
    node, new = _has(known, p), _has(fresh, p)
    number = np.full(len(at), -1, np.int64)
    number[:-1][near] = of
    a, b = number[:-2], number[1:-1]
    go = np.flatnonzero((a >= 0) & (b >= 0))
    a, b = a[go], b[go]
    go = node[a] & node[b] & (new[a] | new[b])
    three, _, count = _distinct(a[go] * u + two[b[go]])
    a, c = three // u, three % u
    return names, owner[one[a]], [spelled[one[a]], spelled[two[a]], spelled[c]], count


def count_phrases(texts: DataFrame, level: int, known: np.ndarray | None = None,
                  fresh: np.ndarray | None = None) -> DataFrame:
    """lang, w1 .. w<level>, n: contiguous occurrences within pieces, counted in the tasks first."""
    share = texts.sparkSession.sparkContext.broadcast
    maps = [share(known) if known is not None else None, share(fresh) if fresh is not None else None]
    names = [f"w{k + 1}" for k in range(level)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [m.value if m else None for m in maps]
        for b in batches:
            langs = b.column(0).dictionary_encode()
            lang_hash = _crc(langs.dictionary)
            for rows in _slices(langs.indices, b.column(1).cast(pa.binary())):
                words, lang, parts, count = _grams(rows, level, lang_hash, *held)
                for k in range(0, len(count), 20_000):
                    cut = slice(k, k + 20_000)
                    yield pa.RecordBatch.from_arrays(
                        [langs.dictionary.take(pa.array(lang[cut])), *[words.take(pa.array(p[cut])) for p in parts],
                         pa.array(count[cut].astype(np.int64))], ["lang", *names, "n"])
    schema = ", ".join(f"{c} string" for c in ["lang", *names]) + ", n long"
    return texts.mapInArrow(run, schema).groupBy("lang", *names).agg(F.sum("n").alias("n"))


def _ratio(top: list[str], bottom: list[str]) -> Column:
    """floor(SCALE * product / product), exact up to 38 digits."""
    wide = lambda cs: " * ".join(f"cast({c} as decimal(19, 0))" for c in cs)
    return F.expr(f"cast(({wide(top)}) * {SCALE} as decimal(38, 0)) div ({wide(bottom)})")


class _ByLang:
    """Joins of large tables with one row for each language."""

    def __init__(self, n_langs: int):
        self.hint = F.broadcast if n_langs <= SMALL_LANGS else lambda d: d

    def __call__(self, rows: DataFrame, side: DataFrame) -> DataFrame:
        return rows.join(self.hint(side), "lang")


def _threshold(settled: DataFrame, langs: DataFrame, top: int) -> DataFrame:
    """lang, least: the score of the ``top``-th settled phrase, 0 if there are fewer."""
    w = Window.partitionBy("lang").orderBy(F.desc("score"))
    best = settled.select("lang", "score").withColumn("k", F.row_number().over(w)).where(F.col("k") <= top)
    last = best.groupBy("lang").agg(F.min("score").alias("s"), F.count(F.lit(1)).alias("c")).where(F.col("c") == top)
    return langs.select("lang").join(last, "lang", "left").select("lang", F.coalesce("s", F.lit(0)).alias("least"))


def _next_cut(left: DataFrame, want: int) -> DataFrame:
    """lang, cut: the bound down to which the next round expands: at least ``want`` nodes of those
    left, or all. Bounds are counted in a thousand steps."""
    step = SCALE // 1000
    steps = left.groupBy("lang", F.expr(f"bound div {step}").alias("step")) \
        .agg(F.count(F.lit(1)).alias("c"), F.min("bound").alias("low"))
    w = Window.partitionBy("lang").orderBy(F.desc("step"))
    run = steps.withColumn("run", F.sum("c").over(w))
    return run.groupBy("lang").agg(F.coalesce(
        F.max(F.when(F.col("run") >= want, F.col("step") * step)), F.min("low")).alias("cut"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = TOP,
                 min_count: int = MIN_COUNT, cover: int = COVER, first: int = FIRST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of 2 to 3 words.

    A-Z are lowered; texts are cut into pieces at `.,;:!?` and line ends, pieces into words at
    blanks and tabs. a, l, r: occurrences of the phrase and of the parts of its worst cut; n: words
    of the language; score: floor(1000000 a a / (l r)). A phrase goes if a longer one that holds it
    has ``cover`` percent of its count. Order: score, a (both descending), phrase; so ties have one
    order. Null languages are `und` (together with that name), null texts empty. Rows that repeat
    count as often as they stand there. Languages with fewer phrases give fewer rows; an empty
    table none. Long texts are read whole, in parts cut between pieces. Other columns are not read."""
    spark = docs.sparkSession
    folder = shared_dir(spark)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        text_or_empty(text_col).alias("text"))
    words = stored(count_phrases(texts, 1), f"{folder}/words")
    langs = stored(words.groupBy("lang").agg(F.sum("n").alias("total")), f"{folder}/langs")
    by_lang = _ByLang(langs.count())
    common = words.where(F.col("n") >= min_count)
    pairs = count_phrases(texts, 2, bitmap(common, ["w1"])).where(F.col("n") >= min_count)
    nodes = pairs.withColumnRenamed("n", "a") \
        .join(common.select("lang", "w1", F.col("n").alias("l")), ["lang", "w1"]) \
        .join(common.select("lang", F.col("w1").alias("w2"), F.col("n").alias("r")), ["lang", "w2"]) \
        .select("lang", "w1", "w2", "a", "l", "r", _ratio(["a", "a"], ["l", "r"]).alias("score"),
                _ratio(["a"], ["l"]).alias("bound"))
    nodes = stored(nodes, f"{folder}/nodes")
    known = bitmap(nodes, ["w1", "w2"])

    done = stored(langs.select("lang", F.lit(SCALE + 1).cast("long").alias("cut"), F.lit(0).cast("long").alias("least")),
                  f"{folder}/state0")
    threes, k = None, 0
    while True:
        left = by_lang(nodes, done).where("bound < cut AND bound >= least")
        if left.isEmpty():
            break
        k += 1
        new_cut = by_lang(_next_cut(left, first * GROWTH ** (k - 1)), done.select("lang", "least")) \
            .select("lang", F.greatest("cut", "least").alias("new_cut"))
        bounds = stored(done.select("lang", "cut").join(new_cut, "lang", "left")
                        .select("lang", F.col("cut").alias("above"), F.coalesce("new_cut", "cut").alias("cut")),
                        f"{folder}/bounds{k}")
        fresh = bitmap(by_lang(nodes, bounds).where("bound < above AND bound >= cut"), ["w1", "w2"])
        grown = count_phrases(texts, 3, known, fresh).where(F.col("n") >= min_count)
        head = nodes.select("lang", "w1", "w2", F.col("a").alias("xy"), F.col("l").alias("x"), F.col("bound").alias("b1"))
        tail = nodes.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("yz"),
                            F.col("r").alias("z"), F.col("bound").alias("b2"))
        both = grown.withColumnRenamed("n", "a").join(head, ["lang", "w1", "w2"]).join(tail, ["lang", "w2", "w3"])
        # what an earlier round has counted, or a bitmap let through, has no new node
        scored = by_lang(both, bounds).where("greatest(b1, b2) < above AND greatest(b1, b2) >= cut") \
            .withColumn("s1", _ratio(["a", "a"], ["x", "yz"])).withColumn("s2", _ratio(["a", "a"], ["xy", "z"])) \
            .select("lang", "w1", "w2", "w3", "a", F.expr("if(s1 <= s2, x, xy)").alias("l"),
                    F.expr("if(s1 <= s2, yz, z)").alias("r"), F.least("s1", "s2").alias("score"))
        scored = stored(scored, f"{folder}/threes{k}")
        threes = scored if threes is None else threes.unionByName(scored)
        covers = threes.select("lang", "w1", "w2", "a").unionByName(
            threes.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a")) \
            .groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer"))
        alive = by_lang(nodes, bounds).where("bound >= cut").join(covers, ["lang", "w1", "w2"], "left") \
            .where(F.expr(f"longer IS NULL OR 100 * longer < {int(cover)} * a"))
        settled = alive.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", "score") \
            .unionByName(threes.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", "l", "r", "score"))
        settled = stored(settled, f"{folder}/settled{k}")
        done = stored(bounds.select("lang", "cut").join(_threshold(settled, langs, top), "lang"), f"{folder}/state{k}")
    if threes is None:
        return spark.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    best = by_lang(settled, done).where("score >= least")
    w = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    return finished(by_lang(ranked, langs).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"), folder)


def oracle_sql() -> str:
    """DuckDB SQL of ``collocations`` over ``documents``: all phrases are counted."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    ratio = lambda a, l, r: f"({SCALE}::HUGEINT * {a} * {a} // ({l}::HUGEINT * {r}))"
    return f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
  translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
o AS (SELECT lang, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM g),
f1 AS (SELECT lang, a, count(*) AS f FROM o GROUP BY ALL),
f2 AS (SELECT lang, a, b, count(*) AS f FROM o WHERE b IS NOT NULL GROUP BY ALL HAVING f >= {MIN_COUNT}),
f3 AS (SELECT lang, a, b, c, count(*) AS f FROM o WHERE c IS NOT NULL GROUP BY ALL HAVING f >= {MIN_COUNT}),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
x AS (SELECT f2.lang, f2.a || ' ' || f2.b AS phrase, f2.f AS a, p.f AS l, q.f AS r, {ratio('f2.f', 'p.f', 'q.f')} AS score
  FROM f2 JOIN f1 p ON p.lang = f2.lang AND p.a = f2.a JOIN f1 q ON q.lang = f2.lang AND q.a = f2.b
  WHERE NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND f3.a = f2.a AND f3.b = f2.b AND 100 * f3.f >= {COVER} * f2.f)
  AND NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND f3.b = f2.a AND f3.c = f2.b AND 100 * f3.f >= {COVER} * f2.f)),
y AS (SELECT f3.*, p.f AS l1, q.f AS r1, s.f AS l2, t.f AS r2, {ratio('f3.f', 'p.f', 'q.f')} AS s1, {ratio('f3.f', 's.f', 't.f')} AS s2
  FROM f3 JOIN f1 p ON p.lang = f3.lang AND p.a = f3.a JOIN f2 q ON q.lang = f3.lang AND q.a = f3.b AND q.b = f3.c
  JOIN f2 s ON s.lang = f3.lang AND s.a = f3.a AND s.b = f3.b JOIN f1 t ON t.lang = f3.lang AND t.a = f3.c),
z AS (SELECT * FROM x UNION ALL SELECT lang, a || ' ' || b || ' ' || c, f, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END,
  CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM y)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n.n,
  score::BIGINT AS score FROM z JOIN n USING (lang) QUALIFY rank <= {TOP}"""

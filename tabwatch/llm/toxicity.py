"""Toxicity by noisy-channel deobfuscation.

A character trigram model is counted over all documents. Suspicious spans (words with
digits and symbols, spelled-out words, repeated letters) become lattices of the letters that may
be meant; Viterbi decoding under the trigram model picks the most likely reading. Restored
texts are scored by words and word beginnings that mark toxic documents, learned from a
bounded sample of labelled rows."""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.llm.common import packed, shared_dir, stored, text_or_empty, unpacked

SAMPLE_PER_CLASS = 20_000  # labelled rows of each class that the scorer is fitted on, at most
MIN_SUPPORT = 5            # toxic sample texts that must hold a mark
MIN_LOG_RATIO = 3.0        # log likelihood ratio of a mark, at least
PREFIXES = (4, 5, 6)       # lengths of word beginnings
LETTERS = 28               # 0: no letter, 1-26: a-z, 27: any other letter
CELLS = LETTERS ** 3

# Letters that a symbol may stand for.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a",
        "$": "s", "!": "i", "|": "il", "+": "t"}
SLICE = 64          # rows of a batch that are Python objects at a time
HELD_MARKS = 100_000  # marks that a task counts before it sends their counts on
KEPT_SPAN = 64  # characters of a span whose reading is kept, at most
SWAP, KEEP, DROP_REPEAT, KEEP_GAP = 0.5, 2.0, 0.2, 3.0  # channel costs, in nats

_ALL_SYMBOLS = "".join(LEET)
_SYMBOLS = re.escape(_ALL_SYMBOLS)
LEET_SPAN = re.compile(f"(?<![a-z{_SYMBOLS}])(?=[a-z]*+[{_SYMBOLS}])(?=[{_SYMBOLS}]*+[a-z])[a-z{_SYMBOLS}]++")
GAP_SPAN = re.compile(rf"(?<![^\W_])(?:[a-z{_SYMBOLS}][ ._*\-]++){{2,}}[a-z{_SYMBOLS}](?![^\W_])")
RUN_SPAN = re.compile(r"([a-z])\1\1")
DOUBLED = re.compile(r"(?<![a-z])[a-z]*?([a-z])\1[a-z]*+")
LETTER = re.compile(r"[a-z]")
SYMBOL = re.compile(f"[{_SYMBOLS}]")
WORD = re.compile(r"[^\W_]+")


def _class(ch: str) -> int:
    return ord(ch) - 96 if "a" <= ch <= "z" else 27 if ch.isalpha() else 0


class _ClassTable:
    """Letter class of each code point, filled as code points appear."""

    def __init__(self):
        self.table = np.full(0x110000, 255, np.uint8)

    def __call__(self, cp: np.ndarray) -> np.ndarray:
        out = self.table[cp]
        if (new := out == 255).any():
            for c in np.unique(cp[new]).tolist():
                self.table[c] = _class(chr(c))
            out = self.table[cp]
        return out


@functools.cache
def _classes() -> _ClassTable:
    return _ClassTable()


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CELLS, np.int64)
    for b in batches:
        for k in range(0, b.num_rows, SLICE):
            s = "  ".join(["", *b.column(0).slice(k, SLICE).to_pylist(), ""]).lower()
            c = _classes()(np.frombuffer(s.encode("utf-32-le"), "<u4")).astype(np.int32)
            total += np.bincount((c[:-2] * LETTERS + c[1:-1]) * LETTERS + c[2:], minlength=CELLS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["cell", "n"])


def char_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Cost (negative log probability) of a letter after two others, from all documents. At
    most LETTERS ** 3 counts reach the driver, whatever the corpus."""
    cells = docs.select(text_or_empty(text_col).alias("t")).mapInArrow(
        _count_trigrams, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(CELLS)
    for r in cells:
        counts[r.cell] = r.n
    counts = counts.reshape(LETTERS, LETTERS, LETTERS)
    pairs = counts.sum(0)
    back = (pairs + 0.5) / (pairs.sum(1, keepdims=True) + 0.5 * LETTERS)  # letter after one other
    return -np.log((counts + 20 * back[None]) / (counts.sum(2, keepdims=True) + 20))


def decode_span(span: str, cost: np.ndarray) -> str:
    """The most likely reading of a lower-case span under the trigram costs."""
    beams: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    for k, ch in enumerate(span):
        arcs: list[tuple[str, float]] = []
        if ch in LEET:
            arcs = [(x, SWAP) for x in LEET[ch]] + [(ch, KEEP)]
        elif ch.isalpha():
            arcs = [(ch, 0.0)]
        else:
            arcs = [("", 0.0), (" ", KEEP_GAP)]
        if k and ch.isalpha() and span[k - 1] == ch:
            arcs.append(("", DROP_REPEAT))
        new: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (c0, out) in beams.items():
            for x, c1 in arcs:
                if x:
                    z = _class(x)
                    state, c = (b, z), c0 + c1 + float(cost[a, b, z])
                else:
                    state, c = (a, b), c0 + c1
                if state not in new or c < new[state][0]:
                    new[state] = (c, out + x)
        beams = new
    end = min((c + float(cost[a, b, 0]), out) for (a, b), (c, out) in beams.items())
    return end[1]


def _runs(text: str) -> Iterator[tuple[int, int]]:
    """Words that hold a letter three times in a row."""
    at = 0
    while m := RUN_SPAN.search(text, at):
        a, b = m.start(), m.end()
        while a > at and "a" <= text[a - 1] <= "z":
            a -= 1
        while b < len(text) and "a" <= text[b] <= "z":
            b += 1
        yield a, b
        at = b


class Restorer:
    """Text restoration with a bounded memory of spans met before. Readings that may as well be
    wrong stand after the text, once each: words with doubled letters read as if these were
    single, and words without the symbols at their end. Exclamation marks at an end are none."""

    def __init__(self, cost: np.ndarray):
        kept = functools.lru_cache(50_000)(lambda s: decode_span(s, cost))
        self._read = lambda s: kept(s) if len(s) <= KEPT_SPAN else decode_span(s, cost)

    def __call__(self, text: str) -> str:
        low = text.lower()
        spans = [m.span() for m in GAP_SPAN.finditer(low) if LETTER.search(m[0])]
        more: dict[str, None] = {}
        for m in LEET_SPAN.finditer(low):
            span = m[0].rstrip("!")
            if SYMBOL.search(span):
                spans.append((m.start(), m.start() + len(span)))
                if span[-1] in LEET and len(stem := span.rstrip(_ALL_SYMBOLS)) >= 3:
                    more[self._read(stem) if SYMBOL.search(stem) else stem] = None
        for w in {m[0] for m in DOUBLED.finditer(low)}:
            if not RUN_SPAN.search(w) and (reading := self._read(w)) != w:
                more[reading] = None
        spans += _runs(low)
        tail = "".join(f" {w}" for w in sorted(more))
        if not spans:
            return low + tail
        out, at = [], 0
        for a, b in sorted(spans, key=lambda s: (s[0], -s[1])):
            if a >= at:
                out += [low[at:a], self._read(low[a:b])]
                at = b
        return "".join([*out, low[at:], tail])


def marks_of(restored: str) -> set[str]:
    """Candidate marks: "word " is a whole word, "word" a beginning."""
    words = set(WORD.findall(restored))
    return {w + " " for w in words if len(w) >= 3} | {w[:n] for w in words for n in PREFIXES if len(w) > n}


@dataclass
class ToxicityModel:
    cost: np.ndarray
    weights: dict[str, float] = field(default_factory=dict)  # mark -> log likelihood ratio
    coef: tuple[float, float, float] = (-6.0, 0.0, 0.0)      # bias, best mark, log of places

    def __post_init__(self):
        self._ready = None

    def __getstate__(self):
        return {"cost": self.cost, "weights": self.weights, "coef": self.coef, "_ready": None}

    def _tools(self):
        if self._ready is None:
            import ahocorasick

            find = None
            if self.weights:
                find = ahocorasick.Automaton()
                for mark, w in self.weights.items():
                    stem = mark.rstrip(" ")
                    old = find.get(stem, (len(stem), None, None))
                    find.add_word(stem, (len(stem), w if mark != stem else old[1], w if mark == stem else old[2]))
                find.make_automaton()
            self._ready = Restorer(self.cost), find
        return self._ready

    def features(self, text: str) -> tuple[float, float]:
        """(largest weight of the marks in the restored text, log(1 + places of marks))."""
        restore, find = self._tools()
        best, places = 0.0, set()
        if find is not None and text:
            t = restore(text)
            for end, (n, whole, begins) in find.iter(t):
                a = end - n + 1
                if a and (t[a - 1].isalnum()):
                    continue
                inside = end + 1 < len(t) and t[end + 1].isalnum()
                w = begins if inside else whole
                if w is not None:
                    best = max(best, w)
                    places.add(a)
        return best, math.log1p(len(places))

    def score(self, text: str) -> float:
        b, c1, c2 = self.coef
        x1, x2 = self.features(text)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, b + c1 * x1 + c2 * x2))))


def held_out(id_col: str):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, per_class: int) -> DataFrame:
    """(text, toxic) of at most ``per_class`` rows of each class, none of them held out, equal
    texts once. The ids are bounded, so they are broadcast; the texts are not shuffled whole."""
    rows = labels.select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("toxic")) \
        .where("__id IS NOT NULL AND toxic IN (0, 1)").where(~held_out("__id")).distinct()
    parts = [rows.where(F.col("toxic") == k).orderBy(F.xxhash64("__id"), "__id").limit(per_class)
             for k in (0, 1)]
    ids = parts[0].unionByName(parts[1])
    return docs.select(F.col(id_col).alias("__doc"), text_or_empty(text_col).alias("text")) \
        .join(F.broadcast(ids), F.col("__doc") == F.col("__id")) \
        .select("text", "toxic").withColumn("h", F.xxhash64("text")) \
        .dropDuplicates(["h", "toxic"]).select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        per_class: int = SAMPLE_PER_CLASS) -> ToxicityModel:
    """Character model from all documents, marks and weights from the bounded sample. Without
    labelled rows of both classes the model scores every text as clean."""
    model = ToxicityModel(char_model(docs, text_col))
    sample = _sample(docs, labels, id_col, text_col, per_class).persist(StorageLevel.DISK_ONLY)
    try:
        sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
        n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
        if not (n0 and n1):
            return model
        cost = model.cost

        def count_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            restore, seen = Restorer(cost), (Counter(), Counter())

            def counted() -> pa.RecordBatch:
                keys = list(seen[0].keys() | seen[1].keys())
                out = pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.string()), pa.array([seen[1][m] for m in keys], pa.int64()),
                     pa.array([seen[0][m] for m in keys], pa.int64())], ["mark", "n1", "n0"])
                seen[0].clear()
                seen[1].clear()
                return out
            for part in (b.slice(k, SLICE) for b in batches for k in range(0, b.num_rows, SLICE)):
                for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    seen[toxic].update(marks_of(restore(text)))
                    if len(seen[0]) + len(seen[1]) > HELD_MARKS:
                        yield counted()
            yield counted()

        marks = sample.mapInArrow(count_marks, "mark string, n1 long, n0 long") \
            .groupBy("mark").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")) \
            .where(F.col("n1") >= MIN_SUPPORT)
        ratio = F.log((F.col("n1") + 0.5) / (n1 + 1)) - F.log((F.col("n0") + 0.5) / (n0 + 1))
        # bounded: each sample text has a bounded share in it, and each mark needs MIN_SUPPORT
        model.weights = {r.mark: r.w for r in marks.select("mark", ratio.alias("w"))
                         .where(F.col("w") >= MIN_LOG_RATIO).collect()}
        if not model.weights:
            return model
        shared = sample.sparkSession.sparkContext.broadcast(model)

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = shared.value
            for b in batches:
                x1, x2 = zip(*map(m.features, b.column(0).to_pylist())) if b.num_rows else ((), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x1, pa.float64()), pa.array(x2, pa.float64()), b.column(1)], ["x1", "x2", "y"])

        xs = sample.mapInArrow(measure, "x1 double, x2 double, y int").toPandas()
        model.coef = _logistic(xs[["x1", "x2"]].to_numpy(), xs["y"].to_numpy(float))
        return model
    finally:
        sample.unpersist()


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps, from rows in a fixed order."""
    x = np.hstack([np.ones((len(x), 1)), x])
    x, y = x[(o := np.lexsort((y, x[:, 2], x[:, 1])))], y[o]
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(3),
                               x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def scored_texts(rows: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, h (text hash), score from doc_id, h and text t. Only these go through Python, and
    texts are taken from a batch a few at a time."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            scores = [m.score(t) for k in range(0, b.num_rows, SLICE) for t in b.column(2).slice(k, SLICE).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(scores, pa.float64())],
                                             ["doc_id", "h", "score"])
    return rows.select("doc_id", "h", "t").mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, "
                                                           "h long, score double")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    t = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("t"))
    return t.select("doc_id", F.xxhash64("t").alias("h"), "t")


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Null or empty text: scored by the bias alone. Null id: held out (its text is ''), as
    crc32('') is 0. Labels that are null or not 0/1 are ignored; a document labelled twice
    counts for each label. Rows that repeat are scored alike; texts of any length are read whole;
    other columns, clashing names too, are not read. Empty documents: no rows. Without labelled
    rows of both classes every text is scored as clean."""
    s = scored_texts(_texts(docs, id_col, text_col), fit(docs, labels, id_col, text_col))
    return s.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """The rows scored below 0.5, with all their columns. The rows themselves stay in the JVM: the
    few (id, text hash) pairs of toxic texts are stored and leave by an anti join, which Spark
    broadcasts only where their measured size is small. Cases as in ``score_documents``; an empty
    table gives an empty one, and columns of clashing names come back as they were."""
    folder = shared_dir(docs.sparkSession)
    model = fit(docs, labels, id_col, text_col)
    toxic = stored(scored_texts(_texts(docs, id_col, text_col), model).where("score >= 0.5")
                   .select(F.col("doc_id").alias("toxic_id"), F.col("h").alias("toxic_h")).distinct(), f"{folder}/toxic")
    rows = packed(docs, id=F.col(id_col), h=F.xxhash64(text_or_empty(text_col)))
    return unpacked(rows.join(toxic, F.col("id").eqNullSafe(F.col("toxic_id"))
                              & (F.col("h") == F.col("toxic_h")), "left_anti"))

"""Token counts by a compiled finite-state transducer.

A byte-level BPE vocabulary is compiled to a deterministic transducer over bytes. Its state is
what the next byte can still depend on: the longest suffix that begins a longer token, with
the last token and the count at each position of that suffix. Each transition bears the
number of tokens by which the encoding of the prefix grows (it may be negative). States and
transitions are made on first use and kept per worker.

A batch is one byte stream cut into chunks, all advanced in lock step. A chunk that holds a
pre-token boundary is a constant state map: its exit does not depend on its entry. A prefix
scan of the chunk maps gives each chunk's entry (the exit of the nearest constant map on its
left, carried through the maps between); then the part before its first boundary is run."""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.llm import pretokens as P
from tabwatch.llm.common import text_or_empty

CHUNK = 256          # bytes of a chunk
MAX_STATES = 100_000  # beyond it the table is emptied between batches and made anew
BATCH = 1 << 20      # characters advanced at once
GROW = 1 << 14       # states by which the table grows
START, WAIT = 0, 1   # after a boundary; before the first boundary of a chunk (emits nothing)


class Transducer:
    def __init__(self, path: str):
        self.tokenizer, spec = P.load(path)
        self.special = P.specials(spec)
        self.classes = P.Classes(self.tokenizer)
        byte_of = {c: b for b, c in enumerate(P.byte_chars())}
        raw = lambda s: bytes(byte_of[c] for c in s)
        known = {s: i for s, i in spec["model"]["vocab"].items() if s not in self.special}
        self.vocab = {raw(s): i for s, i in known.items()}
        self.rank: dict[tuple[bytes, bytes], int] = {}
        self.parts: dict[bytes, tuple[bytes, bytes]] = {}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = map(raw, m.split(" ") if isinstance(m, str) else m)
            if a + b in self.parts:
                raise ValueError(f"two merges make {a + b!r}")
            self.rank[a, b], self.parts[a + b] = r, (a, b)
        tokens = {bytes([b]) for b in range(256)} | set(self.parts)
        if missing := [t for t in tokens if t not in self.vocab]:
            raise ValueError(f"tokens without an id: {missing[:3]}")
        self.tokens = tokens
        self.prefixes = {t[:k] for t in tokens for k in range(len(t))}
        self._spines: dict[tuple[bytes, int], list[tuple[bytes, float]]] = {}
        self._pairs: dict[tuple[bytes, bytes], bool] = {}
        self.clear()

    def clear(self) -> None:
        """An empty table. A cell holds 64 * next state + emitted tokens + 32, or -1."""
        self.table = np.full((GROW, 256), -1, np.int32)
        self.table[WAIT] = 64 * WAIT + 32
        self.states: list[tuple] = [(b"", (None,), (0,)), ()]
        self.number = {self.states[START]: START}

    def _spine(self, token: bytes, side: int) -> list[tuple[bytes, float]]:
        """Pieces that stand at one edge of a token while it is being merged, each with the
        rank of the merge that ends it."""
        if (key := (token, side)) not in self._spines:
            out, piece, ends = [], token, float("inf")
            while True:
                out.append((piece, ends))
                if piece not in self.parts:
                    break
                ends = self.rank[self.parts[piece]]
                piece = self.parts[piece][side]
            self._spines[key] = out
        return self._spines[key]

    def _may_follow(self, a: bytes, b: bytes) -> bool:
        """Whether tokens a, b can stand side by side: no merge across their border comes
        before the merges inside them. Of equal ranks the left one is merged first."""
        if (ok := self._pairs.get((a, b))) is None:
            ok = True
            for u, u_ends in self._spine(a, 1):
                for v, v_ends in self._spine(b, 0):
                    r = self.rank.get((u, v))
                    if r is not None and r < u_ends and r <= v_ends:
                        ok = False
                        break
                if not ok:
                    break
            self._pairs[a, b] = ok
        return ok

    def _make(self, state: int, byte: int) -> None:
        suffix, lasts, counts = self.states[state]
        x = suffix + bytes([byte])
        for n in range(len(x), 0, -1):
            token, before = x[-n:], lasts[n - 1]
            if token in self.tokens and (before is None or self._may_follow(before, token)):
                break
        else:
            raise AssertionError("no token fits; the vocabulary lacks a byte")
        grown = counts[n - 1] + 1
        k = next(i for i in range(len(x) + 1) if x[i:] in self.prefixes)
        depth = len(x) - k
        new = (x[k:], (token, *lasts[:depth]), (0, *(c - grown for c in counts[:depth])))
        number = self.number.get(new)
        if number is None:
            number = self.number[new] = len(self.states)
            self.states.append(new)
            if number >= len(self.table):
                self.table.resize((len(self.table) + GROW, 256), refcheck=False)
                self.table[-GROW:] = -1
        if not -32 <= grown < 32:
            raise AssertionError("a transition emits too many tokens for its cell")
        self.table[state, byte] = 64 * number + grown + 32

    def _step(self, state: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = (state.astype(np.int64) << 8) | byte
        cell = self.table.ravel()[at]
        if (cell < 0).any():
            for key in np.unique(at[cell < 0]).tolist():
                self._make(key >> 8, key & 255)
            cell = self.table.ravel()[at]
        return cell >> 6, (cell & 63) - 32

    def _emitted(self, u8: np.ndarray, reset: np.ndarray) -> np.ndarray:
        """Tokens emitted at each byte; ``reset``: where pre-tokens begin (at 0 in any case)."""
        n = -(-len(u8) // CHUNK)
        pad = n * CHUNK - len(u8)
        data = np.ascontiguousarray(np.pad(u8, (0, pad)).reshape(n, CHUNK).T)
        cut = np.pad(reset, (0, pad), constant_values=True).reshape(n, CHUNK)
        cut_t = np.ascontiguousarray(cut.T)
        out = np.zeros((CHUNK, n), np.int8)
        state = np.full(n, WAIT, np.int32)
        for k in range(CHUNK):
            state, out[k] = self._step(np.where(cut_t[k], START, state), data[k])
        # the scan: entries become known from left to right past non-constant maps
        constant = cut.any(1)
        head = np.where(constant, cut.argmax(1), CHUNK)
        exits = state.copy()
        ready = np.flatnonzero((head > 0) & np.append(True, constant[:-1]))
        while len(ready):
            lanes = ready[np.argsort(-head[ready], kind="stable")]
            lengths = head[lanes]
            state = exits[lanes - 1]
            for k in range(int(lengths[0])):
                live = int(np.searchsorted(-lengths, -k, "left"))
                state[:live], out[k, lanes[:live]] = self._step(state[:live], data[k, lanes[:live]])
            whole = lanes[~constant[lanes]]
            exits[whole] = state[~constant[lanes]]
            after = whole + 1
            ready = np.sort(after[(after < n)])
            ready = ready[head[ready] > 0]
        return out.T.ravel()[:len(u8)]

    def count(self, texts: list[str]) -> np.ndarray:
        total = np.zeros(len(texts), np.int64)
        for first, part in P.small_batches(texts, BATCH):
            if len(self.states) > MAX_STATES:
                self.clear()
                self._pairs.clear()
            segs, owner, marks = P.segments(part, self.special)
            data, begin, n_bytes = P.cut(segs, self.classes)
            if data:
                u8 = np.frombuffer(data, np.uint8)
                reset = np.zeros(len(u8), bool)
                reset[begin] = True
                sums = np.concatenate([[0], np.cumsum(self._emitted(u8, reset), dtype=np.int64)])
                ends = np.cumsum(n_bytes)
                np.add.at(total, first + np.array(owner), sums[ends] - sums[ends - n_bytes])
            for k, _, _ in marks:
                total[first + k] += 1
        return total


@functools.cache
def transducer(path: str) -> Transducer:
    return Transducer(path)


def token_counter(vocabulary: str):
    """A column function: text -> number of tokens (null: 0)."""
    @F.pandas_udf("long")
    def n_tokens(text: pd.Series) -> pd.Series:
        return pd.Series(transducer(vocabulary).count(text.fillna("").tolist()))
    return n_tokens


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 1024, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    ``vocabulary`` is the path of a byte-level BPE .json on every machine. Null text: empty, 0
    tokens. Repeated rows and null ids stay as they are. Empty table: no rows. No shuffle."""
    t = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("t"))
    c = t.select("doc_id", F.octet_length("t").cast("long").alias("n_bytes"),
                 token_counter(vocabulary)("t").alias("n_tokens"))
    return c.withColumn("over_limit", F.col("n_tokens") > limit)

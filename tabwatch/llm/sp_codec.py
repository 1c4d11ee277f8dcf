"""SentencePiece BPE encoding with seeded merge-dropout, and lossless decoding.

The agenda holds the possible merges of a segment by score. When a candidate is due, a hash
keyed by (seed, row, position of the segment, place, merged piece) decides whether it is
skipped, so a word is segmented anew wherever it stands. Equal rows give equal segmentations on
any machine and after any retry; another seed, id or text gives another one. A skipped pair
stays apart unless a merge beside it offers a new pair.

Only pieces without an inner border between a word and the space after it exist (checked at
load), so a text is cut there. The occurrences of a batch are merged in lock step: columns of a
matrix hold their symbols, linked from left to right, and the key of the merge that each symbol
offers with its right neighbour. A round takes the least key of every column, its hash, and
either merges or strikes out the candidate; columns without candidates leave. Nothing is kept from
one batch to the next. Segments over ROWS symbols have a heap of their own."""

from __future__ import annotations

import functools
import heapq
import itertools
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.llm.common import text_or_empty
from tabwatch.llm.pretokens import small_batches

SPACE = "▁"
WIDTHS = (4, 8, 12, 16, 24, 32)  # rows of the matrices that segments of so many symbols share
ROWS = WIDTHS[-1]
TOGETHER = 1 << 15  # occurrences that are merged together
SLICE = 256         # rows of a batch that are Python objects at a time
NONE = np.iinfo(np.int32).max  # no merge is due
DEAD = -1           # a symbol that has become part of its left neighbour
PUNCTUATION = ".,;:!?%&*#$|\")]}"


class Codec:
    def __init__(self, model: str, dropout: float = 0.1, seed: int = 0, variants: int = 1):
        import sentencepiece

        if not (0 <= dropout <= 1 and variants >= 1):
            raise ValueError("dropout lies in [0, 1], variants is at least 1")
        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        for probe in ("  A ﬁ é ", "x\n\ty"):
            if sp.decode(sp.encode(probe)) != probe:
                raise ValueError(f"{model} changes the text; it can't be decoded without loss")
        self.dropped, self.seed, self.variants = int(dropout * (1 << 32)), seed, variants
        self.piece: dict[str, tuple[float, int]] = {}
        self.bytes_of: list[bytes] = []
        self.byte_id = [-1] * 256
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
                self.bytes_of.append(bytes([int(p[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.piece[p] = (-sp.get_score(i), i)
                self.bytes_of.append(p.replace(SPACE, " ").encode())
        if min(self.byte_id) < 0 or SPACE not in self.piece:
            raise ValueError(f"{model} has no byte fallback or no space piece")
        if bad := [p for p in self.piece if re.search(f"[^{SPACE}]{SPACE}", p) or "\n" in p]:
            raise ValueError(f"pieces that cross a word's end: {bad[:3]}")
        # no merge joins a letter with a mark that never follows a letter in a piece, so a text
        # may be cut there, too
        marks = "".join(re.escape(c) for c in PUNCTUATION
                        if not any(re.search(rf"[^\W\d_]{re.escape(c)}", p) for p in self.piece))
        cut = rf" *[^ \n{SPACE}{marks}]+(?<=[^\W\d_])(?=[{marks}])|" if marks else ""
        self.segments = re.compile(rf"{cut} *[^ \n{SPACE}]+| +|\n|{SPACE}")
        self._tables()

    def _tables(self) -> None:
        """Symbols as numbers: pieces by their id, further characters of pieces after them, all
        other characters as the last one. ``slot_*``: hash table of the pairs that merge."""
        scores = sorted({x for x, _ in self.piece.values()})
        rank = dict(zip(scores, range(len(scores))))
        self.order = np.full(len(scores), -1, np.int32)  # the piece of a score, -2 if there are several
        for x, i in self.piece.values():
            self.order[rank[x]] = i if self.order[rank[x]] == -1 else -2
        number = {p: i for p, (_, i) in self.piece.items()}
        n = len(self.bytes_of)
        for p in self.piece:
            for ch in p:
                if ch not in number:
                    number[ch] = n
                    n += 1
        self.other, self.n_pieces = n, len(self.bytes_of)
        self.symbol = np.full(0x110000, n, np.int32)
        for p, i in number.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        pairs = {}
        for p, (_, i) in self.piece.items():
            for k in range(1, len(p)):
                if p[:k] in number and p[k:] in number:
                    pairs[number[p[:k]], number[p[k:]]] = i
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        size = 1 << max(4, (4 * len(keys)).bit_length())
        self.slot_key, self.slot_piece = np.full(size, -1, np.int64), np.zeros(size, np.int32)
        at, todo, self.probes = self._slot(keys), np.arange(len(keys)), 0
        pieces = np.fromiter(pairs.values(), np.int32, len(pairs))
        while len(todo):  # all pairs probe together; of those that meet in a free slot one stays
            self.probes += 1
            free = self.slot_key[at[todo]] == -1
            place, first = np.unique(at[todo[free]], return_index=True)
            won = todo[free][first]
            self.slot_key[place], self.slot_piece[place] = keys[won], pieces[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            at[todo] = (at[todo] + 1) & (size - 1)
        of = np.zeros(len(self.bytes_of), np.int32)
        for x, i in self.piece.values():
            of[i] = rank[x]
        self.slot_rank = of[self.slot_piece]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        x = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (x >> np.uint64(40)).astype(np.int64) & (len(self.slot_key) - 1)

    def _find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the pairs of symbols that merge, their slots)."""
        keys = a.astype(np.int64) << 32 | b
        at, todo, found, slots = self._slot(keys), np.arange(len(keys)), [], []
        for _ in range(self.probes):
            there = self.slot_key[at]
            hit = there == keys[todo]
            found.append(todo[hit])
            slots.append(at[hit])
            go = ~hit & (there != -1)
            todo, at = todo[go], (at[go] + 1) & (len(self.slot_key) - 1)
            if not len(todo):
                break
        return np.concatenate(found), np.concatenate(slots)

    def _pieces(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Pieces of pairs that merge."""
        found, slots = self._find(a, b)
        out = np.empty(len(a), np.int32)
        out[found] = self.slot_piece[slots]
        return out

    def _due(self, a: np.ndarray, b: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Key of the merge of two symbols: its place in the order of scores, then the place in the
        segment, as of equal scores the leftmost is due."""
        out = np.full(len(a), NONE, np.int32)
        found, slots = self._find(a, b)
        out[found] = self.slot_rank[slots] * ROWS + place[found]
        return out

    def _merge(self, sym: np.ndarray, length: np.ndarray, keys: np.ndarray) -> None:
        """Merge all columns of ``sym`` (symbols, DEAD below a segment's end) in place."""
        rows, n = sym.shape
        place = np.arange(rows, dtype=np.int32)[:, None]
        due = np.full((rows + 1, n), NONE, np.int32)  # the last row takes what has no neighbour
        if rows > 1:
            here = np.flatnonzero((place[:-1] < length - 1).ravel())
            due[:rows - 1].ravel()[here] = self._due(sym[:-1].ravel()[here], sym[1:].ravel()[here],
                                                     (here // n).astype(np.int32))
        right = np.broadcast_to(place + 1, (rows, n)).copy()
        right[right >= length] = rows
        left = np.broadcast_to(place - 1, (rows, n)).copy()
        columns = np.arange(n)  # of ``sym``; due, right, left and keys shrink with those that are done
        low = np.minimum.reduce(due, axis=0)
        while True:
            live = np.flatnonzero(low != NONE)
            if not len(live):
                return
            if 2 * len(live) < len(columns):
                columns, keys, low = columns[live], keys[live], low[live]
                due, right, left = due[:, live], right[:, live], left[:, live]
                live = np.arange(len(live))
            best = low[live]
            i, piece = best % ROWS, self.order[best // ROWS]
            if len(tied := np.flatnonzero(piece < 0)):
                x, at = i[tied], columns[live[tied]]
                piece[tied] = self._pieces(sym[x, at], sym[right[x, live[tied]], at])
            skip = _mixed(keys[live] ^ i.astype(np.uint32) * np.uint32(0x9E3779B1)
                          ^ piece.astype(np.uint32) * np.uint32(0xC2B2AE35)) < self.dropped
            due[i, live] = NONE
            go = np.flatnonzero(~skip)
            c, i, piece = live[go], i[go], piece[go]
            at = columns[c]
            j = right[i, c]
            k = right[j, c]
            sym[i, at], sym[j, at] = piece, DEAD
            right[i, c], due[j, c] = k, NONE
            more = np.flatnonzero(k < rows)
            left[k[more], c[more]] = i[more]
            due[i[more], c[more]] = self._due(piece[more], sym[k[more], at[more]], i[more])
            h = left[i, c]
            more = np.flatnonzero(h >= 0)
            due[h[more], c[more]] = self._due(sym[h[more], at[more]], piece[more], h[more])
            low[live] = np.minimum.reduce(due, axis=0)[live]

    def _skip(self, key: int, place: int, piece: int) -> bool:
        x = (key ^ (place * 0x9E3779B1) ^ (piece * 0xC2B2AE35)) & 0xFFFFFFFF
        x = ((x ^ (x >> 16)) * 0x85EBCA6B) & 0xFFFFFFFF
        x = ((x ^ (x >> 13)) * 0xC2B2AE35) & 0xFFFFFFFF
        return (x ^ (x >> 16)) < self.dropped

    def _alone(self, seg: str, key: int) -> array:
        """Ids of one long segment."""
        ids = array("I")
        for s in self._long(list(seg.replace(" ", SPACE)), key):
            if p := self.piece.get(s):
                ids.append(p[1])
            else:
                ids.extend([self.byte_id[b] for b in s.encode()])
        return ids

    def _together(self, segs: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all segments, how many each has)."""
        length = np.fromiter(map(len, segs), np.int64, len(segs))
        cp = np.frombuffer("".join(segs).encode("utf-32-le"), "<u4")
        begin = np.cumsum(length) - length
        sizes, parts = np.zeros(len(segs), np.int64), []
        itself = length == 1
        itself[itself] = cp[begin[itself]] == ord(SPACE)  # this character, not a space
        cp = np.where(cp == 32, np.uint32(ord(SPACE)), cp)
        low = 0
        for width in WIDTHS:
            rows = np.flatnonzero((length > low) & (length <= width) & ~itself)
            low = width
            if not len(rows):
                continue
            own = length[rows]
            place = np.arange(width)[:, None]
            at = np.minimum(begin[rows] + place, len(cp) - 1)
            sym = np.where(place < own, self.symbol[cp[at]], np.int32(DEAD))
            self._merge(sym, own, keys[rows])
            flat = sym.T.ravel()
            there = np.flatnonzero(flat != DEAD)
            out, many = flat[there], np.ones(len(there), np.int64)
            owner = there // width
            if len(odd := np.flatnonzero(out >= self.n_pieces)):  # no piece: its bytes
                chars = cp[at.T.ravel()[there[odd]]]
                ids = [[self.byte_id[x] for x in chr(c).encode()] for c in chars.tolist()]
                many[odd] = list(map(len, ids))
                start = np.cumsum(many) - many
                wide = np.empty(int(many.sum()), np.int32)
                wide[start] = out
                for a, x in zip(start[odd].tolist(), ids):
                    wide[a:a + len(x)] = x
                out = wide
            sizes[rows] = np.bincount(owner, many, len(rows)).astype(np.int64)
            parts.append((rows, out))
        for r in np.flatnonzero(itself | (length > ROWS)).tolist():
            ids = self._alone(segs[r], int(keys[r])) if not itself[r] else [self.byte_id[x] for x in SPACE.encode()]
            sizes[r] = len(ids)
            parts.append((np.array([r]), np.array(ids, np.int32)))
        start = np.cumsum(sizes) - sizes
        total = np.empty(int(sizes.sum()), np.uint32)
        for rows, out in parts:
            total[_spread(start[rows], start[rows] + sizes[rows])[0]] = out
        return total, sizes

    def encode_rows(self, texts: list[str], keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, end of each text's ids); ``keys``: a hash of each row."""
        cut = [self.segments.findall(" " + t) if t else [] for t in texts]
        n = np.array([len(c) for c in cut], np.int64)
        segs = list(itertools.chain.from_iterable(cut))
        del cut
        place = np.arange(len(segs)) - np.repeat(np.cumsum(n) - n, n)
        key = _mixed(np.repeat(np.array(keys, np.uint32), n) ^ (place + 1).astype(np.uint32) * np.uint32(0x85EBCA77))
        out, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for k in range(0, len(segs), TOGETHER):
            ids, many = self._together(segs[k:k + TOGETHER], key[k:k + TOGETHER])
            out.append(ids)
            sizes.append(many)
        ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])[np.cumsum(n)]
        return np.concatenate(out), ends

    def _long(self, start: list[str], key: int) -> list[str]:
        """The same merges of one segment with a heap."""
        skip = functools.partial(self._skip, key)
        sym: list[str | None] = list(start)
        n = len(sym)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        piece, agenda = self.piece, []
        for i in range(n - 1):
            if p := piece.get(sym[i] + sym[i + 1]):
                agenda.append((p[0], i, i + 1, p[1], 2))
        heapq.heapify(agenda)
        while agenda:
            _, i, j, pid, size = heapq.heappop(agenda)
            a, b = sym[i], sym[j]
            if a is None or b is None or right[i] != j or len(a) + len(b) != size:
                continue
            if self.dropped and skip(i, pid):
                continue
            sym[i], sym[j] = a + b, None
            right[i] = r = right[j]
            if r < n:
                left[r] = i
                if p := piece.get(sym[i] + sym[r]):
                    heapq.heappush(agenda, (p[0], i, r, p[1], size + len(sym[r])))
            if (k := left[i]) >= 0:
                if p := piece.get(sym[k] + sym[i]):
                    heapq.heappush(agenda, (p[0], k, i, p[1], size + len(sym[k])))
        return [s for s in sym if s is not None]

    def encode(self, text: str, variant: int = 0) -> np.ndarray:
        """Ids of one text in one of its variants."""
        if not 0 <= variant < self.variants:
            raise ValueError("no such variant")
        return self.encode_rows([text], [self.row_key(variant, text)])[0]

    def row_key(self, row, text: str) -> int:
        return zlib.crc32(text.encode(), zlib.crc32(str(row).encode(), self.seed * 0x01000193 & 0xFFFFFFFF))

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8")[1:]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(16))


def _spread(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the numbers of all ranges one after another, the range of each)."""
    n = end - start
    owner = np.repeat(np.arange(len(n)), n)
    return np.arange(len(owner)) + (start - np.cumsum(n) + n)[owner], owner


@functools.lru_cache(8)
def codec(model: str, dropout: float, seed: int, variants: int) -> Codec:
    return Codec(model, dropout, seed, variants)


def decoder(model: str):
    """A column function ids -> text."""
    @F.arrow_udf("string")
    def text(ids: pa.Array) -> pa.Array:
        c = codec(model, 0.0, 0, 1)
        done = [pa.array([], pa.string())]
        for part in (ids.slice(k, SLICE) for k in range(0, len(ids), SLICE)):
            flat, ends = part.flatten().to_numpy(zero_copy_only=False), part.offsets.to_numpy()
            ends = (ends - ends[0]).tolist()
            done.append(pa.array([c.decode(flat[a:b].tolist()) for a, b in zip(ends, ends[1:])], pa.string()))
        return pa.concat_arrays(done)
    return text


def _encode(model: str, dropout: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model, dropout, seed, 1)
        for batch in (b.slice(k, SLICE) for b in batches for k in range(0, b.num_rows, SLICE)):
            for i, part in small_batches(batch.column(1).to_pylist()):
                keys = batch.column(0).slice(i, len(part))
                ids, ends = c.encode_rows(part, list(map(c.row_key, keys.to_pylist(), part)))
                yield pa.RecordBatch.from_arrays(
                    [keys, batch.column(1).slice(i, len(part)),
                     pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()),
                                              pa.array(ids.astype(np.int32)))],
                    ["doc_id", "text", "ids"])
    return run


def encode_documents(docs: DataFrame, model: str, dropout: float = 0.1, seed: int = 0,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, ids (array<int>) of each row; id and text pick the row's segmentation. Null
    text: empty, no ids. Repeated rows get equal ids; null ids are kept. Empty table: no rows.
    No shuffle."""
    t = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = t.schema["doc_id"].dataType.simpleString()
    return t.mapInArrow(_encode(model, dropout, seed), f"doc_id {kind}, text string, ids array<int>")


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` with a column ``decoded``, equal to the text that was encoded."""
    return encoded.withColumn("decoded", decoder(model)("ids"))


def codec_report(docs: DataFrame, model: str, **options) -> DataFrame:
    """Encode, decode and compare: doc_id, n_bytes, n_pieces, ids_hash, lossless."""
    d = decode_documents(encode_documents(docs, model, **options), model)
    return d.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                    F.size("ids").cast("long").alias("n_pieces"),
                    F.xxhash64("ids").alias("ids_hash"),
                    (F.col("text") == F.col("decoded")).alias("lossless"))

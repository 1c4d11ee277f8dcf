"""Pre-token boundaries of byte-level BPE vocabularies, for whole batches at once.

The pre-tokenizer is a finite-state machine that needs one character of context on the left
and three on the right, so its boundaries follow from shifted class arrays. The class of each
code point is asked of the tokenizers library itself, once per code point."""

from __future__ import annotations

import functools
import json

import numpy as np

OTHER, LETTER, NUMBER, WHITE, SPACE, UNKNOWN = range(6)


@functools.cache
def load(path: str):
    """(tokenizer, model json) of a byte-level BPE file with the default pre-tokenizer."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    if spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) \
            or pre.get("add_prefix_space") or spec.get("normalizer") or spec["model"].get("ignore_merges"):
        raise ValueError(f"{path} is not a plain byte-level BPE file")
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t, spec


def byte_chars() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable bytes
    stand for themselves, the others for 256, 257, ..."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b) if b in shown else chr(extra))
        extra += b not in shown
    return out


def specials(spec: dict) -> dict[str, int]:
    return {x["content"]: x["id"] for x in spec.get("added_tokens", ())}


class Classes:
    """Class of each code point, filled as code points appear."""

    def __init__(self, tokenizer):
        self.pre = tokenizer.pre_tokenizer
        self.table = np.full(0x110000, UNKNOWN, np.uint8)
        self.table[32] = SPACE
        self._learn(np.array([c for c in range(128) if c != 32]))

    def _learn(self, cps: np.ndarray) -> None:
        one = lambda s: len(self.pre.pre_tokenize_str(s)) == 1
        for c in cps.tolist():
            ch = chr(c)
            self.table[c] = (LETTER if one("a" + ch + "a") else NUMBER if one("1" + ch + "1")
                             else OTHER if one("!" + ch + "!") else WHITE)

    def __call__(self, cp: np.ndarray) -> np.ndarray:
        cls = self.table[cp]
        if (new := cls == UNKNOWN).any():
            self._learn(np.unique(cp[new]))
            cls = self.table[cp]
        return cls


def _shift(x: np.ndarray, k: int, fill) -> np.ndarray:
    """y[i] = x[i + k], ``fill`` outside."""
    y = np.full_like(x, fill)
    if k > 0:
        y[:-k] = x[k:]
    elif k < 0:
        y[-k:] = x[:k]
    return y


def starts(cp: np.ndarray, cls: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True where a pre-token begins. ``first`` marks the first character of each segment;
    segments do not see each other."""
    if not len(cp):
        return first.copy()
    last = _shift(first, 1, True)
    white = cls >= WHITE
    before, before_white = _shift(cls, -1, OTHER), _shift(white, -1, False)
    more_white = _shift(white, 1, False) & ~last
    b = np.where(white,
                 ~before_white | (~last & ~more_white),
                 np.where(before_white, before == WHITE, cls != before)) | first
    quote = np.flatnonzero(b & (cp == 39))
    if len(quote):
        n = len(cp)
        at = lambda k: np.where(quote + k < n, cp[np.minimum(quote + k, n - 1)], 0)
        new = lambda k: np.where(quote + k < n, first[np.minimum(quote + k, n - 1)], True)
        c1, c2, in1 = at(1), at(2), ~new(1)
        in2 = in1 & ~new(2)
        long = in2 & (((c1 == ord("r")) & (c2 == ord("e"))) | ((c1 == ord("v")) & (c2 == ord("e")))
                      | ((c1 == ord("l")) & (c2 == ord("l"))))
        short = in1 & np.isin(c1, [ord(x) for x in "stmd"])
        b[quote[short | long] + 1] = False
        ends = np.concatenate([quote[short] + 2, quote[long] + 3])
        b[ends[ends < n]] = True
    return b


def segments(texts: list[str], special: dict[str, int]) -> tuple[list[str], list[int], list[tuple[int, int, int]]]:
    """Texts cut at special strings: (segments, text number of each, [(text, segments before
    it, special id)])."""
    segs, owner, marks = [], [], []
    found = [s for s in special if any(s in t for t in texts)]
    for k, t in enumerate(texts):
        while True:
            at = min(((t.find(s), -len(s), s) for s in found if s in t), default=None)
            if at is None:
                break
            segs.append(t[:at[0]])
            owner.append(k)
            marks.append((k, len(segs), special[at[2]]))
            t = t[at[0] + len(at[2]):]
        segs.append(t)
        owner.append(k)
    return segs, owner, marks


def cut(segs: list[str], classes: Classes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(UTF-8 of all segments, byte positions where pre-tokens begin, byte length of each
    segment)."""
    joined = "".join(segs)
    data = joined.encode("utf-8")
    cp = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    n_chars = np.array([len(s) for s in segs], np.int64)
    at = np.cumsum(n_chars) - n_chars
    first = np.zeros(len(cp), bool)
    first[at[n_chars > 0]] = True
    b = starts(cp, classes(cp), first)
    u8 = np.frombuffer(data, np.uint8)
    char_at = np.flatnonzero((u8 & 0xC0) != 0x80)
    edges = np.append(char_at, len(data))
    n_bytes = edges[at + n_chars] - edges[at]
    return data, char_at[b], n_bytes


def small_batches(texts: list[str], chars: int = 1 << 20):
    """(first, texts) in runs of about ``chars`` characters."""
    k = 0
    while k < len(texts):
        j, size = k, 0
        while j < len(texts) and (j == k or size + len(texts[j]) <= chars):
            size += len(texts[j])
            j += 1
        yield k, texts[k:j]
        k = j

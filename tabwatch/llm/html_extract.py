"""Main text of web pages, with a suffix array over the pages of a host.

A page is parsed to blocks of three zones: MAIN (inside an article or main element), PAGE
(structural boilerplate: menus, headers, footers, adverts, forms, comments ...) and OPEN
(neither). Elements whose class or id only resembles boilerplate (a menu inside an article, a
token with words of its own such as "cookie-recipe") are suspects: markup does not decide them.

The token streams of a host (all blocks but plain MAIN ones) are concatenated, and a suffix array
finds token runs that stand on different pages. A suspect goes if such runs cover its text, or, for
comments, its frame: the sequence of elements inside, which stands in the stream as tokens of its
own. The rest of MAIN is the article and stays whole: passages may repeat in articles, so
repetition alone removes nothing there, and an article's text is no evidence against a block
elsewhere. On pages without MAIN the OPEN blocks that runs cover go too.

A host's stream is cut into chunks of bounded size, each with its own array. Runs that repeat
only across chunks are found by joining the hashes of their windows. Copies of a page (equal
html on one host) count as one page: they are no evidence against their own text."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.llm.common import finished, shared_dir, stored, text_or_empty

RUN = 8                 # tokens of a repeated run, at least; a power of two
COVERED = 0.8           # share of a block's tokens that makes it boilerplate
CHUNK_TOKENS = 200_000  # tokens under one suffix array
PAGE, MAIN, OPEN, FRAME = 0, 1, 2, 3
NO, SUSPECT, SURE = 0, 1, 2

# HTML element names by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe svg math object xmp select".split())
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt "
            "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main "
            "menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
DROP = set("nav footer aside form head button dialog menu".split())
IMPLIED = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = BLOCK - {"body", "html", "li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
IN_HEAD = set("head meta link base title style script noscript template".split())
# Words of class, id and role attributes that mark boilerplate.
MARKS = set("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies "
            "consent gdpr notice notices sidebar menu nav navbar navigation breadcrumb breadcrumbs comment "
            "comments disqus replies newsletter subscribe share sharing social related popup modal banner "
            "masthead footer contentinfo complementary search toolbar pagination skip thread".split())

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                 r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
                 r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*))?")
WORDS = re.compile(r"[a-z]+")
# Elements that class, id or role can mark inside an article; words that say nothing
# about the content of an element; marks that alone may also name content of an article; marks of
# reader comments.
CONTAINERS = set("article div section ul ol dl table menu fieldset header figure p".split())
FORMS = set("area articles bar block bottom box button buttons container content desktop follow form icons inline "
            "inner item items left link links list media mobile module panel post posts reader readers right section "
            "signup slot text this top unit user users widget wrap wrapper".split())
AMBIGUOUS = set("banner comment menu notice promotion search thread".split())
COMMENTS = set("comment comments disqus replies thread".split())


def _token_mark(words: set[str], in_article: bool) -> int:
    """What a class, id or role token says: SURE if it has marks and no words of its own, and, inside
    an article, if that mark is not the one word that may name content as well."""
    marks = MARKS & words
    if not marks:
        return NO
    return SUSPECT if words - MARKS - FORMS or in_article and len(marks) == 1 and marks <= AMBIGUOUS else SURE


def _mark(name: str, attributes: str, in_main: bool) -> tuple[int, bool]:
    """Whether an element is structural boilerplate (NO, SUSPECT, SURE), and marked as comments."""
    if name in DROP or name == "header" and not in_main:
        return SURE, False
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return NO, False
    best, comments = NO, False
    for key, value in ATTRIBUTE.findall(attributes):
        key = key.lower()
        if key not in ("class", "id", "role", "hidden", "aria-hidden", "style"):
            continue
        value = value.strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return SURE, False
        if key == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return SURE, False
        elif name not in ("html", "body", "main") and (name != "article" or key != "id"):
            if (in_main or name == "article") and (name not in CONTAINERS or key == "id" and name == "section"):
                continue  # a section's id names its subject
            for token in value.split():
                words = {w for w in WORDS.findall(token) if len(w) > 1}
                mark = _token_mark(words, in_main and name != "article")
                if mark == SURE or words == {"header"} and not in_main and name != "article":
                    return SURE, False
                if mark and name != "article":
                    best, comments = mark, comments or bool(COMMENTS & words)
    return best, comments


def _frame(name: str, attributes: str) -> str:
    """One token for an element: its name and class, numbers left out."""
    for key, value in ATTRIBUTE.findall(attributes):
        if key.lower() == "class":
            return f"<{name}." + ".".join(re.sub(r"\d+", "", value.strip("\"'").lower()).split()) + ">"
    return f"<{name}>"


def blocks(page: str) -> list[tuple[int, str]]:
    """(zone, text) of the blocks of a page, in page order, suspects not decided."""
    return [(z, t) for z, t, _ in marked_blocks(page) if z != FRAME]


def marked_blocks(page: str) -> list[tuple[int, str, tuple[int, ...]]]:
    """(zone, text, numbers of the suspects around it) of the blocks of a page, in page order, then
    a FRAME block for each outermost suspect of comments. Never fails, however broken the
    markup: unknown and unclosed elements are closed by what follows."""
    out: list[tuple[int, str, tuple[int, ...]]] = []
    # name, in boilerplate, in main, suspects around, comments suspect around (0: none)
    stack: list[tuple[str, bool, bool, tuple[int, ...], int]] = []
    text: list[tuple[tuple[int, tuple[int, ...]], str]] = []  # zone and suspects, piece of the block
    zone: tuple[int, tuple[int, ...]] = (OPEN, ())
    frames: dict[int, list[str]] = {}
    suspects = 0

    def flush() -> None:
        if text:
            parts: dict[tuple[int, tuple[int, ...]], list[str]] = {}
            for z, x in text:
                parts.setdefault(z, []).append(x)
            for (z, around), p in parts.items():
                if t := " ".join("".join(p).split()):
                    out.append((z, t, around))
            text.clear()

    def settle() -> None:
        nonlocal zone
        if not stack:
            zone = OPEN, ()
        else:
            _, bad, in_main, around, _ = stack[-1]
            zone = (PAGE, ()) if bad else (MAIN if in_main else OPEN, around)

    def close(names: set[str], stop: set[str]) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                if any(s[0] in BLOCK for s in stack[k:]):
                    flush()
                del stack[k:]
                settle()
                return
            if stack[k][0] in stop:
                return

    at, n = 0, len(page)
    while at < n:
        m = TAG.search(page, at)
        if m is None:
            text.append((zone, html.unescape(page[at:])))
            break
        if m.start() > at:
            text.append((zone, html.unescape(page[at:m.start()])))
        at = m.end()
        name = (m[3] or m[6] or "").lower()
        if not name:
            if m[1]:
                text.append((zone, m[1]))
            continue
        if m[2] or m[5]:
            if name == "br":
                text.append((zone, " "))
            elif name not in VOID:
                if name == "p" and not any(s[0] == "p" for s in stack):
                    flush()
                close({name}, set() if name in ("article", "main", "body", "html") else {"article", "main", "body", "td", "th"} - {name})
            continue
        if name in RAW:
            if name != "title" and name in BLOCK:
                flush()
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            if not (m[4] or m[7] or "").rstrip().endswith("/") or name not in ("svg", "math"):
                at = end.end() if end else n
            continue
        if name == "br":
            text.append((zone, " "))
            continue
        if name in VOID:
            if name == "hr":
                flush()
            continue
        if name not in IN_HEAD:
            close({"head"}, set())
        if name in ("article", "main", "body"):  # an unclosed menu or header does not hold the article
            while stack and stack[-1][0] not in ("html", "body", "article", "main", "div", "section", "aside", "form", "footer"):
                flush()
                stack.pop()
        if name in IMPLIED:
            close(IMPLIED[name], {"ul", "ol", "dl", "table", "article", "main", "body", "select"} | ({"div", "section"} if name == "p" else set()))
        if name in ENDS_P:
            close({"p"}, {"article", "main", "body", "div", "section", "td", "th", "li"})
        if name in BLOCK:
            flush()
        attributes = m[4] or m[7] or ""
        _, bad, in_main, around, talk = stack[-1] if stack else ("", False, False, (), 0)
        mark, comments = (SURE, False) if bad else _mark(name, attributes, in_main)
        if name in ("article", "main") and not in_main:  # a wrapper's class says nothing about the article
            in_main, around, talk = True, (), 0
        if mark == SUSPECT:
            suspects += 1
            around += (suspects,)
            talk = talk or (suspects if comments else 0)
        if talk and mark != SURE:
            frames.setdefault(talk, []).append(_frame(name, attributes))
        stack.append((name, mark == SURE, in_main, around, talk))
        settle()
    flush()
    return out + [(FRAME, " ".join(f), (k,)) for k, f in frames.items() if len(f) >= RUN]


def in_stream(zone: int, around: tuple[int, ...] | list[int]) -> bool:
    """Whether a block belongs to the host's token stream: all but the plain text of articles."""
    return zone != MAIN or len(around) > 0


def tokens(stream: list[str]) -> tuple[list[str], list[int]]:
    """Words of the blocks, and the block of each word."""
    words, of = [], []
    for k, t in enumerate(stream):
        w = t.split(" ")
        words += w
        of += [k] * len(w)
    return words, of


BLOCKS = "array<struct<zone: int, text: string, around: array<int>>>"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``main``: text of a page with an article and no suspect in it; else null, and ``stream`` holds
    the MAIN blocks as well."""
    kind = pa.list_(pa.struct([("zone", pa.int32()), ("text", pa.string()), ("around", pa.list_(pa.int32()))]))
    for b in batches:
        step = 256
        for i in range(0, b.num_rows, step):
            part = b.slice(i, step)
            mains, streams, counts = [], [], []
            for page in part.column(4).to_pylist():
                found = marked_blocks(page)
                main = [t for z, t, _ in found if z == MAIN]
                settled = main and not any(z == MAIN and a for z, _, a in found)
                mains.append("\n".join(main) if settled else None)
                streams.append([{"zone": z, "text": t, "around": list(a)} for z, t, a in found
                                if in_stream(z, a) or not settled])
                counts.append(sum(t.count(" ") + 1 for z, t, a in found if in_stream(z, a)))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(k) for k in range(4)), pa.array(mains, pa.string()), pa.array(streams, kind),
                 pa.array(counts, pa.int64())],
                ["page_id", "url", "host", "key", "main", "stream", "n_tokens"])


def repeated_windows(ids: np.ndarray, page: np.ndarray) -> np.ndarray:
    """True where the RUN tokens from a position on also stand on another page. ``ids``: token
    numbers of all streams, ``page``: page number of each token. The suffix array is built by
    doubling to depth RUN, as far as its order matters here."""
    n = len(ids)
    rank = ids.astype(np.int64) + 1
    length = 1
    order = np.argsort(rank, kind="stable")
    while length < RUN:
        after = np.zeros(n, np.int64)
        after[:-length or None] = rank[length:] if length < n else 0
        if length < n:
            other = page[length:] != page[:-length]
            after[:-length][other] = 0
        order = np.lexsort((after, rank))
        new = np.empty(n, np.int64)
        step = (rank[order][1:] != rank[order][:-1]) | (after[order][1:] != after[order][:-1])
        new[order] = np.concatenate([[1], 1 + np.cumsum(step)])
        rank, length = new, 2 * length
    full = np.zeros(n, bool)
    if n >= RUN:
        full[:n - RUN + 1] = page[RUN - 1:] == page[:n - RUN + 1]
    out = np.zeros(n, bool)
    order = order[full[order]]  # suffixes of at least RUN tokens of one page
    if not len(order):
        return out
    edge = np.flatnonzero(np.concatenate([[True], rank[order][1:] != rank[order][:-1]]))
    lo, hi = np.minimum.reduceat(page[order], edge), np.maximum.reduceat(page[order], edge)
    out[order] = np.repeat(lo != hi, np.diff(np.append(edge, len(order))))
    return out


def _token_hash(words: list[str]) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)


def _window_hash(h: np.ndarray) -> np.ndarray:
    """Hash of the RUN tokens from each position on."""
    out = np.zeros(len(h) - RUN + 1, np.uint64)
    for k in range(RUN):
        out = (out ^ h[k:len(h) - RUN + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


FOUND = "kind int, host string, wh long, lo long, hi long, key long, starts array<int>"


def _chunk_rows(host: str, chunks: int, pages: dict[int, tuple[bool, list[str]]]) -> Iterator[tuple]:
    """One suffix array. kind 0: repeated starts of a page with blocks to decide. In a host of
    several chunks also kind 1: each window with its least and greatest page, and kind 2: a
    start not repeated in this chunk."""
    number: dict[str, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for _, ws in pages.values() for w in ws], np.int64)
    sizes = [len(ws) for _, ws in pages.values()]
    page = np.repeat(np.arange(len(pages)), sizes)
    hit = repeated_windows(ids, page)
    at = 0
    hashes = _token_hash(list(number))
    spread: dict[int, tuple[int, int]] = {}
    for (key, (wanted, _)), n in zip(pages.items(), sizes):
        own = hit[at:at + n]
        if wanted:
            yield 0, host, None, None, None, key, np.flatnonzero(own).tolist()
        if chunks > 1 and n >= RUN:
            wh = _window_hash(hashes[ids[at:at + n]]).tolist()
            for k, w in enumerate(wh):
                lo, hi = spread.get(w, (key, key))
                spread[w] = min(lo, key), max(hi, key)
                if wanted and not own[k]:
                    yield 2, host, w, None, None, key, [k]
        at += n
    for w, (lo, hi) in spread.items():
        yield 1, host, w, lo, hi, None, None


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (host, chunk); a chunk's pages are held together, no more."""
    types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
    names = ["kind", "host", "wh", "lo", "hi", "key", "starts"]
    buffer: list[tuple] = []

    def done(force: bool) -> Iterator[pa.RecordBatch]:
        if buffer and (force or len(buffer) >= 20_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*buffer), types)], names)
            buffer.clear()

    current, pages = None, {}
    for b in batches:
        for host, chunk, chunks, key, wanted, stream in zip(*(b.column(k).to_pylist() for k in range(6))):
            if (host, chunk) != current:
                if current:
                    for row in _chunk_rows(current[0], n_chunks, pages):
                        buffer.append(row)
                        yield from done(False)
                current, pages, n_chunks = (host, chunk), {}, chunks
            pages[key] = wanted, tokens(stream)[0]
    if current:
        for row in _chunk_rows(current[0], n_chunks, pages):
            buffer.append(row)
            yield from done(False)
    yield from done(True)


def kept_text(page: list[tuple[int, str, tuple[int, ...]]], starts: list[int]) -> str:
    """Text of a page whose markup does not decide. ``starts``: positions in its token stream where
    RUN tokens begin that stand on other pages too."""
    listed = [k for k, (z, _, a) in enumerate(page) if in_stream(z, a)]
    words, of = tokens([page[k][1] for k in listed])
    covered = np.zeros(len(words) + 1, np.int64)
    for s in starts:
        covered[s] += 1
        covered[min(s + RUN, len(words))] -= 1
    covered = np.cumsum(covered)[:-1] > 0
    total, hidden = np.zeros((2, len(page)), np.int64)
    if of:
        at = np.array(listed)[of]
        total, hidden = np.bincount(at, minlength=len(page)), np.bincount(at, covered, minlength=len(page))
    share: dict[tuple[bool, int], list[float]] = {}  # of the text and of the frame of each suspect
    for k, (z, _, around) in enumerate(page):
        for a in around:
            n = share.setdefault((z == FRAME, a), [0, 0])
            n[0] += hidden[k]
            n[1] += total[k]
    gone = {a for (_, a), (h, n) in share.items() if h >= COVERED * n}
    article = any(z == MAIN for z, _, _ in page)
    return "\n".join(t for k, (z, t, around) in enumerate(page) if gone.isdisjoint(around) and (
        z == MAIN if article else z == OPEN and hidden[k] < COVERED * total[k]))


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, 256):
            part = b.slice(i, 256)
            texts = [kept_text([(x["zone"], x["text"], tuple(x["around"])) for x in stream], starts or [])
                     for stream, starts in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())],
                                             ["page_id", "url", "text"])


def host_of(url: str):
    """Host of a URL, lower case, without user, port and a leading www."""
    h = F.regexp_extract(F.lower(text_or_empty(url)), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(h, r"^www\.", "")


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html", chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """One row per input row: page_id, url, text, n_chars.

    Null and empty html: empty text. Pages without or with a broken url form the host ''. Pages of
    one host with equal html count as one when repetition is sought; each gets its row. Text that is
    no HTML is one OPEN block. Very long pages are read whole; a page longer than ``chunk_tokens``
    fills a chunk alone. Null ids are kept. Columns other than the three named are not read, whatever
    their names. Empty table: no rows."""
    spark = pages.sparkSession
    folder = shared_dir(spark)
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                       host_of(url_col).alias("host"), F.xxhash64(text_or_empty(html_col)).alias("key"),
                       text_or_empty(html_col).alias("html"))
    id_type = src.schema["page_id"].dataType.simpleString()
    parsed = stored(src.mapInArrow(
        _parse, f"page_id {id_type}, url string, host string, key long, main string, "
                f"stream {BLOCKS}, n_tokens long"), f"{folder}/parsed", "zstd")
    # the plain article texts stay out of the shuffle; copies of a page meet on the map side first
    listed = F.filter("stream", lambda x: (x["zone"] != MAIN) | (F.size(x["around"]) > 0))
    streams = stored(parsed.where("n_tokens > 0").select(
        "host", "key", F.col("main").isNull().alias("wanted"), "n_tokens", listed["text"].alias("stream"))
        .dropDuplicates(["host", "key"]), f"{folder}/streams", "zstd")
    sizes = streams.groupBy("host").agg(F.ceil(F.sum("n_tokens") / chunk_tokens).cast("int").alias("chunks"))
    chunked = streams.join(sizes, "host").select(
        "host", F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int").alias("chunk"), "chunks", "key",
        "wanted", "stream")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = stored(chunked.repartition(n, "host", "chunk").sortWithinPartitions("host", "chunk", "key")
                   .mapInArrow(_arrays, FOUND), f"{folder}/found")
    across = found.where("kind = 1").groupBy("host", "wh").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")) \
        .where("lo <> hi").select("host", "wh")
    more = found.where("kind = 2").join(across, ["host", "wh"], "left_semi").select("host", "key", "starts")
    starts = found.where("kind = 0").select("host", "key", "starts").unionByName(more) \
        .groupBy("host", "key").agg(F.flatten(F.collect_list("starts")).alias("starts"))
    whole = parsed.where("main IS NOT NULL").select("page_id", "url", F.col("main").alias("text"))
    rest = parsed.where("main IS NULL").join(starts, ["host", "key"], "left") \
        .select("page_id", "url", "stream", "starts") \
        .mapInArrow(_assemble, f"page_id {id_type}, url string, text string")
    out = whole.unionByName(rest).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
    return finished(out, folder, "zstd")

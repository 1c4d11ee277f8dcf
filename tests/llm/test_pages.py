"""WARC archives and HTML extraction."""

import gzip
import hashlib
import itertools
import random

import numpy as np
import pytest

from tabwatch.llm import html_extract as H
from tabwatch.llm import warc

BIG = "<p>" + "x" * 200 + "</p>"
PAGES = [(1, "http://a.example/1", BIG), (2, "http://a.example/2", BIG), (3, None, None), (4, "http://b/", ""),
         (5, "http://b/x", "small"), (6, "http://b/y", "small"), (None, "http://c/", BIG), (7, "u\r\nv", "é" * 70),
         (8, "http://c/ü", "é" * 70), (9, "http://d", "<b>" * 400000), (1, "http://a.example/again", BIG),
         (None, "n", "null " * 50), (None, "n", "null " * 50), (10, "h", "\r\n\r\nWARC/1.1\r\n\r\n" * 20)]


def test_warc_round_trip(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS same")
    folder = f"file://{tmp_path}/w"
    index = warc.write_archives(df, folder)
    rows = warc.read_records(index, folder).collect()
    assert len(rows) == len(PAGES)
    by_digest = {hashlib.sha256((h or "").encode()).hexdigest(): (h or "").encode() for _, _, h in PAGES}
    for r in rows:
        whole = by_digest[r.payload_digest]
        assert r.payload_bytes == len(whole)
        assert bytes(r.payload) == whole if r.record_type == "response" else r.payload is None
    kinds = sorted(((r.page_id, r.record_type, r.refers_to) for r in rows), key=repr)
    revisits = {k for k in kinds if k[1] == "revisit"}
    assert revisits == {(2, "revisit", 1), (None, "revisit", 1), (8, "revisit", 7)}
    assert {r.url for r in rows} == {u and u.replace("\r\n", "%0D%0A") for _, u, _ in PAGES}
    # index rows alone lead to single records
    one = index.where("page_id = 5")
    at = one.first()
    with open(at.file, "rb") as f:
        f.seek(at.offset)
        assert warc.parse(gzip.decompress(f.read(at.length)))["payload"] == b"small"
    assert [r.page_id for r in warc.read_records(one, folder).collect()] == [5]
    assert warc.archive_report(df).count() == len(PAGES)
    assert warc.archive_report(df.limit(0)).count() == 0


def test_warc_refuses_damage():
    data = warc.record(1, "http://a", b"payload", hashlib.sha256(b"payload").hexdigest(), None, False)
    assert warc.parse(data)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"payload\r\n\r\n", b"PAYLOAD\r\n\r\n"))
    with pytest.raises(ValueError):
        warc.parse(data[:-5])


MAIN_CASES = [
    ("<html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><ul><li>Menu</ul></nav>"
     "<!-- ad --><div class='ad'>Buy</div><article><h1>Head&amp;line</h1><p><b>One  two<br><p>Three&nbsp;four</p></article>"
     "<footer>&copy; x</footer></body></html>", ["Head&line", "One two", "Three four"]),
    ("<article><header><h1>T</h1></header><p>a<p>b<footer>by me</footer><section class='comments'><p>Nice!</p></section></article>", ["T", "a", "b"]),
    ("<nav><ul><li>Menu<article><p>kept", ["kept"]),
    ("<main><div id='sidebar'>no</div><p>yes</p><aside>no</aside><form>mail<input></form><ul><li>one<li>two</ul></main>", ["yes", "one", "two"]),
    ("<article><p>cut &am", ["cut &am"]), ("<article><p>a &lt;b&gt; &#233;&#x41;</p>", ["a <b> éA"]),
    ("<div role=navigation>n</div><article class='post article-header'><table><tr><td>1<td>2</table><pre>x\n  y</pre></article>", ["1", "2", "x y"]),
    ("<article><p>see <a href='x>y'>link</a>, <i>it</i>alic</p><div class='cookie-notice'>ok?</div><p hidden>h</p></article>", ["see link, italic"]),
    ("<article><p>x</article><p>after</p>", ["x"])]


@pytest.mark.parametrize("page,want", MAIN_CASES)
def test_main_blocks(page, want):
    assert [t for z, t in H.blocks(page) if z == H.MAIN] == want


def test_broken_markup_never_fails():
    r = random.Random(1)
    bits = ["<p>", "</p>", "<div class=\"a", "<", ">", "text ", "<script>", "</script>", "<!--", "-->", "&am", "<article>",
            "</article>", "'", "\"", "<br/>", "<li>", "</ul>", "<nav>", "<a href='", "é", "<![CDATA[", "]]>", "<svg/>", "</"]
    for _ in range(2000):
        H.blocks("".join(r.choices(bits, k=r.randrange(30))))
    assert H.blocks("<div " * 20000) is not None and H.blocks("<" * 50000) is not None


def test_repeated_windows_against_brute_force():
    g = np.random.default_rng(2)
    for n in (0, 5, 8, 300):
        ids = g.integers(0, 3, n)
        page = np.sort(g.integers(0, 6, n))
        seen = {}
        for k in range(n - H.RUN + 1):
            if page[k] == page[k + H.RUN - 1]:
                seen.setdefault(tuple(ids[k:k + H.RUN]), set()).add(int(page[k]))
        want = [k + H.RUN <= n and page[k] == page[k + H.RUN - 1] and len(seen[tuple(ids[k:k + H.RUN])]) > 1 for k in range(n)]
        assert H.repeated_windows(ids, page).tolist() == want


def plain_page(k):
    r = random.Random(k)
    own = " ".join(f"u{r.randrange(10 ** 9)}" for _ in range(30))
    return (f"<body><div>Welcome to our site where everything is always shown first</div><div>{own}</div>"
            f"<div>All rights reserved by the owners of this very site since ever</div></body>"), own


@pytest.mark.parametrize("chunk", [200_000, 60])
def test_pages_without_article(spark, chunk):
    rows = [(k, f"http://www.Host.example/{k}?q", plain_page(k)[0]) for k in range(12)]
    rows += [(20, "http://single.example/", plain_page(20)[0]), (21, None, None), (22, "bad url", ""), (None, "x://h", "just text"),
             (23, "http://y/", "<article>" + "<p>w &amp; v</p>" * 30000 + "</article>"), (23, "http://y/", "<article><p>dup</p></article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'k' AS key", "1 AS host")
    out = H.extract_text(df, chunk_tokens=chunk).collect()
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    text = {r.page_id: r.text for r in out if r.page_id != 23}
    for k in range(12):
        assert text[k] == plain_page(k)[1]
    assert len(text[20].split("\n")) == 3 and text[21] == text[22] == "" and text[None] == "just text"
    assert sorted(r.text for r in out if r.page_id == 23)[0] == "dup"
    assert [r.n_chars for r in out if r.page_id == 23 and r.text != "dup"] == [30000 * 6 - 1]
    assert H.extract_text(df.limit(0)).count() == 0


def test_article_text_of_the_tables(spark):
    """Brute force on the given pages: text between the article tags, paragraph by paragraph."""
    import html
    import re

    from tabwatch.plans.tables import table

    pages = table(spark, "/root/testdata/sf0.001", "pages")
    want = {}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(?:</article>|$)", r.html, re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body))
        want[r.page_id] = "\n".join(x for x in parts if x)
    got = {r.page_id: r.text for r in H.extract_text(pages).collect()}
    assert got == want
    assert len(list(itertools.chain(*want.values()))) > 1000


KEPT = ["<p data-hidden='false'>t</p>", "<p title='the hidden cost'>t</p>", "<blockquote cite='/view?id=notice-7'>t</blockquote>",
        "<div><a href='/hidden-gems'>t</a></div>", "<p><a href=/hidden-gems>t</p>", "<h2 id='related-work'>t</h2>",
        "<section id='social-impact'>t</section>", "<div class='search-results'>t</div>", "<p class='notice'>t</p>",
        "<p>t<span hidden> no</span></p>", "<p>t <span style='display: none'>no</span></p>", "<p>t<button>no</button></p>",
        "<p>t</p><div class='related-posts'>no</div>", "<p>t</p><div id=newsletter>no</div>", "<p>t</p><p HIDDEN>no</p>"]


@pytest.mark.parametrize("body", KEPT)
def test_attributes_and_inline_zones(body):
    assert [t for z, t in H.blocks(f"<body><article>{body}</article>") if z == H.MAIN] == ["t"]
    assert [t for z, t in H.blocks(f"<article class='social-impact'>{body}</article>") if z == H.MAIN] == ["t"]


GONE = ["<div class='reader-comments'>no</div>", "<div class='user-comments'>no</div>", "<div class='comment-thread'>no</div>",
        "<div class='newsletter-signup'>no</div>", "<div class='ad-300x250'>no</div>", "<div class='share-this'>no</div>",
        "<div class='social-media-links'>no</div>", "<div class='related-articles'>no</div>",
        "<div class='cookie-banner-text'>no</div>", "<div id='disqus_thread'>no</div>", "<p class='ad'>no</p>"]


@pytest.mark.parametrize("form", GONE)
def test_marked_elements_of_articles(form):
    assert H.blocks(f"<article><p>t</p>{form}<p>u</p></article>") == [(H.MAIN, "t"), (H.PAGE, "no"), (H.MAIN, "u")]


def test_wrappers_do_not_mark_their_article():
    page = "<body class='no-sidebar'><div class='page has-sidebar'><article><p>t</p></article><div class='sidebar'>no</div></div>"
    assert [t for z, t in H.blocks(page) if z == H.MAIN] == ["t"]
    assert not any(a for z, _, a in H.marked_blocks(page) if z == H.MAIN)


def suspect_page(k, host):
    """An article with a recipe list, a marked-looking element that repeats and reader comments of one frame."""
    r = random.Random(f"{host}{k}")
    own = [" ".join(f"w{r.randrange(10 ** 9)}" for _ in range(12)) for _ in range(4)]
    talk = "".join(f"<div class='comment-{k}{i} by-reader'><b>{r.random()}</b><time>{r.random()}</time><p>{r.random()}</p></div>"
                   for i in range(2 + k % 3))
    return (f"<article><p>{own[0]}</p><ul class='menu'><li>{own[1]}</li></ul><div class='promo-of-autumn'>Our shop sells all the "
            f"books that this site writes about</div><div class='comment'><p>{own[2]}</p></div><p>A passage of ten words that every "
            f"article of this host holds</p><section class='comments-of-page'>{talk}</section></article>",
            [own[0], own[1], own[2], "A passage of ten words that every article of this host holds"])


@pytest.mark.parametrize("chunk", [200_000, 120])
def test_suspects_are_decided_by_repetition(spark, chunk):
    rows = [(k, f"http://h.example/{k}", suspect_page(k, "h")[0]) for k in range(8)]
    rows += [(k + 8, f"http://h.example/copy{k}", suspect_page(k, "h")[0]) for k in range(8)]
    rows += [(20 + k, f"http://alone.example/{k}", suspect_page(0, "alone")[0]) for k in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS stream", "2 AS around")
    got = {r.page_id: r.text.split("\n") for r in H.extract_text(df, chunk_tokens=chunk).collect()}
    for k in range(16):
        assert got[k] == suspect_page(k % 8, "h")[1]
    for k in range(3):  # copies of one page are no evidence against it
        assert "Our shop sells all the books that this site writes about" in got[20 + k]


def test_kept_text_against_brute_force(spark):
    r = random.Random(5)
    phrases = [" ".join(r.choices("abcd", k=r.randrange(1, 14))) for _ in range(6)]
    kinds = ["p", "div", "ul class='menu'", "div class='search-results'", "section class='comment-box-x'", "nav", "div class='no-ads x'"]

    def page():
        body = "".join(f"<{(k := r.choice(kinds))}>{r.choice(phrases)}<p class=q{r.randrange(2)}>{r.choice(phrases)}</p></{k.split()[0]}>"
                       for _ in range(r.randrange(1, 9)))
        return f"<article>{body}</article><p>x</p>" if r.random() < 0.5 else body

    rows = [(k, f"http://{'ab'[k % 2]}/", page()) for k in range(60)]
    want = {}
    streams = {}
    for k, u, h in rows:
        streams[k] = [(w, n) for n, (z, t, a) in enumerate(H.marked_blocks(h)) if z != H.MAIN or a for w in t.split()]
    for k, u, h in rows:
        others = set()
        for j, v, g in rows:
            if v == u and g != h:
                ws = [w for w, _ in streams[j]]
                others |= {tuple(ws[i:i + H.RUN]) for i in range(len(ws) - H.RUN + 1)}
        ws = [w for w, _ in streams[k]]
        hit = [any(tuple(ws[s:s + H.RUN]) in others for s in range(max(0, i - H.RUN + 1), i + 1) if s + H.RUN <= len(ws))
               for i in range(len(ws))]
        found = H.marked_blocks(h)

        def covered(ids):
            on = [x for x, (_, n) in zip(hit, streams[k]) if n in ids]
            return bool(on) and sum(on) >= H.COVERED * len(on)

        numbers = {a for _, _, around in found for a in around}
        gone = {a for a in numbers for frame in (False, True)
                if covered({n for n, (z, _, around) in enumerate(found) if a in around and (z == H.FRAME) == frame})}
        article = any(z == H.MAIN for z, _, _ in found)
        want[k] = "\n".join(t for n, (z, t, around) in enumerate(found) if not gone & set(around)
                            and (z == H.MAIN if article else z == H.OPEN and not covered({n})))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for chunk in (200_000, 50):
        assert {x.page_id: x.text for x in H.extract_text(df, chunk_tokens=chunk).collect()} == want
    assert any(w == "" for w in want.values()) and len({len(w) for w in want.values()}) > 10

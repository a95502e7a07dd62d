"""Main text by wrappers, against the pages' own article and hand-made pages."""

import html
import json
import random
import re

import pytest

from stopline.llm import wrappers

DDL = "page_id long, url string, html string, host string, shape string, mask string"


def frame(spark, pages):
    return spark.createDataFrame([(i, u, h, "clash", "clash", None) for i, (u, h) in enumerate(pages)], DDL).repartition(3)


def texts(df):
    assert df.columns == ["page_id", "url", "text", "n_chars"]
    rows = df.collect()
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    return {r["page_id"]: r["text"] for r in rows}


def article_of(page):
    """What lies between the article's tags, read with plain string operations."""
    inside = page.split("<article>", 1)[1].split("</article>", 1)[0]
    blocks = re.split(r"</?(?:h1|p)>", inside)
    clean = (" ".join(html.unescape(re.sub(r"</?(?:b|br|a)[^>]*>", " " if "<br" in b else "", b)).split()) for b in blocks)
    return "\n".join(b for b in clean if b)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_article_of_every_given_page(spark, size):
    pages = spark.read.parquet(f"/root/testdata/{size}/pages.parquet")
    want = {r["page_id"]: article_of(r["html"]) for r in pages.collect()}
    assert texts(wrappers.text_rows(pages)) == want


def site(i, extra="", article=True, before="", after=""):
    body = f"<h2>Title {i}</h2><p>First&nbsp;part  {i} &amp; <a href=x>a\n link</a>.<p>Second <b>p</b>art {i}<br>end</p>{extra}"
    body = f"<article class=post-{i}>{body}</article>" if article else f"<div class='content'>{body}</div>"
    return (f"<html><head><title>T {i}</title><style>p {{}}</style></head><body><header><h1>Site</h1></header>"
            f"<ul class='main-menu'><li><a href=/>Home</a><li><a href=/a>About</a></ul>{before}"
            f"<div id=cookie-notice>We use cookies {i}</div>{body}{after}<aside>Other {i}</aside>"
            f"<form>Name <input> {i}</form><div class=\"comments\"><p>Nice {i}!</div><p>All rights kept</p>"
            f"<script>if (a<b) document.write('<article><p>no</p></article>')</script><footer>Foot {i}</footer></body></html>")


def body(i, *more):
    return "\n".join([f"Title {i}", f"First part {i} & a link.", f"Second part {i} end", *more])


def awkward_pages():
    pages, want = [], []

    def add(url, page, text):
        pages.append((url, page))
        want.append(text)

    for i in range(8):
        extra = "<ul><li>one<li>two<ul><li>deep</ul></ul>" if i % 3 == 0 else "<div class=advert>Buy</div>" if i % 3 == 1 else ""
        add(f"https://a.example/{i}", site(i, extra), body(i, *(["one", "two", "deep"] if i % 3 == 0 else [])))
        # no article: fields are told from fixed text by the other pages of the host
        add(f"http://B.example?{i}", site(i, article=False), body(i))
    add("https://a.example/9", site(9, "<table><tr><td>x<td>y<tr><td>z</table><pre>k\n  l</pre>"), body(9, "x", "y", "z", "k l"))
    add("https://a.example/9", site(9, "<table><tr><td>x<td>y<tr><td>z</table><pre>k\n  l</pre>"), body(9, "x", "y", "z", "k l"))
    add("https://c.example", None, "")
    add(None, "", "")
    add("no host", "<article>1 &lt; 2 & 3 < 4 &unknown; &eacute;&#x41;&#66;</article>", "1 < 2 & 3 < 4 &unknown; éAB")
    add("x://c.example", "<article><p>broken <b>off</p><p class='unclosed", "broken off\n<p class='unclosed")
    add("x://d.example", "<article><p>" + "word " * 40_000 + "</p></article>", ("word " * 40_000).strip())
    add("x://e.example", "<article>" + "<div>" * 5000 + "deep" + "</div>" * 5000 + "<p>on</article>", "deep\non")
    add("x://f.example", "<body><main><header><h1>Own header</h1></header><p>m</p><nav>n</nav></main><p>out</p>", "Own header\nm")
    add("x://g.example", "<article><!-- a > b <p>c</p> --><p hidden>no</p><p>yes</p><article class='comment'>me</article>", "yes")
    return pages, want


def test_hand_made_pages(spark):
    pages, want = awkward_pages()
    got = texts(wrappers.text_rows(frame(spark, pages)))
    assert got == dict(enumerate(want))


def test_wrappers_made_in_small_rounds_give_the_same_text(spark):
    pages, want = awkward_pages()
    got = wrappers.main_text(frame(spark, pages), into="t", fan=2)
    assert got.columns[:6] == ["page_id", "url", "html", "host", "shape", "mask"]
    assert {r["page_id"]: r["t"] for r in got.collect()} == dict(enumerate(want))
    with pytest.raises(ValueError):
        wrappers.main_text(frame(spark, pages), into="host")


def holds(wrapper, shape):
    """Whether a wrapper's expression matches a folded shape, by trying all ways."""
    def lists(ws, ss):
        if not ws:
            return not ss
        w = ws[0]
        if (w[2] and lists(ws[1:], ss)):
            return True
        return bool(ss) and node(w, ss[0]) and lists(ws[1:], ss[1:])

    def node(w, s):
        return w[0] == s[0] and (w[1] or not s[1]) and (w[2] or not s[2]) and lists(w[3], s[3])
    return node(wrapper, shape)


def test_a_wrapper_holds_every_shape_it_was_made_from():
    rng = random.Random(6)

    def tree(depth):
        return [rng.choice("abcd"), False, False,
                wrappers.folded([tree(depth - 1) for _ in range(rng.randint(0, 4))]) if depth else []]
    for _ in range(200):
        shapes = [["r", False, False, wrappers.folded([tree(2) for _ in range(rng.randint(0, 5))])] for _ in range(5)]
        made = shapes[0]
        for s in shapes[1:]:
            made = wrappers.merged(made, s)
        for s in shapes:
            assert holds(made, s)
            assert [wrappers.numbered(made)[i][0] for i in wrappers.slot_map(s, made)] == [n[0] for n in wrappers.numbered(s)]


def test_a_host_has_one_readable_wrapper(spark):
    pages = [(f"x://h/{i}", f"<article><h1>T{i}</h1>{'<p>x</p>' * (i % 3)}{'<hr>' if i == 4 else ''}</article>") for i in range(6)]
    counts = wrappers.shape_counts(frame(spark, pages))
    (row,) = wrappers.wrappers(counts, fan=2).collect()
    assert row["host"] == "h"
    assert wrappers.expression(json.loads(row["wrapper"])) == "<#page>#<article>#<h1>#</>(<p>#</>)*(<hr>#</>)?</></>"


def test_no_pages(spark):
    assert texts(wrappers.text_rows(frame(spark, [("u", "h")]).where("page_id < 0"))) == {}

import html
import random
import re

import pytest

from clickmart.llm import html_extract as op
from clickmart.llm.queries import registry
from tests.llm.conftest import SF01


def pages_frame(spark, rows, extra=()):
    names = ", ".join(f"{c} string" for c in extra)
    schema = "page_id long, url string, html string" + (f", {names}" if names else "")
    return spark.createDataFrame([(*r, *["x"] * len(extra)) for r in rows], schema)


@pytest.mark.parametrize("page, text", [
    ("", ""), ("hello \n world", "hello world"), ("<nav>a</nav>", ""),
    ("<p>1 < 2 &lt; 3&nbsp;a&amp;b &#8212; x</p><p title='a>b'>q</p><!-- <p>no</p> --><p>tail",
     "1 < 2 < 3 a&b — x\n\nq\n\ntail"),
    ("<h1>T</h1><p>one, two. three<p>four<ul><li>a<li>b</ul><table><tr><td>x<td>y</table><div>zz</div>",
     "T\n\none, two. three\n\nfour\n\na\n\nb\n\nx\n\ny"),
    ("<article><h1>A &am</h1><p>x<br>y<p>x<br>y</article><script>var t='</p>'", "A &am\n\nx y\n\nx y"),
    ("<article><p>one</p><script>if (a < b) x('</article>')</script><style>p{}</style><p>two</article>", "one\n\ntwo"),
    ("<main><h1>T</h1><p>Some words, and more.</p><form><p>Your mail, please. Now.</p></form></main><aside>No.</aside>",
     "T\n\nSome words, and more."),
])
def test_pages(page, text):
    assert op.main_text(page) == text


def test_parts_that_only_their_class_names():
    page = """<html><body class="has-sidebar"><div id="top"><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></div>
    <div class="cookie-notice">We use cookies, as all do. Accept them, please, now.</div>
    <div class="story"><h2>Title here</h2><p>First, a long paragraph. It has marks, and words.</p><p>Short</p>
    <ul><li>item one</li><li><a href=z>item two</a>, and its end</li></ul>
    <div class="adBanner"><p>Buy this, now! It is cheap, good, and yours.</p></div></div>
    <div class="teaser">Read on</div>
    <section id="comments"><h3>Comments</h3><p>Great, thanks! I liked it very much, it was good.</p></section></body>"""
    assert op.main_text(page) == (
        "Title here\n\nFirst, a long paragraph. It has marks, and words.\n\nShort\n\nitem one\n\nitem two, and its end")


def test_ratios_choose_the_article_without_any_name():
    menu = "".join(f"<div><a href=/{i}>Go {i}</a></div>" for i in range(20))
    text = "".join(f"<p>Sentence {i}, with some words, marks, and an end. And one more, too.</p>" for i in range(8))
    page = f"<body><div>{menu}</div><div><h2>Head</h2>{text}<p>End</p></div><div><span>All rights reserved</span></div>"
    parts = op.main_text(page).split("\n\n")
    assert parts[0] == "Head" and parts[-1] == "End" and len(parts) == 10


@pytest.mark.parametrize("page", [
    "<div>" * 100_000 + "x.", '<p a="x' * 50_000, "<b>" * 50_000 + "</i>" * 50_000, "<!--" * 100_000,
    "<b><p>x" * 20_000, "<table>" + "<b>" * 20_000 + "<td></td>" * 20_000, "<" * 100_000, "<script>" * 50_000])
def test_long_broken_pages(page):
    op.main_text(page)


def test_odd_rows(spark):
    extra = ["text", "n_chars", "c0", "path", "block"]
    long = "<article>" + "".join(f"<p>word {i}, and more.</p>" for i in range(20_000)) + "</article>"
    rows = [(1, "u", None), (2, "u", ""), (3, None, "<p>a, b.</p>"), (3, None, "<p>a, b.</p>"), (None, None, "<p>c🙂</p>"),
            (4, "v", long)]
    out = op.extract(pages_frame(spark, rows, extra))
    assert out.columns == ["page_id", "url", "c0", "path", "block", "text", "n_chars"]
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in out.collect() if r["page_id"] != 4), key=str)
    assert got == sorted([(1, "", 0), (2, "", 0), (3, "a, b.", 5), (3, "a, b.", 5), (None, "c🙂", 2)], key=str)
    assert [len(r["text"].split("\n\n")) for r in out.where("page_id = 4").collect()] == [20_000]
    assert op.extract(pages_frame(spark, [], extra)).count() == 0


def test_query_against_brute_force(spark):
    """The tables' pages have one layout: what is in <article>, split at its blocks."""
    pages = spark.read.parquet(f"{SF01}/pages.parquet").collect()
    want = {}
    for p in pages:
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", p["html"] or "", re.DOTALL)
        blocks = re.split(r"</?p>|</?h1>", inner[1] if inner else "")
        blocks = [" ".join(html.unescape(re.sub(r"<br>|</?b>", " ", b)).split()) for b in blocks]
        want[p["page_id"]] = (p["url"], "\n\n".join(b for b in blocks if b))
    out = registry()["op12_html_extract"](spark, SF01).collect()
    assert {r["page_id"]: (r["url"], r["text"]) for r in out} == want and len(out) == len(pages)
    assert all(r["n_chars"] == len(r["text"]) for r in out)


def test_other_layouts():
    """Pages made from known texts in layouts that the tables don't have."""
    rnd = random.Random(12)

    def prose(n):
        return " ".join(rnd.choice(["alpha", "beta,", "gamma", "delta.", "&amp;", "eta"]) for _ in range(n))

    for _ in range(60):
        blocks = [prose(rnd.randrange(3, 8))] + [prose(rnd.choice([1, 5, 40, 80])) for _ in range(rnd.randrange(2, 9))]
        tag = rnd.choice(["<article>|</article>", "<main>|</main>", '<div class="entry-content">|</div>']).split("|")
        body = f"<h1>{blocks[0]}</h1>" + "".join(f"<p>{b}</p>" for b in blocks[1:])
        page = (
            f"<html><body><header><h2>Site</h2></header><nav><a href=/>{prose(3)}</a></nav>{tag[0]}{body}"
            f"<aside>{prose(30)}</aside>{tag[1]}<div class='sidebar'><p>{prose(30)}</p></div>"
            f"<div id='cookie-banner'>{prose(20)}</div><ol class='comments'><li>{prose(40)}</li></ol>"
            f"<form>{prose(9)}</form><footer>{prose(20)}</footer></body></html>")
        assert op.main_text(page) == "\n\n".join(html.unescape(b) for b in blocks)

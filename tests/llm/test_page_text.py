"""Main text of pages: the given tables' articles, hand-made pages, odd rows."""
import html
import re

from bursa.llm import page_text
from bursa.llm.common import table

SF_SMALL = "/root/testdata/sf0.001"
LONG = "It was the best of times and it was the worst of times for all of us who were there to see it."
RICH = "Der Hund ist nicht mehr in dem Haus, und wir haben ihn auch nicht auf der Straße bei uns gesehen."


def _text(page):
    return page_text.main_text(page)[0].split("\n\n")


def test_given_pages(spark):
    pages = {r.page_id: r.html for r in table(spark, SF_SMALL, "pages").collect()}
    got = page_text.extract(table(spark, SF_SMALL, "pages")).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id], re.S)[1]
        parts = [html.unescape(re.sub(r"<[^>]*>", " ", p.replace("<b>", ""))) for p in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(" ".join(p.split()) for p in parts if p.split())
        assert r.n_chars == len(r.text)


def test_article_with_side_matter():
    page = f"""<!doctype html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar">
    <header><h1>Site</h1></header><nav><a href=/>Home</a></nav>
    <div class="cookie-notice"><p>{LONG}</p></div><div id="wrap-banner"><main><header><h1>Title &amp; more</h1></header>
    <p>{LONG}<br>Second&nbsp;line<p>Short.</p><script>var a = "<p>no</p>";</script>
    <aside><p>{LONG} aside</p></aside><form><label>Mail</label><input></form>
    <ul><li>one<li>two <b>bold</b>er</ul><!-- <p>{LONG}</p> --><p hidden>{LONG}</p>
    <p><a href="/x">More stories that you may like</a></p>
    <section class="comments"><article class="comment"><p>{LONG} says a reader</p></article></section>
    </main></div><div class=sidebar><p>{RICH}</p></div><footer>&copy; us</footer></body>"""
    assert _text(page) == ["Title & more", f"{LONG} Second line", "Short.", "one", "two bolder"]


def test_blocks_without_article_markup():
    page = f"""<body><div><a href=1>Home</a> <a href=2>News</a></div><div>Login now</div>
    <h2>Heading</h2><div>{LONG}</div><div>Tiny.</div><div>{RICH}</div>
    <div>12 34 56</div><div><a href=3>Imprint</a> <a href=4>Contact</a></div><div>end</div></body>"""
    # the heading and the tiny block follow their text, what stands beside links goes with them
    assert _text(page) == ["Heading", LONG, "Tiny.", RICH, "12 34 56"]
    assert _text("<p>Only this.</p><div>and that</div>") == ["Only this."]


def test_neighbours_in_their_own_section():
    page = f"<nav>{LONG}</nav><article><h1>Hi</h1><p>One.</p></article><article><p>{RICH}</p><p>x</p></article>"
    assert _text(page) == ["Hi", "One.", RICH, "x"]


def test_broken_markup():
    assert _text("<article>a < b &lt;c&gt; &#233;&bogus;<p>d") == ["a < b <c> é&bogus;", "d"]
    assert _text("<article><p>one<p>two</span>thr<b>ee</div>four") == ["one", "twothree", "four"]
    assert _text("<article><p>one</p><!-- <p>two") == ["one"]
    assert _text("<article><p>one</p><script>two") == ["one"]
    assert _text("<article><p>one</p><p cla") == ["one"]
    assert _text("<article><p title='a > b'>one</p>") == ["one"]


def test_bounded_time_on_odd_pages():
    for odd in ("<!--" * 50_000, "<div>" * 50_000 + "x", "</p>" * 50_000, "<a " * 50_000, "<p 'x" * 20_000,
                "<script>" * 50_000, "<noscript>" * 20_000, "&" * 100_000, "<" * 100_000):
        page_text.main_text("<article><p>one</p>" + odd)


def test_odd_rows(spark):
    long = f"<article><p>{LONG}</p>" + f"<p>{'word ' * 400_000}</p>" + "</article>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", "   "), (None, None, f"<p>{LONG}</p>"), (4, "u", "plain text"),
            (5, "u", "<article><p>same</p>"), (5, "u", "<article><p>same</p>"), (6, "u", long)]
    schema = "page_id long, url string, html string, text long, n_chars long"
    got = page_text.extract(spark.createDataFrame([(*r, 7, 7) for r in rows], schema)).collect()
    texts = sorted((str(r.page_id), r.text[:20], r.n_chars) for r in got)
    assert texts == sorted([("1", "", 0), ("2", "", 0), ("3", "", 0), ("None", LONG[:20], len(LONG)), ("4", "", 0),
                            ("5", "same", 4), ("5", "same", 4), ("6", LONG[:20], len(LONG) + 2 + 400_000 * 5 - 1)])
    assert page_text.extract(spark.createDataFrame([], schema)).collect() == []

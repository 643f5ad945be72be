"""Extraction from pages whose article is known."""

import html
import re

from mergewell.llm.html import extract, main_text

LONG = "This is a long paragraph, with commas, and enough words to count as text of an article, which it is. "
FURNITURE = [
    "<nav><ul><li><a href='/'>Home</a></li></ul></nav>", "<header><p>" + LONG + "</p></header>", "<aside>" + LONG + "</aside>", "<footer>" + LONG + "</footer>",
    "<div class='cookie-banner'><p>" + LONG + "</p></div>", "<div class=ad>" + LONG + "</div>", "<form><p>" + LONG + "</p><button>Go</button></form>",
    "<script>var t='</p>';</script>", "<style>p{}</style>", "<section id='comments'><p>" + LONG + LONG + "</p></section>", "<div class='sidebarWidget'></div>",
    "<!-- <p>hidden</p> -->", "<div hidden><p>" + LONG + "</p></div>", "<div style='display: none'>x</div>", "<div class='newsletter-signup'><p>" + LONG + "</p></div>",
]
BODY = f"<h1>Title &amp; more</h1><p>{LONG}</p><p>Short.</p><p>One<br>two &nbsp; three <a href='x'>link</a><ul><li>item</li></ul><p>{LONG}{LONG}</p>"
WANT = ["Title & more", LONG.strip(), "Short.", "One two three link", "item", (LONG + LONG).strip()]


def test_containers():
    for tag in ("article", "main", "div class='main-content has-sidebar'", "section id=story"):
        close = tag.split()[0]
        page = f"<!DOCTYPE html><html><head><title>T</title></head><body>{''.join(FURNITURE[:7])}<{tag}>{BODY}{''.join(FURNITURE[7:])}</{close}>{''.join(FURNITURE)}</body></html>"
        assert extract(page).split("\n\n") == WANT, tag


def test_an_article_in_parts():
    page = f"<body><div class=page><div><p>{LONG}</p><p>{LONG}</p></div><div><p>{LONG}{LONG}</p></div><div><a href=a>{LONG}</a></div></div></body>"
    assert extract(page).split("\n\n") == [LONG.strip(), LONG.strip(), (LONG + LONG).strip()]


def test_inline_furniture():
    for tag in ("span", "small", "b"):
        page = f"<article><p>{LONG}<{tag} class='ad'>buy <{tag}>now</{tag}> cheap <i>here</i></{tag}>and on</p><p>{LONG}</p></article>"
        assert extract(page).split("\n\n") == [f"{LONG}and on", LONG.strip()]
    unclosed = f"<article><p>{LONG}<span class=ad>buy now</p><p>{LONG}</p></article>"
    assert extract(unclosed).split("\n\n") == [LONG.strip()] * 2
    import time

    start = time.perf_counter()
    assert extract(f"<article><p>{LONG}" + "<span class=ad>x" * 30_000 + "</article>") == LONG.strip()
    assert time.perf_counter() - start < 5


def test_beside_an_article():
    page = f"<body><div><h1>Title</h1><article><p>{LONG}</p></article><p>A notice that stands beside it, unmarked.</p><article><p>{LONG}{LONG}</p></article><h2>More to read</h2></div></body>"
    assert extract(page).split("\n\n") == ["Title", LONG.strip(), (LONG + LONG).strip()]


def test_bare_text_beside_the_best():
    page = f"<body><div>{LONG}<div><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div><a href=x>{LONG}</a>tail</div></body>"
    assert extract(page).split("\n\n")[:4] == [LONG.strip()] * 4


def test_replies():
    reply = f"<article><p>{LONG}</p></article>"
    assert extract(f"<article><h1>T</h1><p>{LONG}{LONG}</p><section><h2>So far</h2>{reply * 5}</section></article>").split("\n\n") == ["T", (LONG + LONG).strip(), "So far"]
    assert extract(f"<article>{reply * 2}</article>").split("\n\n") == [LONG.strip()] * 2  # a wrapper without text of its own
    assert extract(f"<main>{reply * 2}</main>").split("\n\n") == [LONG.strip()] * 2


def test_scores_decide():
    """Without an article element the container with the most points for length and commas is kept."""
    long = "words that go on, and on, and on, with commas, for quite a while to come"
    page = f"<body><div><p>short but, a, lot, of, commas, here, and, there</p></div><div><div><p>{long}</p><p>{long}, {long}</p></div></div><div><a href=x>{long}, {long}, {long}, {long}</a></div></body>"
    assert extract(page).split("\n\n") == [long, f"{long}, {long}"]


def test_edges():
    assert extract(None) == extract("") == extract("<html></html>") == ""
    assert extract("plain words only") == "plain words only"
    assert extract("<article><p>cut off <b>here &am") == "cut off here &am"
    assert extract("<p>a</p" + "<div>" * 20_000) == "a"
    assert extract("<article>" + f"<p>{LONG}" * 3000 + "</article>").count("\n\n") == 2999


def test_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    extra = pages.selectExpr("page_id", "url", "html", "1 as text").union(spark.createDataFrame([(-1, None, None, 1)], "page_id long, url string, html string, text int"))
    got = {r.page_id: r.text for r in main_text(extra).collect()}
    assert got.pop(-1) == "" and main_text(extra.limit(0)).count() == 0
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id] == "\n\n".join(b for b in blocks if b)

import re
import time
from html import escape, unescape

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetmeter.llm import block_rules
from fleetmeter.llm.block_rules import blocks_of, extracted, main_text

PROSE = "It was the best of times and it was the worst of times, as so many of the others are."
PAGE = f"""<!DOCTYPE html><html><head><title>The title</title><style>p{{margin:0}}</style>
<script>var t = "</p><article>no</article>";</script></head><body class="with-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a><li><a href="/b">{PROSE}</a></ul></nav>
<div class="cookie-notice">{PROSE}</div><div id="ad-7">{PROSE}</div>
<article><header><h1>A heading</h1></header><p>Short.</p><p>{PROSE} Fish &amp; chips&nbsp;&#233;.</p>
<div class="share">Share this with all of your friends and with the rest of the world, now please.</div>
<p><b>Bold</b>ly <a href="x">linked</a> and
   wrapped<br>here</p><!-- <p>{PROSE}</p> --><form><p>{PROSE}</p></form>
<aside>{PROSE}</aside><p>End.</p><section id="comments"><article class="comment">{PROSE}</article></section>
</article><div class="sidebar">{PROSE}</div><footer>&copy; {PROSE}</footer>
<noscript>{PROSE}</noscript></body></html>"""


def test_furniture_goes_and_the_article_stays():
    assert main_text(PAGE) == (
        f"A heading Short. {PROSE} Fish & chips é. Boldly linked and wrapped here End."
    )


def test_pages_without_an_article():
    page = f"""<body><ul><li><a href=a>Home</a><li><a href=b>About us</a></ul>
      <div><h2>Title</h2><p>{PROSE}<p>Yes.</div><p>zzz qqq xxx www zzz qqq xxx www zzz qqq xxx www
      zzz qqq xxx www zzz qqq xxx<p>Contact"""
    low = " ".join(["zzz qqq xxx www"] * 4)
    # A long block without stop words is like its nearest decided block; the last block is not.
    assert main_text(page) == f"Title {PROSE} Yes. {low} zzz qqq xxx"
    assert main_text("<body><nav>menu</nav><p>Few words.</p><footer>foot</footer>") == "Few words."


ARTICLE = f"<article><h1>Title</h1><p>{PROSE}</p><div class=sidebar>{PROSE}</div><p>End.</p></article>"
RELATED = f"<div class=related><article><p>{PROSE} Another one.</p></article></div>"


@pytest.mark.parametrize(
    "name",
    ["has-sidebar", "no-sidebar", "container with-navbar", "page-with-banner", "hasSidebar", "commentary",
     "layout-sidebar", "sidebar-right", "menu-open", "nav header-fixed", "page-without-comments", "social-page"],
)
def test_wrappers_named_after_furniture(name):
    rest = f"<nav>{PROSE}</nav><div class=cookie-notice>{PROSE}</div><footer>{PROSE}</footer>"
    for inner in (ARTICLE, ARTICLE + RELATED, RELATED + ARTICLE, f"<main>{ARTICLE}</main>{RELATED}"):
        page = f"<body><div id=page class='{name}'>{rest}{inner}</div></body>"
        assert main_text(page) == f"Title {PROSE} End."
    if name != "social-page":
        page = f"<body><div id=page class='{name}'>{rest}<p>{PROSE}</p><p>{PROSE} More.</p></div></body>"
        assert main_text(page) == f"{PROSE} {PROSE} More."


def test_furniture_by_name_stays_furniture():
    assert main_text(f"<body><div class=cookie-notice>{PROSE}</div><p>Few words.</p>") == "Few words."
    assert main_text(f"<body><div class=sidebar>{PROSE}</div><p>Few words.</p>") == "Few words."
    assert main_text(f"<body><p>{PROSE}</p><section id=comments><article>{PROSE} {PROSE}</article></section>") == PROSE
    assert main_text(f"<body>{ARTICLE}<div class=comments>{PROSE}</div>{RELATED}") == f"Title {PROSE} End."
    assert main_text(f"<body><div class=comments>{PROSE}</div><div class=ad>{PROSE}</div>") == ""
    assert main_text(f"<body><nav class=sidebar><main>{PROSE}</main></nav><p>{PROSE}") == PROSE


LONG = " ".join(f"{PROSE} Part {i} of the story." for i in range(4))


@pytest.mark.parametrize("box", ["post", "entry", "content", "story"])
def test_a_box_without_good_text_does_not_exclude_the_rest(box):
    rest = f"<nav>{PROSE}</nav>"
    body = f"<div><p>{LONG}</p><p>{PROSE}</p></div><footer>{PROSE}</footer>"
    assert main_text(f"<body>{rest}<div class={box}>Tags</div>{body}") == f"Tags {LONG} {PROSE}"
    assert main_text(f"<body>{rest}<div class={box}><p>Short teaser</p></div>{body}") == f"Short teaser {LONG} {PROSE}"
    links = "".join(f"<a href=/{i}>Some other story {i}</a> " for i in range(9))
    assert main_text(f"<body>{rest}<div class={box}><p>{links}</p></div>{body}") == f"{LONG} {PROSE}"


def test_long_blocks_of_links_go_wherever_they_stand():
    links = "".join(f"<a href=/{i}>Another story {i} of the day</a> " for i in range(9))
    page = f"<article><h1>Title</h1><p>{PROSE}</p><div>{links}</div><p>{PROSE} More.</p></article>"
    assert main_text(page) == f"Title {PROSE} {PROSE} More."
    assert main_text(page.replace("article", "div")) == f"Title {PROSE} {PROSE} More."


def test_boxes_without_telling_names():
    """Text, links and notes in plain boxes: the densities tell them apart."""
    links = "".join(f"<li><a href=/{i}>Item number {i} of this list</a>" for i in range(8))
    row = "".join(f"<a href=/{i}>Section {i} </a>" for i in range(12))
    page = f"<body><div>{row}</div><ul>{links}</ul><div><h2>Title</h2><p>{LONG}</p><p>Yes.</p><p>{PROSE}</p></div><div>{row}</div>"
    assert main_text(page) == f"Title {LONG} Yes. {PROSE}"


def test_densities_decide_every_long_block(monkeypatch):
    asked = []
    real = block_rules._stop_density
    monkeypatch.setattr(block_rules, "_stop_density", lambda text: asked.append(text) or real(text))
    main_text(PAGE)
    long = [b.text for b in blocks_of(PAGE) if len(b.text) >= block_rules.SHORT and not b.furniture]
    assert long and set(long) <= set(asked)


def test_short_blocks_of_an_article_without_long_ones_stay():
    assert main_text(f"<div class=ad>{PROSE}</div><article><h1>So</h1><p>Few</p></article>") == "So Few"


def test_malformed_pages():
    assert main_text(None) == main_text("") == main_text("<!-- open") == "" and main_text("<") == "<"
    assert main_text("<article><p>a < b & c &lt;d&gt;</article>") == "a < b & c <d>"
    assert main_text("<article><script>x") == ""
    assert main_text("<ARTICLE>up<BR/>down</ARTICLE>") == "up down"
    assert main_text("<article><p title='a>b' hidden>no</p><p title=\"a>b\">yes</p>") == "yes"
    assert main_text("<article><p>a</b></i></div>b</p></article>") == "a b"


@settings(max_examples=100, deadline=None)
@given(st.text("<>/ap!-=\"' &;\n", max_size=80))
def test_never_fails(page):
    main_text(page)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=120), max_size=6))
def test_nothing_of_an_article_is_lost(parts):
    page = "<nav>menu</nav><article>" + "".join(f"<p>{escape(x)}</p>" for x in parts) + "</article>"
    assert main_text(page) == " ".join(unescape(escape(" ".join(parts))).split())


def test_long_pages_take_linear_time():
    deep = "<div>" * 30_000 + "</p>" * 30_000 + "</div>" * 30_000
    for piece in ("<p>word ", "<div>", "<", "a ", "<a href='", "<!--", "&amp;", "</p>"):
        for page in (piece * 30_000, piece * 30_001 + ">"):
            begin = time.perf_counter()
            blocks_of(page)
            assert time.perf_counter() - begin < 5, piece
    blocks_of(deep)


def test_tables(spark):
    rows = [(1, "u", PAGE, "old"), (1, "u", PAGE, "old"), (None, None, None, None), (2, "v", "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extracted(pages.selectExpr("*", "5 AS n_chars"))
    assert got.columns == ["page_id", "url", "n_chars", "text"]
    assert sorted(r.text for r in got.collect()) == ["", "", main_text(PAGE), main_text(PAGE)]
    assert extracted(pages.limit(0)).collect() == []


def test_all_pages(spark, sf):
    """The article of a page is all between its tags here."""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    for r in extracted(pages).join(pages.select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        text = re.sub("<[^>]*>", " ", re.sub("</?b>", "", article))
        assert r.text == " ".join(unescape(text).split())

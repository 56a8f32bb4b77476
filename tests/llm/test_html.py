from __future__ import annotations

import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cadastra.llm.html_text import extract_pages, main_text

PROSE = "The river rose in the night and by the morning the lower fields were under water again. "
FURNITURE = (
    '<header><a href="/">Home page of the paper</a> today is Monday</header><nav><ul><li><a href=a>News</a><li><a href=b>Sport</a></ul></nav>'
    '<aside>Most read stories of this week in one list</aside><div class="cookie-notice">We use cookies on this site, do you agree?</div>'
    '<div id="ad-top">Buy one umbrella now and get another one for nothing</div><form><label>Mail</label><input name=m><button>Send</button></form>'
    '<script>if (a < b) { document.write("<p>no</p>") }</script><style>p > a { color: red }</style><!-- <p>hidden</p> -->'
)
COMMENTS = f'<section class="comments"><p>{PROSE * 3}</p><p>First!</p></section><footer>&copy; The paper, all rights reserved, for ever.</footer>'


def page(body):
    return f"<!DOCTYPE html><html><head><title>Title</title></head><body>{FURNITURE}{body}{COMMENTS}</body></html>"


ARTICLE = f"<h1>Floods &amp; rain</h1><p>{PROSE}<p>It <b>was\n  the</b>\tthird&nbsp;time.<ul><li>one<li>two</ul><blockquote>{PROSE}</blockquote>"
TEXT = "\n".join(["Floods & rain", PROSE.strip(), "It was the third time.", "one", "two", PROSE.strip()])


@pytest.mark.parametrize("holder", ["<article>{}</article>", "<main>{}</main>", "<main><article>{}</article><aside>x</aside></main>", "<div class=story><div>{}</div></div>"])
def test_article_without_furniture(holder):
    assert main_text(page(holder.format(ARTICLE))) == TEXT


WRAPPERS = ["<div class='site has-sidebar'>{}</div>", "<div id='page' class='no-sidebar'>{}</div>", "<div class='content-with-comments'>{}</div>", "<section class='related-science'>{}</section>"]


@pytest.mark.parametrize("wrapper", [*WRAPPERS, "<div class='widget'><div class='social'>{}</div></div>", "<div class='post comments-open'>{}</div>"])
@pytest.mark.parametrize("holder", ["<article>{}</article>", "<main>{}</main>", "<div class=story>{}</div>"])
def test_wrapper_named_like_furniture(wrapper, holder):
    body = FURNITURE + holder.format(ARTICLE + f"<p>{PROSE * 3}</p>") + "<div class=related>Read next: the mayor speaks</div><footer>All rights reserved.</footer>"
    assert main_text(f"<html><body>{wrapper.format(body)}</body></html>") == f"{TEXT}\n{(PROSE * 3).strip()}"


def test_discussion_longer_than_its_article():
    talk = f"<div class=comments><p>{PROSE * 9}</p><article class=comment><p>{PROSE * 9}</p></article></div>"
    cards = f"<section class=related><article><p>{PROSE}</p></article></section>"
    assert main_text(f"<body><article>{ARTICLE}</article>{cards}{talk}</body>") == TEXT
    assert main_text(f"<body><div class=story>{ARTICLE}</div>{talk}</body>") == TEXT
    assert main_text(f"<body class='single no-comments'><div class=story>{ARTICLE}</div></body>") == TEXT


def test_sections_of_an_article_all_count():
    sections = "".join(f"<section><h2>Part {k}</h2><p>{PROSE * k}</p></section>" for k in range(1, 5))
    assert main_text(page(f"<article>{sections}</article>")).count("Part") == 4


def test_menu_inside_an_article():
    links = "".join(f"<li><a href='/{k}'>Story {k} of the week</a></li>" for k in range(6))
    assert main_text(page(f"<article>{ARTICLE}<div><ul>{links}</ul></div></article>")) == TEXT
    sources = "".join(f"<li><a href='/{k}'>Report {k}</a>, printed by the water office of the county</li>" for k in range(6))
    assert main_text(page(f"<article>{ARTICLE}<ul>{sources}</ul></article>")).count("printed by") == 6
    pair = "<p><a href=a>The first part</a> and <a href=b>the second part</a></p>"
    assert main_text(page(f"<article>{ARTICLE}{pair}</article>")) == f"{TEXT}\nThe first part and the second part"


def test_formula_in_an_article():
    assert main_text(page(f"<article>{ARTICLE}<p>Depth <math><mi>d</mi><mo>=</mo><mn>3</mn></math> m</p></article>")) == f"{TEXT}\nDepth d=3 m"


LONG = 400_000


@pytest.mark.parametrize(
    "unit", ["<div>", "<span><div>x</div>", '<a b="', "<a '>'", "<li><div>", "<p><button><div>", "<table><tr><td>", "<script>", "<a", "<!--", "<body><header>", "<i></b>"]
)
def test_work_grows_with_the_page(unit):
    """A quadratic reading of these pages takes minutes."""
    start = time.process_time()
    main_text(unit * (LONG // len(unit)) + "end")
    assert time.process_time() - start < 10


def test_short_article_beside_a_long_footer():
    assert main_text(f"<body><article><h1>Oh.</h1><p><b>Oh no.<br></article><footer>{PROSE * 5}</footer>") == "Oh.\nOh no."


@pytest.mark.parametrize(
    ("source", "text"),
    [("", ""), ("plain &amp; text", "plain & text"), ("<p>a<p>b", "a\nb"), ("<p>x &am", "x &am"), ("<p>a &lt; b</p", "a < b"), ("<p>a<br>b</p>", "a b")]
    + [("<p>a < b and c</p>", "a < b and c"), ('<p title="x>y">z</p>', "z"), ("<p title='it's>z</p>", "z"), ("<!-- open <p>a</p>", ""), ("<script>var a = '<p>'", "")]
    + [("<p>" * 3000 + "deep", "deep"), ("<div>" * 3000 + "deep", "deep"), ("<textarea>x</textarea><p>y</p>", "y"), ("</p></div>a", "a"), ("<p hidden>a</p><p>b</p>", "b")],
)
def test_odd_pages(source, text):
    assert main_text(source) == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class=x>", "</div>", "<b>", "</b>", "<a href=x>", "</a>", "<td>", "<table>", "<li>", "<", ">", "&", "word ", "<br>", "<nav>", "</nav>", "<article>", "<!--", "-->", "'", '"']), max_size=30))
def test_any_markup_gives_clean_lines(parts):
    text = main_text("".join(parts))
    assert all(line == " ".join(line.split()) and line for line in text.split("\n")) or text == ""


def test_table(spark):
    rows = [(1, "u", "<p>a</p>"), (2, None, None), (None, "u", ""), (1, "u", "<p>a</p>")]
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    found = sorted((tuple(r) for r in extract_pages(pages).collect()), key=repr)
    assert found == sorted([(1, "u", "a", 1), (2, None, "", 0), (None, "u", "", 0), (1, "u", "a", 1)], key=repr)
    assert extract_pages(pages.limit(0)).count() == 0
